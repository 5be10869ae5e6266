"""Randomised checks of the day-bucketed ordered operators against brute force.

Each test draws independent random histories for many locations (seeded, so
reproducible) and checks every location in one Spark job: runs before any
snapshot, days without snapshots, several snapshots per day, equal times.
"""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from vintagecast.operators import gating, versions
from vintagecast.operators.asof import asof_last_time, rank_desc_in_key

BASE = dt.datetime(2024, 3, 1)
N_KEYS = 40


def _times(rng: random.Random, n: int, span_min: int) -> list[dt.datetime]:
    return [BASE + dt.timedelta(minutes=rng.randrange(span_min)) for _ in range(n)]


def _history(seed: int):
    rng = random.Random(seed)
    snaps, runs = [], []
    for k in range(N_KEYS):
        loc = f"L{k}"
        span = rng.choice([600, 3 * 1440, 10 * 1440])       # within a day, a few days, sparse
        for t in set(_times(rng, rng.randrange(0, 12), span)):
            snaps.append((loc, t))
        for t in set(_times(rng, rng.randrange(1, 10), span + 1440)):
            runs.append((loc, "UTC", t))
        if snaps and rng.random() < 0.3:                       # a run exactly at a snapshot time
            same = [t for l_, t in snaps if l_ == loc]
            if same:
                runs.append((loc, "UTC", rng.choice(same)))
    return snaps, sorted(set(runs))


def test_visible_versions_brute_force(spark):
    for seed in (1, 2, 3):
        snaps, runs = _history(seed)
        s_df = spark.createDataFrame(snaps, "location_name string, snapshot_time_utc timestamp_ntz")
        r_df = spark.createDataFrame(runs, "location_name string, timezone string, as_of_utc timestamp_ntz")
        got = {(r.location_name, r.as_of_utc, r.rn): r.snapshot_time_utc
               for r in versions.visible_versions(s_df, r_df).collect()}
        exp = {}
        by_loc: dict[str, list] = {}
        for loc, t in snaps:
            by_loc.setdefault(loc, []).append(t)
        for loc, _, a in runs:
            seen = sorted(t for t in by_loc.get(loc, []) if t <= a)
            for rn, t in ((1, seen[-1] if seen else None), (2, seen[-2] if len(seen) > 1 else None)):
                if t is not None:
                    exp[(loc, a, rn)] = t
        assert got == exp, f"seed {seed}"


def test_predecessor_and_rank_brute_force(spark):
    snaps, _ = _history(7)
    df = spark.createDataFrame(snaps, "location_name string, snapshot_time_utc timestamp_ntz")
    pairs = {(r.location_name, r.snapshot_time_utc): r.prev_snapshot_utc
             for r in versions.snapshot_pairs(df).collect()}
    ranks = {(r.location_name, r.snapshot_time_utc): r.rk
             for r in rank_desc_in_key(df, ["location_name"], "snapshot_time_utc", "rk").collect()}
    by_loc: dict[str, list] = {}
    for loc, t in snaps:
        by_loc.setdefault(loc, []).append(t)
    for loc, ts in by_loc.items():
        ts = sorted(ts)
        for i, t in enumerate(ts):
            assert pairs[(loc, t)] == (ts[i - 1] if i else None)
            assert ranks[(loc, t)] == len(ts) - i


def test_last_sent_asof_brute_force(spark):
    rng = random.Random(11)
    sent, probes = [], []
    for k in range(N_KEYS):
        loc = f"L{k}"
        for t in set(_times(rng, rng.randrange(0, 8), 5 * 1440)):
            sent.append((loc, t))
        for t in set(_times(rng, rng.randrange(1, 8), 6 * 1440)):
            probes.append((loc, t))
    s_df = spark.createDataFrame(sent, "location_name string, sent_time_utc timestamp_ntz")
    p_df = spark.createDataFrame(probes, "location_name string, run_time_utc timestamp_ntz")
    got = {(r.location_name, r.run_time_utc): r.last for r in
           asof_last_time(p_df, s_df, ["location_name"], "run_time_utc", "sent_time_utc", "last").collect()}
    for loc, a in probes:
        before = [t for l_, t in sent if l_ == loc and t <= a]
        assert got[(loc, a)] == (max(before) if before else None)


def test_cooldown_replay_random_histories(spark):
    rng = random.Random(5)
    rows, i = [], 0
    for k in range(N_KEYS):
        n = rng.randrange(1, 25)
        span = rng.choice([240, 1440, 4 * 1440])
        for t in _times(rng, n, span):                # equal times allowed: the id breaks the tie
            rows.append((f"L{k}", "rain", t, i))
            i += 1
    df = spark.createDataFrame(rows, "location_name string, alert_type string, decision_time_utc timestamp_ntz, "
                                     "decision_id bigint")
    got = {r.decision_id: r.should_send_after_gating for r in gating.cooldown_replay(df).collect()}
    gap = dt.timedelta(hours=2)
    for k in range(N_KEYS):
        mine = sorted((t, d) for l_, _, t, d in rows if l_ == f"L{k}")
        last = None
        for t, d in mine:
            ok = last is None or t >= last + gap
            assert got[d] == ok, (k, t, d)
            last = t if ok else last
        sends = [t for t, d in mine if got[d]]
        assert all(b - a >= gap for a, b in zip(sends, sends[1:]))
