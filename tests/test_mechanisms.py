"""Histories, quantiles, presence masks and cooldown blocks against plain loops."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import hourly_rows, runs_df, ts
from vintagecast.operators import cooldown, gating, health, profile, versions


def sends(decisions, hours=2):
    """The ids that send, one decision after the other."""
    last, out = {}, set()
    for loc, kind, t, i in sorted(decisions, key=lambda d: (d[2], d[3])):
        if (loc, kind) not in last or t >= last[loc, kind] + dt.timedelta(hours=hours):
            last[loc, kind] = t
            out.add(i)
    return out


def decided(spark, decisions):
    df = spark.createDataFrame(decisions, "location_name string, alert_type string, decision_time_utc timestamp_ntz, decision_id long")
    return {r.decision_id: r.should_send_after_gating for r in gating.cooldown_replay(df).collect()}


@pytest.mark.parametrize("fan_out", [(12,), (3, 2, 4)])
def test_cooldown_by_blocks(spark, monkeypatch, fan_out):
    monkeypatch.setattr(cooldown, "FAN_OUT", fan_out)
    rng, start, out = random.Random(3), ts("2024-01-01 00:00:00"), []
    for loc, minutes, n in (("hot", 7, 900), ("hot", 61, 100), ("thin", 500, 150), ("edge", 120, 60), ("quiet", 9000, 20)):
        t = start + dt.timedelta(minutes=rng.randrange(300))
        for _ in range(n):
            t += dt.timedelta(minutes=minutes if loc == "edge" else rng.choice([0, rng.randrange(2 * minutes)]))
            out.append((loc, f"k{minutes}", t, len(out)))
    rng.shuffle(out)
    got = decided(spark, out)
    want = sends(out)
    assert got == {d[3]: d[3] in want for d in out}


def test_a_hot_key_without_gaps_spreads_over_its_days(spark):
    start = ts("2024-03-01 00:00:00")
    rows = [("hot", "rain", start + dt.timedelta(minutes=5 * i), i) for i in range(10 * 288)]
    df = spark.createDataFrame(rows, "location_name string, alert_type string, decision_time_utc timestamp_ntz, decision_id long")
    out = gating.cooldown_replay(df)
    assert {r.decision_id for r in out.where("should_send_after_gating").collect()} == sends(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_blocks_compose():
    """A step function of several blocks is that of one after the other."""
    rng = np.random.default_rng(0)
    width = 100
    for _ in range(200):
        blocks, starts = [], []
        for b in range(6):
            t = np.unique(rng.integers(b * width, (b + 1) * width, rng.integers(0, 6)))
            if len(t):
                blocks.append((np.append(t, cooldown.ALWAYS), np.append(t + width, cooldown.NEVER)))
                starts.append(b)
        if not blocks:
            continue
        free = blocks[0][1]
        for b in blocks[1:]:
            free = cooldown.apply(*b, free)
        for value in [cooldown.NEVER, *range(starts[0] * width, (starts[0] + 1) * width, 7)]:
            one = value
            for b in blocks:
                one = int(cooldown.apply(*b, np.int64(one)))
            assert one == int(cooldown.apply(blocks[0][0], free, np.int64(value)))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in (("big", 5000), ("one", 1), ("two", 2), (None, 40), ("none", 3)):
        for _ in range(n):
            a = None if g == "none" or rng.random() < 0.1 and n > 2 else float(rng.choice([0.0, -1.5, 3.25, rng.normal() * 100]))
            rows.append((g, a, int(rng.integers(0, 5))))
    qs = {"a": [0.05, 0.5, 0.95], "b": [0.0, 0.25, 1.0]}
    df = spark.createDataFrame(rows, "g string, a double, b int").repartition(5)
    got = {(r.g, r.column, r.q): r.value for r in profile.exact_quantiles(df, "g", qs).collect()}
    groups = defaultdict(lambda: defaultdict(list))
    for g, a, b in rows:
        if a is not None:
            groups[g]["a"].append(a)
        groups[g]["b"].append(b)
    want = {(g, c, q): np.quantile(v, q) for g, cols in groups.items() for c, v in cols.items() for q in qs[c]}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in want)


def test_profile_plan_holds_no_group(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("x", 4.0, None), (None, 3.0, 0.0)], "g string, a double, b double")
    out = profile.distribution_profile(df, "g", {"a": "a", "b": "b"}, {"a": [0.5]}, ("b",))
    assert "percentile" not in out._jdf.queryExecution().toString().lower()
    rows = {r.g: r.asDict() for r in out.collect()}
    assert rows["x"] == {"g": "x", "a_min": 1.0, "a_p50": 2.5, "a_max": 4.0, "a_null_rate": 0.0, "b_min": 2.0, "b_max": 2.0, "b_zero_rate": 0.0, "b_null_rate": 0.5}
    assert rows[None]["a_p50"] == 3.0 and rows[None]["b_zero_rate"] == 1.0


def test_history_rows_against_a_loop(spark):
    rng = random.Random(6)
    rows = []
    for loc in ("a", "b"):
        for day in range(1, 6):
            for hour in rng.sample(range(24), 3):
                snap = f"2024-05-{day:02d} {hour:02d}:30:00"
                for ahead in rng.sample(range(60), 25):
                    ft = (ts(f"2024-05-{day:02d} {hour:02d}:00:00") + dt.timedelta(hours=ahead)).isoformat(sep=" ")
                    rows.append((loc, snap, ft, rng.choice([None, rng.random()]), rng.random(), rng.random(), 1.0))
    rows += [rows[0][:3] + (7.0, 7.0, 7.0, 7.0), rows[40][:3] + (8.0, 8.0, 8.0, 8.0)]  # an hour that repeats in its snapshot
    runs = [(loc, f"2024-05-{d:02d} {h:02d}:15:00") for loc in ("a", "b", "c") for d in range(2, 9) for h in (1, 13, 23)]
    got = sorted((r.location_name, r.as_of_utc, r.forecast_time_local, r.snapshot_time_utc, r.temperature_c or -1, r.wind_kmh) for r in
                 versions.history_rows(hourly_rows(spark, rows), runs_df(spark, runs), 3, (6, 22)).collect())
    want = []
    for loc, at in runs:
        at = ts(at)
        by = defaultdict(list)
        for r in rows:
            ft = ts(r[2])
            if r[0] == loc and ts(r[1]) <= at and 1 <= (at.date() - ft.date()).days <= 3 and 6 <= ft.hour <= 22:
                by[ft].append(r)
        for ft, rs in by.items():
            newest = max(ts(r[1]) for r in rs)
            want += [(loc, at, ft, newest, r[3] or -1, r[5]) for r in rs if ts(r[1]) == newest]
    assert got == sorted(want) and len(got) > 100


def test_history_asks_for_the_times_there_are(spark):
    """A run asks for no hour that the table lacks, and for those off the hour too."""
    rows = [("a", "2024-05-01 00:00:00", f"2024-05-01 {t}", 1.0, 0.0, 0.0, 0.0) for t in ("06:00:00", "07:30:00", "05:30:00")]
    out = versions.history_rows(hourly_rows(spark, rows), runs_df(spark, [("a", "2024-05-02 08:00:00")]), 4, (6, 23))
    assert sorted(str(r.forecast_time_local)[11:16] for r in out.collect()) == ["06:00", "07:30"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.split("\n") if "explode(sequence(" in x and "HOUR" in x]) == 0


def test_todays_hours_are_joined_by_date(spark):
    from vintagecast.config import RULES
    from vintagecast.operators import brief
    rows = [("a", "2024-05-01 00:00:00", f"2024-05-0{d} {h:02d}:00:00", 1.0, 0.0, 0.0, 0.0) for d in (1, 2) for h in (0, 5, 6, 23)]
    out = brief._today_rows(hourly_rows(spark, rows), runs_df(spark, [("a", "2024-05-02 08:00:00"), ("a", "2024-05-03 08:00:00")]), RULES)
    assert sorted(str(r.forecast_time_local)[:16] for r in out.collect()) == ["2024-05-02 06:00", "2024-05-02 23:00"]
    assert "explode(sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_health_masks_against_a_loop(spark):
    rng = random.Random(8)
    rows = []
    for loc, days in (("a", range(1, 9)), ("b", (1, 2, 7)), ("c", (3,))):
        for d in days:
            for _ in range(rng.randrange(1, 30)):
                t = ts(f"2024-07-{d:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00")
                rows.append((loc, t, rng.choice(["x", "y", None]) if loc == "a" else "x"))
    df = spark.createDataFrame(rows, "location_name string, snapshot_time_utc timestamp_ntz, content_hash string")
    got = {(r.location_name, r.today_local_date): r for r in health.snapshot_health(df, F.lit("Europe/Prague")).collect()}
    hours, count = defaultdict(dict), defaultdict(int)
    for loc, t, h in rows:
        local = t + dt.timedelta(hours=2)
        key = (loc, local.date())
        count[key] += 1
        old = hours[key].get(local.hour)
        hours[key][local.hour] = min((x for x in (old, h) if x is not None), default=None)
    newest = max(d for _, d in hours)
    days = {(loc, d0 + dt.timedelta(days=i)) for loc in "abc" for d0 in [min(d for x, d in hours if x == loc)] for i in range((newest - d0).days + 1)}
    assert set(got) == days
    for key in days:
        missing = [h for h in range(6, 20) if h not in hours.get(key, {})]
        r = got[key]
        assert (r.snapshots_today, r.missing_hour_count_06_19) == (count[key], len(missing))
        assert r.missing_hours_list == (", ".join(f"{h:02d}:00" for h in missing) or None)
        seen = [v for _, v in sorted(hours.get(key, {}).items())]
        pairs = [(a, b) for a, b in zip(seen, seen[1:]) if a is not None]
        rate = round(100 * sum(b is not None and a != b for a, b in pairs) / len(pairs), 1) if pairs else None
        assert r.change_rate_pct_today == (pytest.approx(rate, abs=0.051) if rate is not None else None)
