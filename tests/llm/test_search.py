"""Nearest neighbours against brute force."""

import itertools
import math
import random

import numpy as np
import pytest

from vintagecast.llm import ann


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in {i for i, _ in good if i % every == 0}:
        best = {}
        for _, mine in [g for g in good if g[0] == q]:
            for i, v in good:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float(mine @ v))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def check(spark, rows, every=5, k=20, recall=0.9):
    whole = [(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows]
    frame = spark.createDataFrame(whole, "vec_id long, embedding array<double>, id string")
    got: dict = {}
    for r in ann.nearest(frame, every, k=k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, every, k)
    assert set(got) == {q for q, w in want.items() if w}
    hit = total = 0
    for q, w in want.items():
        mine = sorted(got.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(w) + 1))
        assert mine == sorted(mine, key=lambda x: (-x[2], x[1]))
        scores = [s for _, _, s in mine]
        assert all(a <= b + 1e-9 for a, b in zip(scores, [s for _, s in w]))
        hit += len({i for _, i, _ in mine} & {i for i, _ in w})
        total += len(w)
    assert hit >= recall * total
    return got


def test_recall(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, (rng.normal(size=8) * rng.uniform(0.2, 4)).tolist()) for i in range(1500)])


def test_few_rows_and_odd_ones(spark):
    rows = [(i, [float(i % 3), 1.0, 0, 0, 0, 0, 0, 0.5]) for i in range(12)]
    odd = [(15, None), (20, []), (25, [0.0] * 8), (30, [None, *[1.0] * 7]), (35, [math.nan, *[1.0] * 7]), (40, [math.inf, *[1.0] * 7]), (None, [1.0] * 8), (45, [1.0] * 7), (10, [float(1), 1.0, 0, 0, 0, 0, 0, 0.5]), (5, [2.0] * 8)]
    check(spark, rows + odd, recall=1.0)


def test_one_vector_of_many_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0, 0, 0, 0, 0, 0, 1.0]) for i in range(400)] + [(1000 + i, (rng.normal(size=8) * 0.1).tolist()) for i in range(200)]
    random.Random(1).shuffle(rows)
    got = check(spark, rows, k=20)
    assert [i for _, i, _ in sorted(got[5])][:3] == [0, 1, 2]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, 20).count() == 0
    assert ann.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), 20).count() == 0


def test_short_answers_are_completed_exactly(spark, monkeypatch):
    monkeypatch.setattr(ann, "calibrated", lambda e, n, dim, longest, k: ann.Hashing(dim, longest, 0.01, 1))
    rng = np.random.default_rng(5)
    check(spark, [(i, rng.normal(size=8).tolist()) for i in range(60)], recall=1.0)


def test_probe_template_is_in_order():
    m = 4
    sets = [tuple(x for x in row if x < 2 * m) for row in ann.probe_template(m, 60).tolist()]
    j = np.arange(1, 2 * m + 1)
    up = 2 * m + 1 - j
    cost = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - up / (m + 1) + up * (up + 1) / (4 * (m + 1) * (m + 2)))
    every = [c for n in range(2 * m + 1) for c in itertools.combinations(range(2 * m), n) if len({min(x, 2 * m - 1 - x) for x in c}) == len(c)]
    every.sort(key=lambda c: sum(cost[list(c)]))
    assert len(set(sets)) == 60
    assert [sum(cost[list(c)]) for c in sets] == pytest.approx([sum(cost[list(c)]) for c in every[:60]])


def test_query_keys_begin_with_the_own_bucket():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    h = ann.Hashing(8, 1.0, 2.5, 50)
    for rows, probes in zip(h.row_keys(x), h.query_keys(x)):
        assert (rows == probes[:, 0]).all() and all(len(set(p.tolist())) == 50 for p in probes)
