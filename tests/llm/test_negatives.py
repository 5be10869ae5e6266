"""Hard negatives by the R-tree against scores of all rows."""

import numpy as np
import pytest

from tests.llm.by_value import by_value
from vintagecast.llm import rtree


def expected(rows, every, positives=5, negatives=5):
    n = max([len(v) for _, _, v in rows if v is not None] or [0])
    kept = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.add((i, label, tuple(int(np.floor(256 * float(x))) for x in v) + (0,) * (n - len(v))))
    kept = sorted(kept)
    out = set()
    for a, la, va in kept:
        if a % every:
            continue
        score = {(i, lb, vb): sum(x * y for x, y in zip(va, vb)) for i, lb, vb in kept if i != a}
        near = sorted({(-s, k[0]) for k, s in score.items() if k[1] == la})[:positives]
        for ps, p in near:
            fits = sorted({(-s, k[0]) for k, s in score.items() if k[1] != la and 80 * -ps <= 100 * s <= 100 * -ps})
            out |= {(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(fits[:negatives])}
    return sorted(out)


def mined(spark, rows, every):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, score string")
    return sorted(tuple(r) for r in rtree.hard_negatives(frame, every).collect())


def with_text(rows):
    return [(*r, "kept out") for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_scores(spark, seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(rtree, "LEAF", [128, 4, 7, 3][seed])
    monkeypatch.setattr(rtree, "TREE", [256, 256, 5, 20][seed])
    monkeypatch.setattr(rtree, "BLOCK_BYTES", [4 << 20, 4 << 20, 200][seed])
    dim = [6, 2, 3, 12][seed]
    spread = [0.3, 0.01, 2.0, 0.1][seed]
    rows = [(i, int(rng.integers(0, 4)), (rng.normal(0, spread, dim) + rng.integers(0, 2)).tolist()) for i in range(300)]
    rows += [(300 + i, 1, rows[5][2]) for i in range(60)]  # one vector that many rows share
    rows += [(400 + i, i % 3, rows[5][2]) for i in range(40)]
    rows += [rows[10], rows[20], (None, 1, rows[3][2]), (500, None, rows[3][2]), (501, 1, None), (502, 1, [None] * dim), (503, 2, [float("nan")] * dim), (504, 2, [float("inf")] + [0.0] * (dim - 1)), (505, 2, rows[3][2][:1]), (506, 2, []), (507, 2, [0.0] * dim)]
    with by_value(rtree):
        got = mined(spark, with_text(rows), 20)
    assert got == expected(rows, 20) and len(got) > 50


def test_one_row_and_none(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, 1, [1.0], "")], 10) == []
    assert mined(spark, [(0, 1, [1.0], ""), (1, 1, [1.0], ""), (2, 2, [0.9], "")], 10) == [(0, 1, 1, 2, 65536, 58880)]


def test_scores_beyond_doubles(spark):
    rows = [(i, i % 2, [2.0**20 + i, 3.0 * 2**19 - i, 1.0]) for i in range(40)]
    assert mined(spark, with_text(rows), 10) == expected(rows, 10)
    with pytest.raises(ArithmeticError):
        mined(spark, [(0, 1, [1e30], ""), (1, 1, [1e30], "")], 10)


def test_boxes_hold_their_rows():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(1000, 5))
    tiles = rtree.str_tiles(rows, [3, 1, 0, 2, 4], 16)
    assert sorted(np.concatenate(tiles).tolist()) == list(range(1000))
    assert max(map(len, tiles)) <= 16 and len(tiles) < 100
