"""Hard negatives by an STR-packed R-tree over vectors.

Rows are dealt by range of (label, first coordinate, id) and packed in each
task: sort by a coordinate, cut into tiles, sort each tile by the next
coordinate, down to leaves of at most LEAF rows of one label, with coordinates
in falling order of variance.  A leaf keeps its rows and its minimum bounding
box; boxes of FAN neighbours make the nodes above.  The leaves are written once
and read by every search.  A box and an anchor give an interval of inner
products, coordinate by coordinate; a best-first queue opens boxes by the best
score they could still add and leaves out those outside the score window, those
without a fitting label, and those strictly below the k-th score found (equal
ones are opened, since ties go to the smaller id).

Searches (anchor, label, window) are the query set: they go to all tasks in
blocks of at most BLOCK_BYTES, one pass over the leaves a block.  Each task
gives back at most k rows of a search, and a window over searches takes the best.

Scores are exact: components are whole numbers, products are summed in doubles
where all sums stay below 2**53, in 64-bit integers where they stay below
2**63; beyond that there is no long score, and an ArithmeticError says so.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; a shorter vector counts as followed by zeros; rows that
are equal in id, label and vector count once; rows that share an id but differ
are rows of their own, though none of them is another row to an anchor of that
id; several anchors of one id take the positives of each (equal results once);
empty tables give no rows; other columns are left alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, partitions, staged

#: Rows of a leaf, children of a node, leaves searched together as one tree.
LEAF = 128
FAN = 16
TREE = 256
TREE_BYTES = 16 << 20
#: A packing task has at least so many rows, if the table has them.
LEAST = 1024
#: Bytes of vectors of one block of searches.
BLOCK_BYTES = 4 << 20

LEAVES = "label long, ids array<long>, vectors binary, low binary, high binary"
FOUND = "search long, id long, score long"


def str_tiles(rows: np.ndarray, dims: list[int], size: int) -> list[np.ndarray]:
    """Sort-tile-recursive packing: row numbers in leaves of at most ``size``."""

    def cut(at: np.ndarray, left: list[int]) -> Iterator[np.ndarray]:
        pages = -(-len(at) // size)
        if pages <= 1 or not left:
            yield from (at[i : i + size] for i in range(0, len(at), size))
            return
        at = at[np.argsort(rows[at, left[0]], kind="stable")]
        slab = size * -(-pages // int(np.ceil(pages ** (1 / len(left)))))
        for i in range(0, len(at), slab):
            yield from cut(at[i : i + slab], left[1:])

    pages = max(1, -(-len(rows) // size))
    return list(cut(np.arange(len(rows)), dims[: max(1, int(np.ceil(np.log2(pages))))] if pages > 1 else []))


def _pack(dim: int, leaf: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
            rows = b.column(2).flatten().to_numpy().reshape(-1, dim)
            out = []
            for label in np.unique(labels).tolist():
                mine = np.flatnonzero(labels == label)
                own = rows[mine]
                dims = np.argsort(-own.var(axis=0), kind="stable").tolist() if dim else []
                for tile in str_tiles(own, dims, leaf):
                    v = np.ascontiguousarray(own[tile])
                    out.append((label, ids[mine[tile]].tolist(), v.tobytes(), v.min(axis=0).tobytes(), v.max(axis=0).tobytes()))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            yield from pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["label", "ids", "vectors", "low", "high"]).to_batches()

    return pack


class Tree:
    """Levels of boxes over the leaves of one batch, leaves first."""

    def __init__(self, batch: pa.RecordBatch, dim: int, kind: type):
        box = lambda c: np.stack([np.frombuffer(x, float).astype(kind) for x in batch.column(c).to_pylist()])
        label = batch.column(0).to_numpy()
        self.ids = [np.array(x, np.int64) for x in batch.column(1).to_pylist()]
        self.rows = [np.frombuffer(x, float).reshape(-1, dim).astype(kind) for x in batch.column(2).to_pylist()]
        self.levels = [(box(3).reshape(-1, dim), box(4).reshape(-1, dim), label, label)]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and greatest inner product of each anchor with each box, by level."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high, _, _ in self.levels]

    def best(self, ask: tuple, bounds: list, scores: Callable[[int], np.ndarray], kept: list, k: int) -> None:
        """Best-first search; ``kept`` is a heap of (score, -id), the worst first,
        of at most ``k`` distinct ids found so far for this search."""
        label, same, low, high, own = ask
        top = len(self.levels) - 1
        queue: list[tuple[float, int, int]] = []

        def offer(level: int, start: int, stop: int) -> None:
            least, most = bounds[level][0][start:stop], bounds[level][1][start:stop]
            first, last = self.levels[level][2][start:stop], self.levels[level][3][start:stop]
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            nodes = np.flatnonzero(fits & (most >= low) & (least <= high))
            for node, bound in zip((start + nodes).tolist(), np.minimum(most[nodes], high).tolist()):
                heapq.heappush(queue, (-bound, level, node))

        offer(top, 0, len(self.levels[top][0]))
        while queue:
            bound, level, node = heapq.heappop(queue)
            if len(kept) == k and -bound < kept[0][0]:
                return
            if level:
                offer(level - 1, node * FAN, (node + 1) * FAN)
                continue
            s, ids = scores(node), self.ids[node]
            floor = kept[0][0] if len(kept) == k else low
            good = np.flatnonzero((s >= max(low, floor)) & (s <= high) & (ids != own))
            if len(good) > k:
                good = good[np.lexsort((ids[good], -s[good]))]
                again = (s[good[1:]] == s[good[:-1]]) & (ids[good[1:]] == ids[good[:-1]])
                good = good[np.append(True, ~again)][:k]
            for i in good.tolist():
                entry = (int(s[i]), -int(ids[i]))
                if entry in kept:
                    continue
                if len(kept) < k:
                    heapq.heappush(kept, entry)
                elif entry > kept[0]:
                    heapq.heapreplace(kept, entry)


def _searches(block, dim: int, k: int, kind: type) -> Callable:
    """Best k rows of this task for every search of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, asks = block.value  # vectors; (search, anchor number, label, same, low, high, own id) by anchor
        anchors = anchors.astype(kind)
        kept: list[list] = [[] for _ in asks]
        for b in batches:
            for at in range(0, b.num_rows, tree_leaves(dim)):
                tree = Tree(b.slice(at, tree_leaves(dim)), dim, kind)
                bounds = tree.bounds(anchors)
                held: dict[int, np.ndarray] = {}
                now = -1
                for i, (_, anchor, *ask) in enumerate(asks):
                    if anchor != now:
                        held, now = {}, anchor
                    vector = anchors[anchor]

                    def scores(leaf: int) -> np.ndarray:
                        if leaf not in held:
                            held[leaf] = tree.rows[leaf] @ vector
                        return held[leaf]

                    tree.best(tuple(ask), [(a[anchor], z[anchor]) for a, z in bounds], scores, kept[i], k)
        found = [(asks[i][0], -e[1], e[0]) for i, heap in enumerate(kept) for e in heap]
        if found:
            yield from pa.table([pa.array(c, pa.int64()) for c in zip(*found)], names=["search", "id", "score"]).to_batches()

    return run


def whole_rows(rows: DataFrame, id_: str, label: str | Column, vector: str, step: int = 256) -> DataFrame:
    """Distinct rows (id, label, vector) that take part, components times ``step``
    as whole numbers, vectors filled with zeros to the longest."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(id_).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), v.alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    # from 2**53 on a double is a whole number
    whole = F.transform("vector", lambda x: F.when(F.abs(x * step) < 2.0**53, F.floor(x * step).cast("double")).otherwise(x * step))
    fill = F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector"))
    return rows.withColumn("vector", F.concat(whole, fill)).distinct()


def build(rows: DataFrame) -> tuple[DataFrame, int, type]:
    """The written leaves of ``rows`` (id, label, vector), the vectors' length and
    the number type that holds all scores."""
    spark = rows.sparkSession
    rows = staged(rows, "vectors")
    size = F.array_max(F.transform("vector", F.abs))
    n, dim, most = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(size)).first()
    dim, bound = dim or 0, (dim or 0) * (most or 0.0) * (most or 0.0)
    if bound >= 2.0**63:
        raise ArithmeticError("the inner products don't fit in a long")
    pack = LEAF * tree_leaves(dim)
    parts = max(1, min(partitions(spark), n // LEAST), -(-n // pack))
    dealt = rows.repartitionByRange(parts, "label", F.get("vector", F.lit(0)), "id").select("id", "label", "vector")
    with batches_of(spark, pack):
        return staged(dealt.mapInArrow(_pack(dim, LEAF), LEAVES), "leaves"), dim, float if bound < 2.0**52 else np.int64


def tree_leaves(dim: int) -> int:
    """Leaves searched together as one tree: TREE_BYTES of vectors at most."""
    return max(1, min(TREE, TREE_BYTES // (LEAF * 8 * max(1, dim))))


def search(leaves: DataFrame, dim: int, kind: type, asks: DataFrame, k: int) -> DataFrame:
    """For every row of ``asks`` (search, anchor, vector, label, same, low, high)
    its first k rows of the index: of the same label or of others, but for the
    anchor's own id, with a score from low to high: search, id, score, rank."""
    spark = leaves.sparkSession
    asks = staged(asks, "asks")
    n = asks.select("anchor").distinct().count()
    blocks = max(1, -(-n * max(1, dim) * 8 // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks))
    found = None
    for i in range(blocks):
        mine = asks.where(block == i).orderBy("anchor", "search").toPandas()
        at, first = pd.factorize(pd.Series(list(zip(mine["anchor"], map(bytes, map(np.array, mine["vector"]))))))
        vectors = np.array([np.frombuffer(v, float) for _, v in first], float).reshape(len(first), dim)
        by = np.argsort(at, kind="stable")
        rows = list(zip(mine["search"], at, mine["label"], mine["same"], mine["low"], mine["high"], mine["anchor"]))
        sent = spark.sparkContext.broadcast((vectors, [tuple(x.item() if hasattr(x, "item") else x for x in rows[j]) for j in by]))
        with batches_of(spark, tree_leaves(dim)):
            part = staged(leaves.mapInArrow(_searches(sent, dim, k, kind), FOUND), "found")
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("search").orderBy(F.desc("score"), "id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int, positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5), id_: str = "vec_id", label: str | Column = "label", vector: str = "embedding") -> DataFrame:
    """Of every row whose id is divisible by ``every`` the first ``positives``
    rows of its label, and for each of these the first ``negatives`` rows of other
    labels whose score is at most the positive's and at least ``least`` (a
    fraction) of it: anchor_id, positive_id, rank, negative_id, both scores."""
    rows = staged(whole_rows(rows, id_, label, vector), "rows")
    leaves, dim, kind = build(rows)
    everything = F.lit(2**62)
    anchors = rows.where(F.col("id") % every == 0).select(F.monotonically_increasing_id().alias("first"), F.col("id").alias("anchor"), "vector", "label")
    anchors = staged(anchors, "anchors")  # written, so that the numbers stay
    asks = anchors.select(F.col("first").alias("search"), "anchor", "vector", "label", F.lit(True).alias("same"), (-everything).alias("low"), everything.alias("high"))
    near = search(leaves, dim, kind, asks, positives).select(F.col("search").alias("first"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = staged(anchors.join(near, "first"), "pairs")
    over, under = least
    low = F.expr(f"(positive_score div {under}) * {over} + ((positive_score % {under}) * {over} + {under - 1}) div {under}")  # the share, rounded up
    windows = pairs.where("positive_score >= 0").select("first", "anchor", "vector", "label", "positive_score").distinct()
    windows = windows.select(F.monotonically_increasing_id().alias("search"), "*", F.lit(False).alias("same"), low.alias("low"), F.col("positive_score").alias("high"))
    windows = staged(windows, "windows")
    found = search(leaves, dim, kind, windows.drop("first", "positive_score"), negatives).select("search", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = found.join(windows.select("search", "first", "positive_score"), "search")
    named = pairs.select("first", F.col("anchor").alias("anchor_id"), "positive_id", "positive_score")
    return named.join(found, ["first", "positive_score"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score").distinct()
