"""Approximate nearest neighbours by multi-probe p-stable hashing.

Largest inner product is reduced to least Euclidean distance: vectors are
scaled by the largest norm and get one more component that brings them to
length 1.  A table hashes a vector by ``HASHES`` Gaussian (2-stable)
projections, each cut into cells of ``width``.  A query looks into its own
bucket and into those with some of its cells moved by one, in the order of the
estimated chance that a neighbour lies there (squared distances to the cell
walls); what the tables find is merged and ranked by exact inner products in
double precision.

How many probes are needed is measured: for CALIBRATION queries the exact
neighbours among all rows are found in blocks, and the fewest probes are taken
that find RECALL of them (with wider cells if none do).  Every row is indexed.
Rows are dealt evenly to shards, each with tables of its own, so equal or near
vectors never meet in one place because of their hash; query blocks of bounded
size go to every shard.  Equal vectors are one entry with the ``k + 1``
smallest ids, which is all a list can hold of them.  A query for which the
tables find fewer than k entries is answered exactly, in blocks.

Defined cases: rows with a null id, and vectors that are null, empty, zero or
hold null or non-finite components, take no part; vectors of another length
than the commonest (ties: the longer) neither; ties go to the smaller id; a
repeated id with equal vectors counts once, with several vectors by its best
score; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, small, staged

TABLES, HASHES, WIDTHS = 8, 12, (2.5, 3.5, 5.0, 8.0)
PROBES = (32, 64, 96, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048)
CALIBRATION, RECALL = 96, 0.955
#: Rows of a shard at least (where the cluster has tasks for them) and at most; queries of a block.
SHARD_LEAST, SHARD_MOST, BLOCK = 2_048, 65_536, 32_768
SALTS = 64


def probe_template(hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` best sets of moves, by rank of the wall distances, with the
    expected squared distance for each rank: rank j and rank 2 * hashes - 1 - j are the
    two walls of one cell, of which at most one is crossed.  Rows are padded
    with ``2 * hashes``, a move that does nothing."""
    m = hashes
    j = np.arange(1, 2 * m + 1, dtype=float)
    up = 2 * m + 1 - j
    expected = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - up / (m + 1) + up * (up + 1) / (4 * (m + 1) * (m + 2)))
    sets: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(sets) < probes:
        cost, moves = heapq.heappop(heap)
        last = moves[-1]
        if len({min(x, 2 * m - 1 - x) for x in moves}) == len(moves):
            sets.append(moves)
        if last + 1 < 2 * m:  # move the last one on; or add the next
            heapq.heappush(heap, (cost - expected[last] + expected[last + 1], (*moves[:-1], last + 1)))
            heapq.heappush(heap, (cost + expected[last + 1], (*moves, last + 1)))
    out = np.full((len(sets), max(1, max(map(len, sets)))), 2 * m)
    for i, moves in enumerate(sets):
        out[i, : len(moves)] = moves
    return out


class Hashing:
    """The tables' projections; bucket keys are linear in the cell numbers, so a
    move adds a constant."""

    def __init__(self, dim: int, longest: float, width: float, probes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.longest, self.width = longest, width
        self.axes = rng.normal(size=(TABLES, dim + 1, HASHES))
        self.shift = rng.uniform(0, width, (TABLES, HASHES))
        self.odd = rng.integers(1, 2**63, (TABLES, HASHES), dtype=np.uint64) | np.uint64(1)
        self.more = probe_template(HASHES, 2 * probes)  # the best by expectation, of which the best by this query's walls are taken
        self.probes = probes

    def _cells(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (x @ self.axes[table] + self.shift[table]) / self.width
        cell = np.floor(at)
        keys = (cell.astype(np.int64).astype(np.uint64) * self.odd[table]).sum(axis=1, dtype=np.uint64)
        return keys, at - cell, cell

    def row_keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        x = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
        x = np.column_stack((x, rest))
        return [self._cells(x, t)[0] for t in range(TABLES)]

    def query_keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Per table: (queries, probes) bucket keys."""
        x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        x = np.column_stack((x, np.zeros(len(x))))
        out = []
        for t in range(TABLES):
            keys, low, _ = self._cells(x, t)
            walls = np.column_stack((low, 1 - low)) ** 2
            order = np.argsort(walls, axis=1)
            moves = np.concatenate((np.zeros(HASHES, np.uint64) - self.odd[t], self.odd[t]))
            none = np.zeros((len(x), 1))
            cost = np.column_stack((np.take_along_axis(walls, order, 1), none))[:, self.more].sum(axis=2)
            added = np.column_stack((moves[order], none.astype(np.uint64)))[:, self.more].sum(axis=2, dtype=np.uint64)
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            out.append(keys[:, None] + np.take_along_axis(added, best, 1))
        return out


def matrix(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        line = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= line)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))][:k]


FOUND = "query long, entry long, score double"


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    query = np.repeat(np.array([q for q, _, _ in rows], np.int64), [len(e) for _, e, _ in rows])
    join = lambda i, t: np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, t)
    return pa.table({"query": query, "entry": join(1, np.int64), "score": join(2, float)})


def _search(hashing, keep: int):
    """Probes one shard's tables for one block of queries."""

    def search(t: pa.Table) -> pa.Table:
        h = hashing.value
        ids, kind, vectors = t.column("id").to_numpy(), t.column("is_query").to_numpy(zero_copy_only=False), matrix(t.column("vector"))
        rows, queries = vectors[~kind], vectors[kind]
        row_ids, query_ids = ids[~kind], ids[kind]
        if not len(rows) or not len(queries):
            return _found([])
        near = rows.astype(np.float32)
        slack = 1e-5 * np.linalg.norm(rows, axis=1).max()
        tables = []
        for keys in h.row_keys(rows):
            order = np.argsort(keys, kind="stable")
            unique, first, count = np.unique(keys[order], return_index=True, return_counts=True)
            tables.append((order, unique, first, count))
        out = []
        for at in range(0, len(queries), 64):
            block = queries[at : at + 64]
            probes = h.query_keys(block)
            hits = []
            for (order, unique, first, count), keys in zip(tables, probes):
                place = np.minimum(np.searchsorted(unique, keys), len(unique) - 1)
                hits.append((order, first, count, place, unique[place] == keys))
            for i, q in enumerate(block):
                seen = np.zeros(len(rows), bool)
                for order, first, count, place, hit in hits:
                    p = place[i][hit[i]]
                    n = count[p]
                    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    seen[order[np.repeat(first[p], n) + inside]] = True
                mine = np.flatnonzero(seen)
                rough = near[mine] @ q.astype(np.float32)
                if len(mine) > keep:  # exact products only for what can be among the best
                    line = np.partition(rough, len(mine) - keep)[len(mine) - keep]
                    mine = mine[rough >= line - slack * np.linalg.norm(q)]
                scores = rows[mine] @ q
                top = best_of(row_ids[mine], scores, keep)
                out.append((int(query_ids[at + i]), row_ids[mine[top]], scores[top]))
        return _found(out)

    return search


def _exact(queries, keep: int):
    """The best of every batch of rows for a bounded block of queries."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = queries.value
        for b in batches:
            rows, row_ids = matrix(b.column(1)), b.column(0).to_numpy()
            if not len(rows):
                continue
            out = []
            for at in range(0, len(ids), 256):
                scores = vectors[at : at + 256] @ rows.T
                for i, s in enumerate(scores):
                    top = best_of(row_ids, s, keep)
                    out.append((int(ids[at + i]), row_ids[top], s[top]))
            yield from _found(out).to_batches()

    return exact


def _best(found: DataFrame, keep: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def exact_best(entries: DataFrame, queries: pd.DataFrame, keep: int) -> DataFrame:
    """Exact answers of at most BLOCK queries (id, vector) over all entries."""
    spark = entries.sparkSession
    block = spark.sparkContext.broadcast((queries["id"].to_numpy(np.int64), np.array(queries["vector"].tolist(), float)))
    return _best(entries.select("id", "vector").mapInArrow(_exact(block, keep), FOUND), keep)


def clean(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """Rows (id, vector as doubles) that take part."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(id_).cast("long").alias("id"), v.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where("id IS NOT NULL AND vector IS NOT NULL").where(F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


def entries_of(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors: id (the smallest), vector, members (the ``keep`` smallest
    ids, ascending).  Salted, so that a vector which many rows share is trimmed
    in many places first."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    first = F.row_number().over(Window.partitionBy("vector", "salt").orderBy("id"))
    rows = rows.distinct().withColumn("salt", salt).withColumn("r", first).where(F.col("r") <= keep)
    then = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = rows.drop("salt", "r").withColumn("r", then).where(F.col("r") <= keep)
    return rows.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("members")).select(F.col("members")[0].alias("id"), "vector", "members")


def calibrated(entries: DataFrame, n: int, dim: int, longest: float, k: int) -> Hashing:
    """Hashing with the fewest probes that find RECALL of the exact neighbours
    of a bounded sample of queries."""
    pick = entries.select("id", "vector").orderBy(F.xxhash64("id")).limit(CALIBRATION).toPandas()
    truth = exact_best(entries, pick, k + 1).where("query <> entry").toPandas()
    wanted = staged(entries.sparkSession.createDataFrame(truth[["entry"]].drop_duplicates(), "entry long"), "truth")
    known = entries.join(small(wanted), F.col("id") == F.col("entry"), "left_semi").select("id", "vector").toPandas()  # at most CALIBRATION * k
    vectors = dict(zip(known["id"], known["vector"]))
    queries = dict(zip(pick["id"], pick["vector"]))
    for width in WIDTHS:
        h = Hashing(dim, longest, width, PROBES[-1])
        if not len(truth):
            return Hashing(dim, longest, width, PROBES[0])
        ids = list(queries)
        asked = h.query_keys(np.array([queries[i] for i in ids], float))
        held = h.row_keys(np.array([vectors[i] for i in truth["entry"]], float))
        at = np.array([ids.index(q) for q in truth["query"]])
        need = np.full(len(truth), PROBES[-1] + 1)
        for keys, own in zip(asked, held):
            same = keys[at] == own[:, None]
            need = np.minimum(need, np.where(same.any(axis=1), same.argmax(axis=1) + 1, PROBES[-1] + 1))
        for probes in PROBES:
            if (need <= probes).mean() >= RECALL:
                return Hashing(dim, longest, width, probes)
    return h


def nearest(rows: DataFrame, every: int, id_: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """The k nearest rows by inner product of every row whose id is divisible by
    ``every``, but for the row itself: query_id, rank, vec_id, score."""
    spark, keep = rows.sparkSession, k + 1
    rows = staged(clean(rows, id_, vector), "vectors")
    entries = staged(entries_of(rows, keep), "entries")
    n = entries.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    dim = entries.select(F.size("vector")).first()[0]
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    longest = float(entries.agg(F.max(norm)).first()[0])
    hashing = spark.sparkContext.broadcast(calibrated(entries, n, dim, longest, k))

    asks = rows.where(F.col("id") % every == 0).withColumnRenamed("id", "query_id")
    own = entries.select(F.col("id").alias("query"), F.col("vector").alias("_v"))
    asks = staged(asks.join(own, F.col("vector") == F.col("_v")).select("query_id", "query").distinct(), "asks")
    n_queries = asks.select("query").distinct().count()
    shards = max(1, -(-n // SHARD_MOST), min(partitions(spark), n // SHARD_LEAST))
    blocks = max(1, -(-n_queries // BLOCK))
    all_of = lambda m, c: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(c)
    place = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    index = entries.select("id", "vector", F.lit(False).alias("is_query"), place(shards, 1).alias("shard"), all_of(blocks, "block"))
    queries = entries.join(asks.select("query").distinct(), F.col("id") == F.col("query"), "left_semi")
    asked = queries.select("id", "vector", F.lit(True).alias("is_query"), place(blocks, 2).alias("block"), all_of(shards, "shard"))
    found = index.unionByName(asked).groupBy("shard", "block").applyInArrow(_search(hashing, keep), FOUND)
    found = staged(_best(found, keep), "found")

    enough = min(keep, n)
    short = queries.select("id", "vector").join(found.groupBy("query").count().where(f"count >= {enough}"), F.col("id") == F.col("query"), "left_anti")
    short = staged(short, "short")
    left = short.count()
    for i in range(-(-left // BLOCK)):
        mine = short.where(F.pmod(F.xxhash64("id"), F.lit(-(-left // BLOCK))) == i).toPandas()
        found = found.join(spark.createDataFrame(mine[["id"]]), F.col("query") == F.col("id"), "left_anti").unionByName(exact_best(entries, mine, keep))

    held = found.join(entries.select(F.col("id").alias("entry"), "members"), "entry").select("query", "score", F.explode("members").alias("vec_id"))
    pairs = asks.join(held, "query").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
