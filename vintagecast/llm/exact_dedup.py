"""Exact dedup by content-defined chunk recipes.

Each text, without its white space, is cut where a rolling hash of its last
bytes says so, so equal texts are cut alike wherever they came from.  Chunks
are deduplicated to verified identifiers (a 64-bit key, replaced by the digest
where one key stands for two contents) and texts are compared by their ordered
identifier lists alone: a text's bytes are read once and never moved.

Defined cases: null text counts as empty; empty texts (also those of white
space only) are equal to each other; a null ``doc_id`` sorts after all others
as keeper; rows that repeat a ``doc_id`` are separate rows of which the first
in the order stays; an empty table gives an empty result; other columns of the
input don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, small_batches, staged
from .shingles import slices, text_buffer

SPACE = b" \t\n\x0b\x0c\r"
_GEAR = np.random.default_rng(0xC0C).integers(0, 2**32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE)] = True
LEAST, MASK_BITS, MOST = 512, 11, 16384
_BLOCK = 1 << 20


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 32 bytes ends a chunk."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):  # h[i] = sum of gear[data[i - j]] << j over j < 2 * step
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1


def chunk_ends(cuts: np.ndarray, start: int, end: int) -> list[int]:
    """Ends of the chunks of ``[start, end)``: the first cut at least LEAST after
    the last end, or MOST after it.  Cuts hang only on bytes of this text."""
    ends, at = [], start
    while at < end:
        k = int(np.searchsorted(cuts, at + LEAST))
        at = min(end, at + MOST, int(cuts[k]) if k < len(cuts) else end)
        ends.append(at)
    return ends


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        data, off = text_buffer(b.column("text"))
        keep = ~_SPACE[data]
        i, n = 0, b.num_rows
        shas, keys, digests, sizes = [], [], [], []
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + _BLOCK, "right")) - 1)
            part = keep[off[i] : off[j]]
            norm = data[off[i] : off[j]][part]
            at = np.concatenate(([0], np.cumsum(part, dtype=np.int64)))[off[i : j + 1] - off[i]]
            cuts, raw = cut_points(norm), norm.tobytes()
            for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                shas.append(hashlib.sha256(raw[s:e]).hexdigest())
                own, last = [], s
                for x in chunk_ends(cuts[np.searchsorted(cuts, s) : np.searchsorted(cuts, e, "right")], s, e):
                    own.append(hashlib.blake2b(raw[last:x], digest_size=24).digest())
                    last = x
                keys.append([int.from_bytes(d[:8], "little", signed=True) for d in own])
                digests.append([d[8:] for d in own])
                sizes.append(e - s)
            i = j
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("chars"), pa.array(shas, pa.string()), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(digests, pa.list_(pa.binary()))],
            names=["doc_id", "chars", "text_sha256", "size", "keys", "digests"],
        )


def recipes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, chars (code points of the original),
    text_sha256, size, and its chunks' keys and digests in order."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), "text")
    schema = "doc_id long, chars long, text_sha256 string, size long, keys array<long>, digests array<binary>"
    return small_batches(narrow).mapInArrow(_recipes, schema)


def verified(rows: DataFrame) -> DataFrame:
    """Chunk keys that stand for more than one content (by a second, 128-bit
    digest).  Partial aggregation, a row per distinct key."""
    chunks = rows.select(F.explode(F.arrays_zip("keys", "digests")).alias("c"))
    return chunks.groupBy(F.col("c.keys").alias("key")).agg(F.min("c.digests").alias("lo"), F.max("c.digests").alias("hi")).where("lo != hi").select("key")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, chars, n_chunks.

    Rows are one group when their identifier lists are the same.  Of a group the
    row with most code points, then the smallest doc_id, stays.  Both sides of
    the join are plain shuffles of narrow rows, which AQE splits where one group
    holds much of the table."""
    rows = staged(recipes(docs).withColumn("_row", F.monotonically_increasing_id()), "recipes")
    if verified(rows).isEmpty():
        ids = F.transform("keys", lambda k: k.cast("string"))
    else:  # a key stands for two contents: spell every identifier out with its digest
        ids = F.transform(F.arrays_zip("keys", "digests"), lambda c: F.concat(c["keys"].cast("string"), F.lit(":"), F.hex(c["digests"])))
    rows = rows.select("doc_id", "chars", "text_sha256", "size", F.size("keys").cast("long").alias("n_chunks"), F.array_join(ids, ",").alias("recipe"), "_row")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), "doc_id", "_row"))
    groups = staged(rows.groupBy("size", "recipe").agg(best.alias("_best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return rows.join(groups, ["size", "recipe"]).select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_best._row")).alias("kept"), "text_sha256", "chars", "n_chunks",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat another's text: of each group the
    row that stays, with all columns of ``docs``.  Texts move only if the kept
    keys are too many to broadcast."""
    kept = staged(exact_groups(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("chars").alias("_chars")), "kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""), 256)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (sha == F.col("_sha")) & (F.length(text) == F.col("_chars"))
    out = docs.join(small(kept), same, "left_semi")
    if out.groupBy("doc_id").count().where("count > 1").isEmpty():
        return out
    return out.withColumn("_sha", sha).dropDuplicates(["doc_id", "_sha"]).drop("_sha")  # rows that repeat a doc_id and its text
