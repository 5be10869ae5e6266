"""Packing tokenised documents into windows by best-fit decreasing.

A document is cut into full windows and a rest.  The rests, longest first, go
to the open window with the least room that still holds them, found by a
segment tree indexed by room.  Rests are dealt to groups of bounded size by a
hash, so groups are packed apart; each leaves only its last windows unfilled.

Defined cases: null or empty text is the end id alone; rows that repeat a
``doc_id`` are packed each; a null ``doc_id`` stays null; an empty table gives
an empty result; columns other than doc_id and text don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, scratch, small_batches
from .encode import encoder
from .shingles import slices

WINDOW, END_ID = 2048, 1
#: Pieces packed together at most (about), and at least where there are enough.
GROUP, LEAST_GROUP = 50_000, 10_000
_NULL = -(2**63)


class RoomTree:
    """Open windows by room (0 to ``window``): a segment tree of how many there
    are, with a stack of windows at each leaf."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.open[i] += n
            i >>= 1

    def push(self, room: int, window: int) -> None:
        self.stacks[room].append(window)
        self._add(room, 1)

    def pop_tightest(self, length: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``length``, taken out."""
        i, open_ = length + self.leaves, self.open
        while not open_[i]:
            while i & 1:  # a right child: nothing further right below this parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if open_[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return room, self.stacks[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; ``lengths`` must descend."""
    tree, where, offset, n = RoomTree(window), [], [], 0
    for length in lengths.tolist():
        found = tree.pop_tightest(length) if length < window else None
        if found is None:
            room, at, n = window, n, n + 1
        else:
            room, at = found
        where.append(at)
        offset.append(window - room)
        if room > length:
            tree.push(room - length, at)
    return np.array(where, np.int64), np.array(offset, np.int64)


def _cut(path: str, window: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            docs, starts, lengths, crcs, totals, ids_out = [], [], [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(enc.encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                for s in range(0, len(ids), window):
                    raw = ids[s : s + window].tobytes()
                    docs.append(doc)
                    starts.append(s)
                    lengths.append(len(raw) // 4)
                    crcs.append(zlib.crc32(raw))
                    totals.append(len(ids))
                    if with_ids:
                        ids_out.append(raw)
            cols = [pa.array(x, pa.int64()) for x in (docs, starts, lengths, crcs, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids_out, pa.binary())] * with_ids, names + ["ids"] * with_ids)
        enc.forget()

    return cut


def cut_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of every document's ids: full windows, then the rest."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(tokenizer, window, end_id, with_ids), schema)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and ids as little-endian uint32).  Only lengths are shuffled."""
    spark = docs.sparkSession
    path = scratch(spark, "pieces")
    cut_documents(docs, tokenizer, window, end_id, with_ids).withColumn("piece", F.monotonically_increasing_id()).write.parquet(path)
    pieces = spark.read.parquet(path)
    n = pieces.count()
    groups = max(1, -(-n // GROUP), min(partitions(spark), n // LEAST_GROUP))
    narrow = pieces.drop("ids") if with_ids else pieces
    narrow = narrow.withColumn("group", F.pmod(F.xxhash64("piece", "doc_id", "start"), F.lit(groups)))

    def place(key: tuple[Any, ...], p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["length", "doc_id", "start", "piece"], ascending=[False, True, True, True], kind="stable")
        where, p["offset"] = best_fit(p["length"].to_numpy(), window)
        p["sequence_id"] = (int(key[0]) << 32) + where
        return p[fields]

    schema = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    fields = [x.split()[0] for x in schema.split(", ")]
    # a null doc_id would turn the column to floats in pandas
    packed = narrow.withColumn("doc_id", F.coalesce("doc_id", F.lit(_NULL))).groupBy("group").applyInPandas(place, schema)
    packed = packed.withColumn("doc_id", F.nullif("doc_id", F.lit(_NULL)))
    if with_ids:
        packed = packed.join(pieces.select("piece", "ids"), "piece")
    return packed.drop("piece")


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves from ``pack(..., with_ids=True)``: sequence_id,
    the ids of its pieces in order, and the pieces' documents with offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))  # a window: at most ``window`` pieces
    seq = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return seq.select(
        "sequence_id", F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("hex"),
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("spans"),
    ).select("sequence_id", F.unhex("hex").alias("ids"), "spans")
