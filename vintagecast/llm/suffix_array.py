"""Benchmark decontamination by suffix arrays over the training text.

The documents are cut into shards (runs of rows of about SHARD_BYTES of text,
a longer document alone), and each task builds, shard by shard, a suffix array
over the words: all suffixes sorted, as deep as the longest benchmark item.
Every window of a benchmark item (the first words of each of its suffixes) is
then looked up by binary search; the range found holds the places of all its
occurrences, and runs of windows that go on in step are the longest verbatim
matches.  The benchmark is the query set: it goes to the executors in blocks of
at most BLOCK_BYTES of text, one pass over the documents for each block; nothing
is shuffled, whatever the number of documents that hold a passage.

Words are maximal runs of ASCII digits and letters and of all characters beyond
ASCII, A-Z lower-cased; two words are the same if their 64-bit hashes are.  A
window has ``window`` consecutive words of an item; an item of fewer words is
one window, an item without words has none.

Defined results: a null or empty text has no words and no hits; equal documents
get equal rows, one each; items that share an id count as one item with the
windows of all; an item without id counts under the empty name; empty tables
give no hits; other columns are left alone.  A passage is looked for inside
one document only.  Very long texts need memory for their words (about 60 bytes
a word), in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, running_total, staged
from .shingles import text_buffer
from .words import byte_class, hashes, places

WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Text of one shard and of one block of benchmark items.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 2 << 20
#: Rows of one batch of documents on its way to Python.
ROWS = 1_000

SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
MATCHES = pa.list_(pa.struct([("item", pa.string()), ("item_at", pa.int32()), ("doc_at", pa.int32()), ("words", pa.int32())]))
FOUND = "spans array<struct<first:int,last:int>>, matches array<struct<item:string,item_at:int,doc_at:int,words:int>>, n_words long"


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places of ``text`` (numbers from 0, as if followed by zeros) sorted by the
    suffix that begins there, as far as its first ``depth`` words; the sorted keys of the first words of
    each, how many words a key has and how many bits each of them."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length()) if n else 1
    packed = max(1, min(depth, 62 // bits))
    key = np.zeros(n, np.int64)
    for j in range(packed):
        key <<= bits
        key[: max(0, n - j)] |= text[j:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    place = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    have = packed
    while have < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        at = order[tied]
        first, second = rank[at], rank[np.minimum(at + have, n)]
        by = np.argsort(first * (n + 1) + second + 1, kind="stable")
        order[tied] = at[by]
        first, second = first[by], second[by]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new[tied] = fresh
        rank[order[tied]] = np.maximum.accumulate(np.where(fresh, tied, 0))
        have *= 2
    return order, key, packed, bits


def lookup(text: np.ndarray, order: np.ndarray, key: np.ndarray, packed: int, bits: int, asked: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``asked`` (its first ``length`` numbers) the range of the
    suffix array whose suffixes begin so."""
    low, high = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    full = (1 << bits) - 1
    for j in range(packed):
        known = length > j
        word = asked[:, j] if j < asked.shape[1] else 0
        low = (low << bits) | np.where(known, word, 0)
        high = (high << bits) | np.where(known, word, full)
    low, high = np.searchsorted(key, low, "left"), np.searchsorted(key, high, "right")
    width = asked.shape[1]
    tail = np.concatenate([text, np.zeros(width, text.dtype)])
    steps, counts = np.arange(width), (np.arange(width) < length[:, None])

    def side(lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            there, mine = tail[order[mid][:, None] + steps], asked[open_]
            other = (there != mine) & counts[open_]
            at = other.argmax(axis=1)
            rows = np.arange(len(open_))
            differ = other[rows, at]
            right = np.where(differ, there[rows, at] < mine[rows, at], after)
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)

    longer = np.flatnonzero((length > packed) & (low < high))
    if len(longer):
        counts, asked = counts[longer], asked[longer]
        a, b = low[longer], high[longer]
        low[longer], high[longer] = side(a, b, False), side(a, b, True)
    return low, high


class Windows:
    """The distinct windows of a block of items, and which items hold them where."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window, self.longest, self.names = window, 1, []
        rows, lengths, owner, at, own = [], [], [], [], []
        numbers: dict[str, int] = {}
        for name, text in items:
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            starts, ends, _ = places(data, np.array([0, len(data)]), WORD)
            if not len(starts):
                continue
            words = hashes(data, starts, ends)
            self.longest = max(self.longest, len(words))
            own.append(numbers.setdefault(name, len(numbers)))
            for i in range(max(1, len(words) - window + 1)):
                w = words[i : i + window]
                rows.append(np.pad(w, (0, window - len(w))))
                lengths.append(len(w))
                owner.append(len(own) - 1)
                at.append(i)
        self.names, self.item = list(numbers), np.array(own, np.int64)
        every = np.array(rows, np.uint64).reshape(-1, window)
        lengths = np.array(lengths, np.int64)
        both = np.concatenate([every, lengths[:, None].astype(np.uint64)], axis=1)
        unique, inverse = np.unique(both, axis=0, return_inverse=True)
        self.words, self.lengths = unique[:, :window], unique[:, window].astype(np.int64)
        by = np.argsort(inverse.ravel(), kind="stable")
        self.row, self.at = np.array(owner, np.int64)[by], np.array(at, np.int64)[by]
        self.first = np.searchsorted(inverse.ravel()[by], np.arange(len(unique) + 1))

    def find(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, place) pairs in a shard: ``words`` are the hashes of its
        words, ``at`` the first word of each text (one more at the end)."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(words) or not len(self.words):
            return none
        vocabulary, number = np.unique(words, return_inverse=True)
        place = np.minimum(np.searchsorted(vocabulary, self.words), len(vocabulary) - 1)
        used = np.arange(self.window) < self.lengths[:, None]
        live = np.flatnonzero(((vocabulary[place] == self.words) | ~used).all(axis=1))
        if not len(live):
            return none
        # a 0 after each text keeps a match inside it
        text = np.zeros(len(words) + len(at) - 1, np.int64)
        shift = np.arange(len(words)) + np.repeat(np.arange(len(at) - 1), np.diff(at))
        text[shift] = number + 1
        order, key, packed, bits = suffix_array(text, self.longest)
        asked = np.where(used, place + 1, 0)[live]
        low, high = lookup(text, order, key, packed, bits, asked, self.lengths[live])
        n = high - low
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        found = order[np.repeat(low, n) + inside]
        back = np.cumsum(text != 0) - 1  # the word's number without the zeros
        return np.repeat(live, n), back[found]

    def matches(self, window: np.ndarray, place: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The longest match of each (text, item): rows (text, item, place in the
        item, place among the shard's words, words); the first of equal ones."""
        n = self.first[window + 1] - self.first[window]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        entry = np.repeat(self.first[window], n) + inside
        place, text, size = np.repeat(place, n), np.repeat(text, n), np.repeat(self.lengths[window], n)
        row, at = self.row[entry], self.at[entry]
        by = np.lexsort((at, place - at, row, text))
        place, text, size, row, at = place[by], text[by], size[by], row[by], at[by]
        step = np.ones(len(by), bool)
        step[1:] = (text[1:] != text[:-1]) | (row[1:] != row[:-1]) | (place[1:] - at[1:] != place[:-1] - at[:-1]) | (at[1:] != at[:-1] + 1)
        run = np.flatnonzero(step)
        words = np.diff(np.append(run, len(by))) + size[run] - 1
        found = np.stack([text[run], self.item[row[run]], at[run], place[run], words], axis=1).reshape(-1, 5)
        found = found[np.lexsort((found[:, 3], found[:, 2], -found[:, 4], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)
        first[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])
        return found[first]


def spans(marks: np.ndarray) -> list[tuple[int, int]]:
    """Runs of marked words as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def longest_of(matches: list[tuple]) -> list[tuple]:
    """The longest match of each item (the first of equal ones)."""
    best: dict[str, tuple] = {}
    for m in matches:
        if m[0] not in best or m[3] > best[m[0]][3]:
            best[m[0]] = m
    return list(best.values())


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in runs of about SHARD_BYTES of text (column 1)."""
    held, size = [], 0
    for b in batches:
        data, offsets = text_buffer(b.column(1))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SHARD_BYTES - size, "right")) - 1)
            held.append(b.slice(i, j - i))
            size += int(offsets[j] - offsets[i])
            i = j
            if size >= SHARD_BYTES or i < b.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
    pa.default_memory_pool().release_unused()


def _found(windows: Windows, shard: pa.Table) -> tuple[np.ndarray, list[list], list[list]]:
    """Of each text of the shard: number of words, spans of hit words, matches."""
    data, offsets = text_buffer(shard.column(1).combine_chunks())
    base, end = int(offsets[0]), int(offsets[-1])
    data, offsets = data[base:end], offsets - base
    starts, ends, at = places(data, offsets, WORD)
    window, place = windows.find(hashes(data, starts, ends), at)
    hit: list[list] = [[] for _ in range(shard.num_rows)]
    held: list[list] = [[] for _ in range(shard.num_rows)]
    if len(place):
        text = np.searchsorted(at, place, "right") - 1
        step = np.zeros(len(starts) + 1, np.int64)
        np.add.at(step, place, 1)
        np.add.at(step, place + windows.lengths[window], -1)
        marks = np.cumsum(step[:-1]) > 0
        for t in np.unique(text).tolist():
            hit[t] = spans(marks[at[t] : at[t + 1]])
        for t, item, item_at, doc_at, words in windows.matches(window, place, text).tolist():
            held[t].append((windows.names[item], item_at, doc_at - int(at[t]), words))
    return np.diff(at), hit, held


def _search(block, keep_text: bool) -> Callable:
    """A pass over rows (id, text[, spans, matches so far])."""
    names = ["doc_id", *(["text"] if keep_text else []), "spans", "matches", "n_words"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block.value
        for shard in _shards(batches):
            n, hit, held = _found(windows, shard)
            if "spans" in shard.column_names:  # of the passes before
                for i, (s, m) in enumerate(zip(shard["spans"].to_pylist(), shard["matches"].to_pylist())):
                    if s:
                        marks = np.zeros(int(n[i]), bool)
                        for x in [*s, *({"first": a, "last": b} for a, b in hit[i])]:
                            marks[x["first"] : x["last"] + 1] = True
                        hit[i] = spans(marks)
                    if m:
                        held[i] = longest_of([tuple(x[c] for c in ("item", "item_at", "doc_at", "words")) for x in m] + held[i])
            spans_ = [[{"first": a, "last": b} for a, b in s] for s in hit]
            matches = [[dict(zip(("item", "item_at", "doc_at", "words"), m)) for m in ms] for ms in held]
            columns = [shard.column(0), *([shard.column(1)] if keep_text else []), pa.array(spans_, SPANS), pa.array(matches, MATCHES), pa.array(n.astype(np.int64))]
            yield from pa.table(columns, names=names).to_batches()

    return search


def _drop(block) -> Callable:
    """Rows without a hit; the text is column 1 of what is looked at."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            _, hit, _ = _found(block.value, shard)
            yield from shard.filter(pa.array([not h for h in hit], pa.bool_())).to_batches()

    return drop


def item_blocks(items: DataFrame, id_: str, text: str) -> tuple[DataFrame, list[int]]:
    """The items (item, words) with the number of their block, and all numbers:
    blocks of at most BLOCK_BYTES of text (a longer item alone)."""
    named = F.coalesce(F.col(id_).cast("string"), F.lit("")).alias("item")
    items = items.select(named, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("words")).distinct()
    items = running_total(items, [F.col("item"), F.col("words")], F.octet_length("words").cast("long"), "_before", "items")
    items = staged(items.withColumn("_block", F.floor(F.col("_before") / BLOCK_BYTES)), "item_blocks")
    return items, [r[0] for r in items.select("_block").distinct().orderBy("_block").collect()]


def _passes(rows: DataFrame, items: DataFrame, window: int, id_: str, text: str, one_pass: Callable[[DataFrame, object, bool], DataFrame], name: str) -> DataFrame:
    """``rows`` through one written pass for each block of items."""
    spark = rows.sparkSession
    items, numbers = item_blocks(items, id_, text)
    for number in numbers or [None]:
        held = items.where(F.col("_block") == number).orderBy("item", "words").collect() if numbers else []
        block = spark.sparkContext.broadcast(Windows([(r["item"], r["words"]) for r in held], window))
        with batches_of(spark, ROWS):
            rows = staged(one_pass(rows, block, number == (numbers or [None])[-1]), name)
        block.unpersist()
    return rows


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its id, n_words, spans (first and last word of each
    run of hit words) and matches (the longest match of each item that has an
    occurring window: item, item_at, doc_at, words)."""
    rows = docs.select(F.col(id_).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def one_pass(rows: DataFrame, block, last: bool) -> DataFrame:
        return rows.drop("n_words").mapInArrow(_search(block, not last), f"doc_id {kind}, {'' if last else 'text string, '}{FOUND}")

    return _passes(rows, items, window, item_id, item_text, one_pass, "contamination")


def decontaminated(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any hit word, with all their columns."""
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text]) if len(docs.columns) > 1 else F.struct(F.lit(0))
    rows = docs.select(rest.alias("rest"), F.col(text).cast("string").alias("text"))
    rows = _passes(rows, items, window, item_id, item_text, lambda rows, block, _: rows.mapInArrow(_drop(block), rows.schema), "decontaminated")
    return rows.select(*[F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """Counts of a ``contamination`` result: n_words, n_hit, n_items, the digest
    of the items' names and whether there is any hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
