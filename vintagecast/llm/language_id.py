"""Language identification by Bayesian fusion of evidence.

posterior(language) ~ prior(language | host) * P(text | language)
                      * P(declared markup language | language)
                      * P(address suffix | language)

* Text: naive Bayes over byte trigrams of the whole text (letters in lower
  case, everything else one blank), trained here on a bounded sample of
  labelled rows.  One more class, ``und``, gives every trigram number the same
  probability; it wins where most of a text is like none of the languages.
* Labels and declared languages are folded to their primary subtag (``en-US``
  and ``en_GB`` are ``en``); what isn't of the form of a language tag, and codes
  for no one language, are no labels and no evidence.  So there are at most as
  many languages as two- and three-letter codes.
* Declared language, suffix and host: counted over all rows by grouped
  aggregation of the text posteriors.  A host's prior is smoothed towards its
  suffix's and that towards the corpus's; a row's own share is taken out first.

Trigrams of a text are not independent, so a text's evidence is scaled to at
most EVIDENCE trigrams; short texts then follow their host and markup.

Defined cases: a text without letters (null, empty, digits and marks only) is
``und`` with probability 0; a row is kept unless it is ``und``, however close
two languages are; one too short for a trigram follows
its markup and host; null declared language, suffix or
host are no evidence (a null host has its suffix's prior); rows that repeat a
``doc_id`` are judged each; without labelled rows every text is ``und``; an
empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, small_batches, small_bytes, staged
from .shingles import slices, text_buffer

UND = "und"
#: Labelled rows of a language in the training sample (about), and those a label needs to be a language, at any size of the table.
SAMPLE_ROWS, LEAST_LABELLED = 4_000, 5
GRAMS = 1 << 15
EVIDENCE, UND_PRIOR = 60, 1e-3
#: Codes that stand for no one language.
NO_LANGUAGE = ("und", "mul", "mis", "zxx")
#: Strength (in rows) of the smoothing of hosts by suffix, suffixes by the corpus, and of declared values.
HOST_ROWS, SUFFIX_ROWS, DECLARED_ROWS = 20.0, 50.0, 1.0
_BLOCK = 1 << 19

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _c in range(ord("a"), ord("z") + 1):
    _FOLD[_c] = _FOLD[_c - 32] = _c


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram numbers of the folded texts, where each text's begin (one more at
    the end), and the letter bytes of each text."""
    base = int(offsets[0])
    folded = _FOLD[data[base : int(offsets[-1])]]
    at = offsets - base
    if len(folded) > 1:  # capital letters of the Latin-1 block
        lead = folded[:-1] == 0xC3
        second = folded[1:]
        second[lead & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += 0x20
    blank = folded == 0x20
    first = np.zeros(len(folded) + 1, bool)
    first[at] = True
    keep = ~blank  # a blank stays if a letter of the same text stands before it
    keep[1:] |= ~blank[:-1] & ~first[1 : len(folded)]
    letters = np.diff(np.concatenate(([0], np.cumsum(~blank, dtype=np.int64)))[at])
    at = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[at]
    folded = folded[keep].astype(np.uint32)
    n = len(folded)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64), letters
    number = (folded[:-2] * np.uint32(0x9E3779B1) + folded[1:-1] * np.uint32(0x85EBCA77) + folded[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(17)
    # trigrams that begin in the last two places of a text run into the next one
    inside = np.ones(n, bool)
    ends = at[1:][at[1:] > at[:-1]]
    inside[ends - 1] = False
    inside[np.maximum(ends - 2, 0)] = False
    inside = inside[: n - 2]
    return number[inside].astype(np.int64), np.concatenate(([0], np.cumsum(inside)))[np.minimum(at, n - 2)], letters


def _blocks(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    data, off = text_buffer(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + _BLOCK, "right")) - 1)
        yield trigrams(data, off[i : j + 1])
        i = j


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for b in slices(batches):
        labels = np.array(b.column("label").to_pylist(), object)
        at = 0
        for grams, bounds, _ in _blocks(b.column("text")):
            own = np.repeat(labels[at : at + len(bounds) - 1], np.diff(bounds))
            for label in set(own):
                totals[label] = totals.get(label, 0) + np.bincount(grams[own == label], minlength=GRAMS)
            at += len(bounds) - 1
    for label, t in totals.items():
        some = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(some)), pa.array(some), pa.array(t[some])], names=["label", "gram", "n"])


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language) (last: ``und``) from rows (key,
    label, text): of each language about ``sample_rows`` rows by hash of the key.
    Every label of LEAST_LABELLED rows is one, however many rows others have."""
    labelled = labelled.where("label IS NOT NULL AND text IS NOT NULL")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().where(F.col("count") >= LEAST_LABELLED).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((1, GRAMS))
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_rows / counts[lang]))]), F.col("label"))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / (1 << 20)
    sample = labelled.where(F.col("label").isin(languages) & (place < share))
    grams = sample.select("label", "text").mapInArrow(_count, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages), GRAMS))
    place = {x: i for i, x in enumerate(languages)}
    for r in grams.toLocalIterator():  # at most GRAMS numbers for each language
        table[place[r["label"]], r["gram"]] = r["n"]
    # a small sample adds less to what it hasn't seen, so that it stays less likely than ``und``'s
    some = table.any(axis=1)
    languages, table = [x for x, t in zip(languages, some) if t], table[some]
    unseen = 0.5 * np.minimum(1.0, table.sum(axis=1, keepdims=True) / GRAMS)
    log = np.log(table + unseen) - np.log(table.sum(axis=1, keepdims=True) + unseen * GRAMS)
    return languages, np.vstack([log, np.full((1, GRAMS), -np.log(GRAMS))])


def _score(log, prior: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = log.value
        for b in slices(batches):
            n, letters, sums = [], [], []
            for grams, bounds, own in _blocks(b.column("text")):
                count = np.diff(bounds)
                n.append(count)
                letters.append(own)
                total, found = np.zeros(len(grams) + 1), np.empty((len(count), len(weights)))
                for i, w in enumerate(weights):  # one language at a time: there may be many
                    np.cumsum(w[grams], out=total[1:])
                    found[:, i] = total[bounds[1:]] - total[bounds[:-1]]
                sums.append(found)
            n, letters = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, letters))
            sums = np.concatenate(sums) if sums else np.zeros((0, len(weights)))
            scaled = sums * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
            post = _normal(scaled + prior) if len(n) else scaled
            cols = {name: c for name, c in zip(b.schema.names, b.columns) if name != "text"}
            yield pa.RecordBatch.from_pydict(cols | {"letters": pa.array(letters)} | {f"t{i}": scaled[:, i] for i in range(len(weights))} | {f"p{i}": post[:, i] for i in range(len(weights))})

    return score


def _normal(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def evidence(doc: DataFrame, log: np.ndarray) -> DataFrame:
    """Staged rows: the keys, letters, the text's log likelihoods t0, t1, ... and
    posteriors p0, p1, ... (the last for und)."""
    k = len(log)
    weights = doc.sparkSession.sparkContext.broadcast(log)  # GRAMS numbers for each language
    prior = np.log(np.array([(1 - UND_PRIOR) / max(1, k - 1)] * (k - 1) + [UND_PRIOR]))
    schema = "doc_id long, hash long, declared string, suffix string, host string, letters long" + "".join(f", {c}{i} double" for c in "tp" for i in range(k))
    return staged(doc.mapInArrow(_score(weights, prior), schema), "language")


def _fuse(languages: list[str], base: np.ndarray, total: np.ndarray, kinds: int):
    """Posterior of each row from its text and the counts of its declared
    language (d), suffix (s) and host (h), its own share taken out."""
    k = len(base)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: c for n, c in zip(b.schema.names, b.columns)}
            many = lambda tag: np.column_stack([cols[f"{tag}{i}"].fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(k)])
            read = (cols["letters"].to_numpy(zero_copy_only=False) > 0)[:, None]
            own = many("p") * read

            def shrunk(tag: str, towards: np.ndarray, rows: float) -> np.ndarray:
                rest = np.maximum(many(tag) - own, 0.0)
                return (rest + rows * towards) / (rest.sum(axis=1, keepdims=True) + rows)

            prior = shrunk("h", shrunk("s", np.broadcast_to(base, own.shape), SUFFIX_ROWS), HOST_ROWS)
            said = np.log((np.maximum(many("d") - own, 0.0) + DECLARED_ROWS / kinds) / (total + DECLARED_ROWS))
            said[cols["declared"].is_null().to_numpy(zero_copy_only=False)] = 0.0
            # P(suffix | language) is in the host's prior, which is shrunk towards the suffix's
            post = _normal(np.log(prior) + many("t") + said) if b.num_rows else own
            best = post.argmax(axis=1)
            found = read[:, 0] & (k > 1)
            names = np.array([*languages, UND], object)[np.where(found, best, k - 1)]
            p = np.where(found, post.max(axis=1, initial=0.0), 0.0)
            yield pa.RecordBatch.from_pydict({"doc_id": cols["doc_id"], "hash": cols["hash"], "declared": cols["declared"], "language": pa.array(names, pa.string()), "probability": p, "kept": (names != UND).astype(bool)})

    return fuse


def identify(docs: DataFrame, declared: Column, suffix: Column, host: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: doc_id, hash (of the text), declared, language, probability, kept."""
    doc = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), primary_subtag(declared).alias("declared"),
        F.lower(suffix).alias("suffix"), F.lower(host).alias("host"), F.col("text").cast("string").alias("text"),
    )
    languages, log = train(doc.select(F.struct("doc_id", "hash").alias("key"), F.col("declared").alias("label"), "text"), sample_rows)
    rows, k = evidence(doc, log), len(log)
    read = F.when(F.col("letters") > 0, 1.0).otherwise(0.0)  # texts without letters tell nothing
    sums = lambda tag: [F.sum(F.col(f"p{i}") * read).alias(f"{tag}{i}") for i in range(k)]
    hosts = staged(rows.groupBy("suffix", "host").agg(*sums("h")), "hosts")
    suffixes = staged(hosts.groupBy("suffix").agg(*[F.sum(f"h{i}").alias(f"s{i}") for i in range(k)]), "suffixes")
    total = np.array([float(x or 0) for x in suffixes.agg(*[F.sum(f"s{i}") for i in range(k)]).first()])
    base = (total + 1.0) / (total.sum() + k)
    table = staged(rows.where("declared IS NOT NULL").groupBy("declared").agg(*sums("d")), "declared")
    wide = 16 * k + 128  # bytes of a row of k doubles and a name, about
    rows = rows.join(small_bytes(table, wide), "declared", "left")
    rows = rows.join(small_bytes(suffixes.withColumnRenamed("suffix", "_suffix"), wide), F.col("suffix").eqNullSafe(F.col("_suffix")), "left")
    named = hosts.where("host IS NOT NULL").withColumnsRenamed({"host": "_host", "suffix": "_of"})
    rows = rows.join(small_bytes(named, wide), (F.col("host") == F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_of")), "left")
    return rows.mapInArrow(_fuse(languages, base, total, table.count() + 1), "doc_id long, hash long, declared string, language string, probability double, kept boolean")


def primary_subtag(tag: Column) -> Column:
    """Primary subtag of a language tag, in lower case; null for anything else."""
    first = F.regexp_extract(F.lower(F.trim(tag)), r"^([a-z]{2,3})([-_][a-z0-9]{1,8})*$", 1)
    return F.when((first != "") & ~first.isin(*NO_LANGUAGE), first)


def host_of(source: Column) -> tuple[Column, Column]:
    """Host and address suffix of a source: of its address part if it is one, else the source itself and no suffix."""
    bare = F.regexp_replace(source, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    name = F.regexp_extract(bare, r"^([^/?#:]*)", 1)
    dotted = name.contains(".")
    return name, F.when(dotted, F.regexp_extract(name, r"\.([A-Za-z]+)$", 1))


def identify_documents(docs: DataFrame) -> DataFrame:
    host, suffix = host_of(F.col("source").cast("string"))
    return identify(docs, F.col("lang").cast("string"), suffix, host)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is in no known language."""
    out = staged(identify_documents(docs).where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct(), "rejected")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    return docs.join(small(out), same, "left_anti")
