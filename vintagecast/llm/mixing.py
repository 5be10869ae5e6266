"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget.  A source can give at
most ``max_epochs`` times its own size; what it can't give is shared by the
others in proportion to their weights, again and again, until no source is
above its cap.  A source's target is then met by whole repetitions of all its
documents and a seeded sample of one more.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target 0 and gives nothing; rows that
repeat a ``doc_id`` count each; ties of the seeded order go to the smaller
``doc_id`` (null last); an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running_total, small, staged

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, 17
WORD = r"[^\x20\x09-\x0D]+"
_HASH_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of every row, with a seeded place ``u`` in [0, 2^60)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))


def seeded(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("long")


def fill(sources: DataFrame, budget: int) -> DataFrame:
    """``sources`` (staged: weight, cap) with ``target``: the water level times
    the weight, or the cap where that is lower.  Each round is one small
    aggregation; clamping can only raise the level, so the rounds end."""
    clamped, weight, n = sources.agg(F.lit(0), F.sum("weight"), F.lit(0)).first()
    level = budget / weight if weight else 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        clamped, weight, now = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)).first()
        if not weight or now == n:
            break
        n, level = now, (budget - clamped) / weight
    return sources.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight")))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """Per source: rank by code point (null last), source_size, weight, cap, target."""
    per = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources")
    ranked = running_total(per, [F.col("source").asc_nulls_last()], F.lit(1), "rank", "source-rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    return fill(ranked, total if budget is None else budget)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, budget: int | None = None) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, times (how often the
    mix repeats the document) and taken = times * size.

    The sample behind a target's fraction is the seeded order up to the words
    still wanted.  That order is cut into ranges: sums by (source, range) find
    the range in which a source's sample ends, and only that range is sorted.
    """
    rows = staged(sizes(docs).withColumn("_row", F.monotonically_increasing_id()).withColumn("u", seeded(F.col("doc_id"), seed)), "sizes")
    plan = staged(targets(rows, weights, max_epochs, budget), "targets")
    most = plan.agg(F.max("n_docs")).first()[0] or 1
    width = 1 << max(0, _HASH_BITS - max(4, math.ceil(math.log2(most) / 2)))  # about as many ranges as rows in each
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = staged(plan.select("source", "rank", "source_size", "target", "whole", "want"), "plan")
    on = rows["source"].eqNullSafe(plan["source"])
    placed = rows.withColumn("range", F.floor(F.col("u") / width)).join(small(plan), on).drop(plan["source"])
    sums = placed.groupBy("rank", "range", "want").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("rank").orderBy("range")
    sums = sums.withColumn("upto", F.sum("words").over(run))
    ends = sums.where("upto > want").groupBy(F.col("rank").alias("_rank")).agg(F.min(F.struct("range", "upto", "words")).alias("e"))
    ends = staged(ends.select("_rank", F.col("e.range").alias("end"), (F.col("e.upto") - F.col("e.words")).alias("before")), "ends")
    placed = placed.join(small(ends), F.col("rank") == F.col("_rank"), "left")
    inside = Window.partitionBy("rank", "range").orderBy("u", F.col("doc_id").asc_nulls_last(), "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.where("range = end").withColumn("_upto", F.col("before") + F.sum("size").over(inside))
    near = F.col("_upto") - F.col("size") / 2 <= F.col("want")  # the document that crosses the line goes in if that is nearer
    rest = placed.where("end IS NULL OR range <> end").withColumn("picked", F.coalesce(F.col("range") < F.col("end"), F.lit(True)))
    out = last.withColumn("picked", near).drop("_upto").unionByName(rest)
    times = F.when(F.col("size") > 0, F.col("whole") + (F.col("picked") & (F.col("want") > 0)).cast("long")).otherwise(0)
    return out.withColumn("times", F.least(times, F.lit(max_epochs)).cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix has them: each row as often as its document is taken."""
    times = staged(mix(docs, **options).where("times > 0").groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(F.max("times").alias("_times")), "times")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & docs["source"].cast("string").eqNullSafe(F.col("_source")) & (word_count(docs["text"]) == F.col("_size"))
    taken = docs.join(small(times), same)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[taken[c] for c in docs.columns])
