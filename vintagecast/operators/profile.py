"""Profiling and data checks over any table (keys and measures are parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagecast.functions.columns import rate
from vintagecast.session import cut_lineage

KEY = "location_name"
SNAP = "snapshot_time_utc"

_TYPE_NAMES = {  # Spark type names -> SQL standard names used in reports
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "double": "DOUBLE",
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def sql_type_name(c: F.Column) -> F.Column:
    t = F.typeof(c)
    expr = None
    for spark_name, sql_name in _TYPE_NAMES.items():
        expr = F.when(t == spark_name, F.lit(sql_name)) if expr is None else expr.when(t == spark_name,
                                                                                      F.lit(sql_name))
    return expr.otherwise(F.upper(t))


def key_summary(df: DataFrame, key: str, time_col: str, count_name: str, first_name: str,
                last_name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name), F.min(time_col).alias(first_name),
                               F.max(time_col).alias(last_name))


def hourly_summary(hourly: DataFrame) -> DataFrame:
    """Rows, distinct snapshots, first and last forecast time per location.

    ``count(distinct)`` is exact (a two-level aggregate in the plan); use
    ``approx_count_distinct`` when an estimate is enough at scale."""
    return hourly.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(SNAP).alias("n_snapshots"),
        F.min("forecast_time_local").alias("first_forecast_time_local"),
        F.max("forecast_time_local").alias("last_forecast_time_local"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def duplicate_examples(df: DataFrame, keys: list[str], idx_col: str, order: list, n: int = 20) -> DataFrame:
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.min(idx_col).alias("min_idx"),
                              F.max(idx_col).alias("max_idx")).where(F.col("c") > 1)
    return g.orderBy(*order).limit(n)


def top_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """Newest n per key (``WindowGroupLimit`` trims before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def rows_per_snapshot(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(KEY, SNAP).agg(F.count(F.lit(1)).alias("rows"))


def exact_quantiles(df: DataFrame, key: str, quantiles: dict[str, list[float]]) -> DataFrame:
    """Exact quantiles of each group by linear interpolation: (``key``, column,
    q, value), NULL values left out, groups without values absent.

    A histogram (count per group, column and value, summed where the rows are)
    is dealt by range of (group, column, value).  One row per range and group
    tells how many values lie below it; only ranges that hold a wanted rank are
    counted through, so no group meets in one task however large it is.
    """
    spark = df.sparkSession
    cols = list(quantiles)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols]))
    hist = df.select(F.col(key).alias("k"), each.alias("_x")).select("k", "_x.c", "_x.v").where(F.col("v").isNotNull())
    hist = hist.groupBy("k", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written once: the ranges must be the same for both readers
    hist = cut_lineage(hist.repartitionByRange(parts, "k", "c", "v").withColumn("p", F.spark_partition_id()))
    sums = hist.groupBy("k", "c", "p").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("k", "c")
    below = F.coalesce(F.sum("n").over(w.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("k", "c", "p", "n", below.alias("below"), F.sum("n").over(w).alias("total"))
    asked = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(float(q)) for q in quantiles[c]]))])
    sums = sums.withColumn("q", F.explode(asked[F.col("c")])).withColumn("at", (F.col("total") - 1) * F.col("q"))
    sums = sums.withColumn("r", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    wanted = sums.where((F.col("r") >= F.col("below")) & (F.col("r") < F.col("below") + F.col("n")))
    ranges = wanted.select("k", "c", "p", "below").distinct()
    same = [F.col("h." + x).eqNullSafe(F.col("s." + x)) for x in ("k", "c", "p")]
    read = hist.alias("h").join(ranges.alias("s"), same).select("h.*", "s.below")
    inside = Window.partitionBy("k", "c", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    read = read.withColumn("first", F.col("below") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    hit = (F.col("w.r") >= F.col("h.first")) & (F.col("w.r") < F.col("h.first") + F.col("h.n"))
    same = [F.col("h." + x).eqNullSafe(F.col("w." + x)) for x in ("k", "c", "p")]
    # at most two ranks a quantile meet the values of one range
    found = read.alias("h").join(wanted.alias("w"), [*same, hit]).select("w.k", "w.c", "w.q", "w.at", "w.r", "h.v")
    low, high = F.min("v"), F.max("v")
    part = F.first("at") - F.floor(F.first("at"))
    value = F.when(low == high, low).otherwise((1 - part) * low + part * high)
    return found.groupBy("k", "c", "q").agg(value.alias("value")).select(F.col("k").alias(key), F.col("c").alias("column"), "q", "value")


def distribution_profile(df: DataFrame, key: str, measures: dict[str, str], quantiles: dict[str, list[float]],
                         zero_rate: tuple[str, ...] = (), approx_accuracy: int | None = None) -> DataFrame:
    """min, exact quantiles (see ``exact_quantiles``), max, NULL rate and zero rate;
    with ``approx_accuracy`` one pass of ``percentile_approx`` instead (rank error
    ~ 1/accuracy)."""
    quantiles = {c: qs for c, qs in quantiles.items() if c in measures and qs}
    name = lambda c, q: f"{measures[c]}_p{int(round(q * 100)):02d}"
    aggs, picks = [], []
    for col, prefix in measures.items():
        c = F.col(col)
        qs = quantiles.get(col, [])
        if qs and approx_accuracy:
            probs = F.array(*[F.lit(q) for q in qs])
            aggs.append(F.percentile_approx(c, probs, approx_accuracy).cast("array<double>").alias(f"_{prefix}_q"))
        aggs += [F.min(c).alias(f"{prefix}_min"), F.max(c).alias(f"{prefix}_max")]
        picks.append(F.col(f"{prefix}_min"))
        picks += [(F.col(f"_{prefix}_q")[i] if approx_accuracy else F.col(name(col, q))).alias(name(col, q)) for i, q in enumerate(qs)]
        picks.append(F.col(f"{prefix}_max"))
        if col in zero_rate:
            aggs.append(rate(c == 0).alias(f"{prefix}_zero_rate"))
            picks.append(F.col(f"{prefix}_zero_rate"))
        aggs.append(rate(c.isNull()).alias(f"{prefix}_null_rate"))
        picks.append(F.col(f"{prefix}_null_rate"))
    out = df.groupBy(key).agg(*aggs)
    if quantiles and not approx_accuracy:
        pick = lambda c, q: F.max(F.when((F.col("column") == c) & (F.col("q") == q), F.col("value")))
        wide = exact_quantiles(df, key, quantiles).groupBy(F.col(key).alias("_k")).agg(
            *[pick(c, q).alias(name(c, q)) for c, qs in quantiles.items() for q in qs])
        out = out.join(wide, F.col(key).eqNullSafe(F.col("_k")), "left")
    return out.select(key, *picks)


def latest_rows_with_type(hourly: DataFrame, n: int = 5) -> DataFrame:
    from vintagecast.operators.versions import latest_snapshot_rows
    rows = latest_snapshot_rows(hourly).select(
        KEY, SNAP, "forecast_time_local", sql_type_name(F.col("forecast_time_local")).alias(
            "forecast_time_local_type"), "precipitation_mm")
    return top_per_key(rows, [KEY], [F.col("forecast_time_local")], n)


def stats_and_sample(hourly: DataFrame, n: int = 5) -> DataFrame:
    """One STATS row and up to n SAMPLE rows per location, all as text."""
    from vintagecast.operators.versions import latest_snapshot_rows
    latest = latest_snapshot_rows(hourly)
    ftype = sql_type_name(F.col("forecast_time_local"))
    stats = latest.groupBy(KEY, SNAP).agg(
        F.count(F.lit(1)).alias("n"), F.min("forecast_time_local").alias("lo"),
        F.max("forecast_time_local").alias("hi"), F.min(ftype).alias("ty"))
    stats = stats.select(KEY, F.lit("STATS").alias("section"), F.col(SNAP).cast("string").alias("latest_snapshot_utc"),
                         F.col("n").cast("string").alias("a"), F.col("lo").cast("string").alias("b"),
                         F.col("hi").cast("string").alias("c"), F.col("ty").alias("d"))
    sample = top_per_key(latest, [KEY], [F.col("forecast_time_local")], n).select(
        KEY, F.lit("SAMPLE").alias("section"), F.col(SNAP).cast("string").alias("latest_snapshot_utc"),
        F.col("forecast_time_local").cast("string").alias("a"), ftype.alias("b"),
        F.col("precipitation_mm").cast("decimal(38,9)").cast("string").alias("c"), F.lit("").alias("d"))
    return stats.unionByName(sample)
