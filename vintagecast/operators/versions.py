"""Snapshot (version) selection.

Hourly rows are reached only by equi joins on (location, snapshot), which
spread a hot location over all of its snapshots.  Ordered steps over the
snapshot list (as-of, predecessor, rank) are split by day bucket
(``operators.asof``), so even the list of one location's snapshots is never
sorted in a single task; top-k steps use ``row_number <= k``, which Spark
trims per map task (``WindowGroupLimit``) before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "location_name"
SNAP = "snapshot_time_utc"
PART = "snapshot_date"   # partition column of the stored hourly table (sources.tables.write_hourly)


def snapshot_list(hourly: DataFrame) -> DataFrame:
    """Distinct (location, snapshot) with the location's zone when present."""
    cols = [KEY, SNAP] + (["timezone"] if "timezone" in hourly.columns else [])
    return hourly.select(*cols).distinct()


def latest_per_location(df: DataFrame, time_col: str = SNAP) -> DataFrame:
    """(location, newest time): hash aggregate with map-side partial max."""
    return df.groupBy(KEY).agg(F.max(time_col).alias(time_col))


def latest_snapshot_rows(hourly: DataFrame) -> DataFrame:
    """All hourly rows of each location's newest snapshot.

    The aggregate side has one row per location; AQE turns the join into a
    broadcast at run time only when its measured size is under the threshold.
    """
    latest = latest_per_location(hourly)
    if PART in hourly.columns:  # let dynamic partition pruning skip the older dates
        return hourly.join(latest.withColumn(PART, F.to_date(SNAP)), [PART, KEY, SNAP], "left_semi")
    return hourly.join(latest, [KEY, SNAP], "left_semi")


def latest_n(df: DataFrame, keys: list[str], order: list, n: int, rank_col: str = "rn") -> DataFrame:
    """Top-n rows per key with a total order (``row_number`` <= n plans a
    ``WindowGroupLimit``, which trims each map task before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def latest_two_snapshots(hourly: DataFrame) -> DataFrame:
    snaps = hourly.select(KEY, SNAP).distinct()
    return latest_n(snaps, [KEY], [F.col(SNAP).desc()], 2).select(
        KEY, SNAP, F.col("rn").cast("bigint").alias("rn"))


def snapshot_dense_rank(hourly: DataFrame) -> DataFrame:
    """Dense rank of snapshots per location (newest = 1) on every hourly row.

    Ranks the distinct snapshot list, then joins back, so hourly rows are
    never sorted per location."""
    from vintagecast.operators.asof import rank_desc_in_key
    snaps = hourly.select(KEY, SNAP).distinct()
    ranked = rank_desc_in_key(snaps, [KEY], SNAP, "snapshot_rank")
    return hourly.join(ranked, [KEY, SNAP])


def snapshot_pairs(hourly: DataFrame) -> DataFrame:
    """Every snapshot with the one before it (same location), day-bucketed."""
    from vintagecast.operators.asof import prev_in_key
    snaps = hourly.select(KEY, SNAP).distinct()
    p = prev_in_key(snaps, [KEY], SNAP, [], [SNAP], out="_p")
    return p.select(KEY, SNAP, F.col("_p." + SNAP).alias("prev_snapshot_utc"))


_DELTA_MEASURES = (("temperature_c", "delta_temp_c"), ("feels_like_c", "delta_feels_like_c"),
                   ("precipitation_mm", "delta_precip_mm"), ("wind_kmh", "delta_wind_kmh"))


def _deltas(hourly: DataFrame, pairs: DataFrame) -> DataFrame:
    cur = hourly.select(KEY, F.col(SNAP).alias("curr_snapshot"), "forecast_time_local",
                        *[F.col(m).alias("c_" + m) for m, _ in _DELTA_MEASURES])
    prev = hourly.select(KEY, F.col(SNAP).alias("prev_snapshot"), "forecast_time_local",
                         *[F.col(m).alias("p_" + m) for m, _ in _DELTA_MEASURES])
    p = pairs.select(KEY, F.col(SNAP).alias("curr_snapshot"), F.col("prev_snapshot_utc").alias("prev_snapshot"))
    j = cur.join(p, [KEY, "curr_snapshot"]).join(prev, [KEY, "prev_snapshot", "forecast_time_local"])
    return j.select(KEY, "forecast_time_local", "curr_snapshot", "prev_snapshot",
                    *[(F.col("c_" + m) - F.col("p_" + m)).alias(d) for m, d in _DELTA_MEASURES])


def snapshot_deltas_all(hourly: DataFrame) -> DataFrame:
    """Deltas for every consecutive snapshot pair, per forecast hour."""
    return _deltas(hourly, snapshot_pairs(hourly).where(F.col("prev_snapshot_utc").isNotNull()))


def snapshot_deltas(hourly: DataFrame, limit: int | None = 20) -> DataFrame:
    """Newest vs second newest snapshot per location; of each location the first
    ``limit`` forecast hours (all with None)."""
    two = latest_two_snapshots(hourly)
    pairs = (two.groupBy(KEY).agg(F.max(F.when(F.col("rn") == 1, F.col(SNAP))).alias(SNAP),
                                  F.max(F.when(F.col("rn") == 2, F.col(SNAP))).alias("prev_snapshot_utc"))
             .where(F.col("prev_snapshot_utc").isNotNull()))
    out = _deltas(hourly, pairs)
    if limit is None:
        return out
    from vintagecast.operators.profile import top_per_key
    return top_per_key(out, [KEY], [F.col("forecast_time_local")], limit)


def visible_versions(snaps: DataFrame, runs: DataFrame) -> DataFrame:
    """As-of step: for each run, its newest (rn=1) and second newest (rn=2)
    snapshot at or before ``as_of_utc``.

    One pass, split by day bucket so no task sorts all snapshots of a
    location and there is no range join (cost linear in runs + snapshots):

    1. snapshot and run rows of a (location, day) in time order: each
       snapshot picks up its predecessor inside the day, each run the newest
       snapshot (with predecessor) at or before it;
    2. per (location, day) the last snapshot and its predecessor (same
       partitioning, no shuffle), then over the day list of a location (small:
       one row per day) the newest snapshot before each day and the newest
       pair before each day;
    3. runs whose day has nothing before them, or whose newest snapshot is the
       first of its day, complete from step 2.
    Output: (location_name, as_of_utc, timezone, rn, snapshot_time_utc).
    """
    pair_t = "struct<cur:timestamp_ntz,prev:timestamp_ntz>"
    s = snaps.select(KEY, SNAP).distinct().select(
        KEY, F.col(SNAP).alias("t"), F.lit(0).alias("kind"), F.col(SNAP).alias("snap"),
        F.lit(None).cast("string").alias("timezone"))
    r = runs.select(KEY, F.col("as_of_utc").alias("t"), F.lit(1).alias("kind"),
                    F.lit(None).cast("timestamp_ntz").alias("snap"), "timezone")
    u = s.unionByName(r).withColumn("_b", F.date_trunc("day", "t").cast("timestamp_ntz"))
    w = Window.partitionBy(KEY, "_b").orderBy("t", "kind")
    u = u.withColumn("_pin", F.last("snap", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    pair = F.struct(F.col("snap").alias("cur"), F.col("_pin").alias("prev")).cast(pair_t)
    u = u.withColumn("_seen", F.last(F.when(F.col("kind") == 0, pair), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    days = u.groupBy(KEY, "_b").agg(F.max_by(F.when(F.col("kind") == 0, pair), F.col("snap")).alias("_last"))
    wd = Window.partitionBy(KEY).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_prior1", F.last("_last.cur", ignorenulls=True).over(wd))
    full = F.when(F.col("_last").isNotNull(), F.struct(
        F.col("_last.cur").alias("cur"), F.coalesce("_last.prev", "_prior1").alias("prev")).cast(pair_t))
    days = days.withColumn("_full", full)
    days = days.withColumn("_prior2", F.last("_full", ignorenulls=True).over(wd)).select(
        KEY, "_b", "_prior1", "_prior2")
    runs_u = u.where(F.col("kind") == 1).join(days, [KEY, "_b"], "left")
    cur = F.coalesce(F.col("_seen.cur"), F.col("_prior2.cur"))
    prev = F.when(F.col("_seen").isNotNull(), F.coalesce(F.col("_seen.prev"), F.col("_prior1"))).otherwise(
        F.col("_prior2.prev"))
    picked = runs_u.select(KEY, F.col("t").alias("as_of_utc"), "timezone", F.explode(F.array(
        F.struct(F.lit(1).alias("rn"), cur.alias(SNAP)),
        F.struct(F.lit(2).alias("rn"), prev.alias(SNAP)))).alias("v"))
    return picked.select(KEY, "as_of_utc", "timezone", "v.rn", F.col("v." + SNAP).alias(SNAP)).where(
        F.col(SNAP).isNotNull())


def current_versions(snaps: DataFrame, runs: DataFrame) -> DataFrame:
    """rn = 1 only: each run's current snapshot."""
    return visible_versions(snaps, runs).where(F.col("rn") == 1).drop("rn")


def forecast_history(hourly: DataFrame) -> DataFrame:
    """For every (location, forecast hour): the row of the newest snapshot
    that has it.  A keyed ``max_by`` (partial aggregation), no sort."""
    measures = ["temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct"]
    best = F.max_by(F.struct(SNAP, *measures), SNAP)
    g = hourly.groupBy(KEY, "forecast_time_local").agg(best.alias("b"))
    return g.select(KEY, "forecast_time_local", F.col("b." + SNAP).alias(SNAP),
                    F.to_date("forecast_time_local").alias("forecast_date_local"),
                    F.hour("forecast_time_local").cast("bigint").alias("forecast_hour_local"),
                    *[F.col("b." + m).alias(m) for m in measures])


def history_rows(hourly: DataFrame, runs: DataFrame, days_back: int, hours: tuple[int, int] = (0, 23)) -> DataFrame:
    """Per run, the forecast hours of the ``days_back`` local days before the
    run's local date (from ``hours[0]`` to ``hours[1]``), each from the newest
    snapshot at or before ``as_of`` that has it (all its rows of that hour).

    A run asks for the forecast times that the table has on those days, no
    others.  One exchange by (location, forecast time): every version of an hour
    and every run that asks for it meet there in time order, and a run takes the
    version that is valid then, measures and all.
    """
    from vintagecast.functions.columns import to_local
    measures = ["temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct"]
    carried = [SNAP, "forecast_date_local", "forecast_hour_local", *measures]
    r = runs.select(KEY, "as_of_utc", F.to_date(to_local("as_of_utc", F.col("timezone"))).alias("run_date"))
    r = r.select("*", F.explode(F.sequence(F.date_sub("run_date", days_back), F.date_sub("run_date", 1))).alias("forecast_date_local"))
    days = r.select(KEY, "forecast_date_local").distinct()
    row = F.struct(*carried)
    kind = hourly.select(row.alias("r")).schema["r"].dataType.simpleString()
    h = hourly.where(F.col("forecast_hour_local").between(*hours))
    times = h.select(KEY, "forecast_date_local", "forecast_time_local").distinct()
    # r and days come out of explode: merged, as the planner takes their rows for fewer than they are
    asked = times.hint("merge").join(r, [KEY, "forecast_date_local"]).select(
        KEY, "forecast_time_local", F.col("as_of_utc").alias("_t"), F.lit(1).alias("_k"), "run_date",
        F.lit(None).cast(kind).alias("_row"))
    h = h.hint("merge").join(days, [KEY, "forecast_date_local"], "left_semi")
    held = h.select(KEY, "forecast_time_local", F.col(SNAP).alias("_t"), F.lit(0).alias("_k"),
                    F.lit(None).cast("date").alias("run_date"), row.alias("_row"))
    # versions of one forecast time: as many as snapshots reach it (the horizon bounds them)
    w = Window.partitionBy(KEY, "forecast_time_local").orderBy("_t", "_k")
    peers = F.collect_list("_row").over(w.rangeBetween(Window.currentRow, Window.currentRow))
    u = asked.unionByName(held).withColumn("_rows", F.when(F.col("_k") == 0, peers))
    u = u.withColumn("_rows", F.last("_rows", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    u = u.where((F.col("_k") == 1) & F.col("_rows").isNotNull())
    out = u.select(KEY, F.col("_t").alias("as_of_utc"), "run_date", "forecast_time_local", F.explode("_rows").alias("_r"))
    return out.select(KEY, "as_of_utc", "run_date", "_r.forecast_date_local", "forecast_time_local", "_r." + SNAP,
                      "_r.forecast_hour_local", *["_r." + m for m in measures])
