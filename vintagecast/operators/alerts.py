"""Change-aware alert decisions over a moving horizon.

Both versions (current and previous snapshot) are judged on the *same*
window [as_of_local, as_of_local + 6h): a lag over per-snapshot flags would
compare different windows and be wrong.

Plan shape: as-of step on metadata -> equi join to hourly on
(location, snapshot) with the window as a residual filter -> one keyed
aggregation that pivots current and previous side by side.  The run rows
themselves are unioned into the aggregation input, so every run keeps its
row (a global aggregate in the source gives one row even with no data)
without an extra join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagecast.config import RULES, Rules
from vintagecast.functions.columns import day_floor, hour_floor, hour_of, plus_hours, to_local
from vintagecast.operators.versions import KEY, PART, SNAP, snapshot_list, visible_versions


def _half_day(c: F.Column | str) -> F.Column:
    return plus_hours(day_floor(c), F.when(hour_of(c) >= 12, 12).otherwise(0))


def rows_in_windows(hourly: DataFrame, versions: DataFrame, start: F.Column, end: F.Column,
                    columns: list[str] | None = None) -> DataFrame:
    """Hourly rows of each (run, version) with ``start <= forecast_time < end``.

    Each version row lists the half days its window touches (two or three) and
    joins on (location, snapshot, half day), with the exact bounds as the join's
    residual filter: it compares a run with the rows of its half days only and
    emits those in the window.  Rows of a half day lie together, so what is
    shuffled packs well and aggregates before it is shuffled again.

    The join is a merge by name: its sides come out of ``explode``, whose rows
    the planner takes to be as many as go in, so it would broadcast them.
    """
    cols = columns or ["forecast_time_local", "forecast_date_local", "forecast_hour_local", "idx",
                       "temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct"]
    cols = [c for c in cols if c in hourly.columns and c != "forecast_time_local"]
    last = F.col("_we") - F.expr("INTERVAL 1 MICROSECOND")      # window end is exclusive
    v = versions.withColumn("_ws", start).withColumn("_we", end)
    v = v.withColumn("_hf", F.explode(F.sequence(_half_day("_ws"), _half_day(last), F.expr("INTERVAL 12 HOUR"))))
    keys = [KEY, SNAP, "_hf"]
    part = [PART] if PART in hourly.columns else []
    if part:  # stored layout: the partition column joins too, so the scan is pruned at run time
        v = v.withColumn(PART, F.to_date(SNAP))
    h = hourly.select(KEY, SNAP, *part, "forecast_time_local", *cols).withColumn("_hf", _half_day("forecast_time_local"))
    j = h.hint("merge").join(v, [*part, *keys])
    return j.where((F.col("forecast_time_local") >= F.col("_ws")) & (F.col("forecast_time_local") < F.col("_we"))
                   ).drop("_hf", "_ws", "_we")


def horizon_rows(hourly: DataFrame, versions: DataFrame, hours: int, align_hour: bool = False,
                 columns: list[str] | None = None) -> DataFrame:
    """Hourly rows of each (run, version) inside [now, now + hours) local.

    ``versions``: (location_name, as_of_utc, timezone, [rn,] snapshot_time_utc).
    """
    now_local = to_local("as_of_utc", F.col("timezone"))
    if align_hour:
        now_local = hour_floor(now_local)
    v = versions.withColumn("now_local", now_local)
    return rows_in_windows(hourly, v, F.col("now_local"), plus_hours(F.col("now_local"), hours), columns)


def _rain_hit(rules: Rules) -> F.Column:
    return F.when(F.col("precipitation_mm") > rules.rain_threshold_mm, 1).otherwise(0)


def flags_per_version(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                      snaps: DataFrame | None = None) -> DataFrame:
    """rain_flag / wind_max: one row per (run, version) that has hours in the window."""
    v = visible_versions(snaps if snaps is not None else snapshot_list(hourly), runs)
    rows = horizon_rows(hourly, v, rules.alert_horizon_hours)
    return rows.groupBy(KEY, "as_of_utc", "rn", SNAP).agg(
        F.max(_rain_hit(rules)).alias("rain_next6h"),
        F.max("wind_kmh").alias("max_wind_next6h"))


def decisions(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
              snaps: DataFrame | None = None) -> DataFrame:
    """Rain and wind decisions for every run in one pass (``alert_replay``).

    Columns follow the decision tables: run_time_utc, current/prev snapshot,
    current/prev value, should_alert flag — for rain and for wind.
    """
    v = visible_versions(snaps if snaps is not None else snapshot_list(hourly), runs)
    rows = horizon_rows(hourly, v, rules.alert_horizon_hours, columns=[
        "forecast_time_local", "precipitation_mm", "wind_kmh"])
    rows = rows.select(KEY, "as_of_utc", "rn", SNAP, _rain_hit(rules).alias("hit"), "wind_kmh")
    spine = runs.select(KEY, "as_of_utc", F.lit(None).cast("int").alias("rn"),
                        F.lit(None).cast("timestamp_ntz").alias(SNAP), F.lit(None).cast("int").alias("hit"),
                        F.lit(None).cast("double").alias("wind_kmh"))
    u = rows.unionByName(spine)
    cur, prev = F.col("rn") == 1, F.col("rn") == 2
    agg = u.groupBy(KEY, "as_of_utc").agg(
        F.max(F.when(cur, F.col(SNAP))).alias("current_snapshot_utc"),
        F.max(F.when(prev, F.col(SNAP))).alias("prev_snapshot_utc"),
        F.max(F.when(cur, F.col("hit"))).alias("current_rain_next6h"),
        F.max(F.when(prev, F.col("hit"))).alias("prev_rain_next6h"),
        F.max(F.when(cur, F.col("wind_kmh"))).alias("current_max_wind_next6h"),
        F.max(F.when(prev, F.col("wind_kmh"))).alias("prev_max_wind_next6h"))
    return agg.select(
        KEY, F.col("as_of_utc").alias("run_time_utc"), "current_snapshot_utc", "prev_snapshot_utc",
        "current_rain_next6h", "prev_rain_next6h", rain_rule().alias("should_alert_rain_next6h"),
        "current_max_wind_next6h", "prev_max_wind_next6h", wind_rule(rules).alias("should_alert_wind_next6h"))


def rain_rule() -> F.Column:
    """previous known AND current = 1 AND previous = 0; anything unknown -> FALSE."""
    c, p = F.col("current_rain_next6h"), F.col("prev_rain_next6h")
    return F.coalesce(p.isNotNull() & (c == 1) & (p == 0), F.lit(False))


def wind_rule(rules: Rules = RULES) -> F.Column:
    """previous known AND current >= 30 AND rise >= 15; NULL -> FALSE."""
    c, p = F.col("current_max_wind_next6h"), F.col("prev_max_wind_next6h")
    return F.coalesce(p.isNotNull() & (c >= rules.wind_min_kmh) & ((c - p) >= rules.wind_rise_kmh),
                      F.lit(False))


RAIN_COLUMNS = [KEY, "run_time_utc", "current_snapshot_utc", "prev_snapshot_utc",
                "current_rain_next6h", "prev_rain_next6h", "should_alert_rain_next6h"]
WIND_COLUMNS = [KEY, "run_time_utc", "current_snapshot_utc", "prev_snapshot_utc",
                "current_max_wind_next6h", "prev_max_wind_next6h", "should_alert_wind_next6h"]


def rain_decision(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                  snaps: DataFrame | None = None) -> DataFrame:
    return decisions(hourly, runs, rules, snaps).select(*RAIN_COLUMNS)


def wind_decision(hourly: DataFrame, runs: DataFrame, rules: Rules = RULES,
                  snaps: DataFrame | None = None) -> DataFrame:
    return decisions(hourly, runs, rules, snaps).select(*WIND_COLUMNS)
