"""Feed health: completeness and volatility per (location, local date).

Computed for the whole history at once, or for given dates.  A day is one row
with its hours as bits of a mask, so what is missing is read from the mask's
complement and nothing is joined.  The days between two days with snapshots,
and those from a location's last one to the newest date of the table, come from
the row before them: a silent day keeps a row, also of a feed that has stopped.
Every grouping is keyed by (location, date) or finer, so a hot location spreads
over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagecast.config import RULES, Rules
from vintagecast.functions.columns import hour_floor, plus_hours, to_local

KEY = "location_name"
DAY = "today_local_date"


def snapshots_of_day(registry: DataFrame, zone: Column) -> DataFrame:
    """Registry rows with local time, local hour and local date."""
    local = to_local("snapshot_time_utc", zone)
    return registry.select(
        KEY, "snapshot_time_utc", "content_hash", local.alias("snapshot_time_local"),
        hour_floor(local).alias("snapshot_hour_local"), F.to_date(local).alias(DAY))


def dedup_hours(snaps: DataFrame) -> DataFrame:
    """One row per local hour (several snapshots in an hour count once), min hash."""
    return snaps.groupBy(KEY, DAY, "snapshot_hour_local").agg(F.min("content_hash").alias("content_hash"))


def _newest(snaps: DataFrame) -> Column:
    """The newest local date of any location (a scalar subquery)."""
    return snaps.agg(F.max(DAY)).scalar()


def day_spine(snaps: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Every local date from a location's first snapshot to the newest date of
    any location; with ``dates`` (location_name, today_local_date: the runs'
    dates of the known locations, also of those never seen) just these."""
    if dates is not None:
        return dates.select(KEY, DAY).distinct()
    first = snaps.groupBy(KEY).agg(F.min(DAY).alias("d0"))
    return first.select(KEY, F.explode(F.sequence("d0", _newest(snaps))).alias(DAY))


def day_presence(snaps: DataFrame) -> DataFrame:
    """One row per (location, date) with snapshots: ``mask`` (bit h: a snapshot in
    local hour h), their number and newest time, and each hour's hash in order
    (``hours``, at most one entry an hour)."""
    h = F.hour("snapshot_hour_local")
    hours = snaps.groupBy(KEY, DAY, h.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.max("snapshot_time_local").alias("newest"), F.min("content_hash").alias("hash"))
    return hours.groupBy(KEY, DAY).agg(
        F.bit_or(F.expr("shiftleft(1, h)")).alias("mask"), F.sum("n").alias("snapshots_today"),
        F.max("newest").alias("last_snapshot_local"), F.array_sort(F.collect_list(F.struct("h", "hash"))).alias("hours"))


def day_rows(snaps: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """``day_presence`` with the silent days (see ``day_spine``), mask 0."""
    if dates is not None:
        spine = day_spine(snaps, dates)
        present = day_presence(snaps.join(spine, [KEY, DAY], "left_semi"))
        return spine.join(present, [KEY, DAY], "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    present = day_presence(snaps)
    after = F.lead(DAY).over(Window.partitionBy(KEY).orderBy(DAY))   # the day list of a location: small
    until = F.coalesce(F.date_sub("_after", 1), _newest(snaps))
    days = present.withColumn("_after", after).withColumn("_d", F.explode(F.sequence(F.col(DAY), until)))
    real = F.col("_d") == F.col(DAY)
    return days.select(KEY, F.col("_d").alias(DAY), F.when(real, F.col("mask")).otherwise(0).alias("mask"),
                       *[F.when(real, F.col(c)).alias(c) for c in ("snapshots_today", "last_snapshot_local", "hours")])


def missing_of_mask(rules: Rules = RULES, up_to_local: Column | None = None) -> Column:
    """Expected hours (0..23) whose bit is not set, in order; with ``up_to_local``
    without those after it."""
    left = F.filter(F.sequence(F.lit(rules.health_first_hour), F.lit(rules.health_last_hour)),
                    lambda h: F.call_function("shiftleft", F.lit(1), h).bitwiseAND(F.col("mask")) == 0)
    if up_to_local is None:
        return left
    day = F.col(DAY).cast("timestamp_ntz")
    return F.filter(left, lambda h: plus_hours(day, h) <= up_to_local)


def expected_hours(spine: DataFrame, rules: Rules = RULES) -> DataFrame:
    hours = F.explode(F.sequence(F.lit(rules.health_first_hour), F.lit(rules.health_last_hour)))
    return spine.select(KEY, DAY, hours.alias("h")).select(
        KEY, DAY, plus_hours(F.col(DAY).cast("timestamp_ntz"), F.col("h")).alias("expected_hour_local"))


def missing_hours(days: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Expected hours without a snapshot, one row each, of ``day_rows``."""
    out = days.select(KEY, DAY, F.explode(missing_of_mask(rules)).alias("h"))
    return out.select(KEY, DAY, plus_hours(F.col(DAY).cast("timestamp_ntz"), F.col("h")).alias("expected_hour_local"))


def hash_changes(present: DataFrame) -> DataFrame:
    """Hash vs the previous present hour of the same day: NULL first, 1 changed, 0 same."""
    w = Window.partitionBy(KEY, DAY).orderBy("snapshot_hour_local")
    prev = F.lag("content_hash").over(w)
    changed = F.when(prev.isNull(), F.lit(None).cast("int")).when(
        F.col("content_hash") != prev, F.lit(1)).otherwise(F.lit(0))
    return present.select(KEY, DAY, "snapshot_hour_local", "content_hash", changed.alias("changed_vs_prev"))


def change_rate(changes: DataFrame) -> DataFrame:
    """round(100 * mean of changes, 1), first hour of the day left out."""
    c = changes.where(F.col("changed_vs_prev").isNotNull())
    pct = F.round(F.sum("changed_vs_prev").cast("decimal(20,0)") * 100 / F.count("changed_vs_prev"), 1)
    return c.groupBy(KEY, DAY).agg(pct.cast("double").alias("change_rate_pct_today"))


def _hours_text(hours: Column) -> Column:
    text = F.array_join(F.transform(hours, lambda h: F.format_string("%02d:00", h)), ", ")
    return F.when(F.size(hours) > 0, text)


def missing_hours_list(days: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Number and list of the missing hours of each day that misses any."""
    out = days.select(KEY, DAY, missing_of_mask(rules).alias("_missing")).where(F.size("_missing") > 0)
    return out.select(KEY, DAY, F.size("_missing").cast("bigint").alias("missing_hour_count_06_19"),
                      _hours_text(F.col("_missing")).alias("missing_hours_list"))


def _change_rate_of(hours: Column) -> Column:
    """round(100 * share of hours whose hash differs from the present hour before, 1)."""
    pairs = F.transform(F.slice(hours, F.lit(2), F.size(hours)),
                        lambda x, i: F.struct(x["hash"].alias("now"), F.get(hours, i)["hash"].alias("before")))
    pairs = F.filter(pairs, lambda p: p["before"].isNotNull())
    changed = F.size(F.filter(pairs, lambda p: p["now"] != p["before"]))
    pct = F.round(changed.cast("decimal(20,0)") * 100 / F.nullif(F.size(pairs), F.lit(0)), 1)
    return F.when(F.size(hours) > 1, pct.cast("double"))


def snapshot_health(registry: DataFrame, zone: Column, rules: Rules = RULES,
                    up_to_local: Column | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Per (location, local date); with ``dates`` (see ``day_spine``) for these only.  Hours still in the future count as missing,
    as in the source (Q12); pass ``up_to_local`` (a local wall-clock column
    or literal) to leave out expected hours after it."""
    days = day_rows(snapshots_of_day(registry, zone), dates).withColumn("_missing", missing_of_mask(rules, up_to_local))
    return days.select(
        KEY, DAY, F.coalesce("snapshots_today", F.lit(0)).cast("bigint").alias("snapshots_today"),
        "last_snapshot_local", _change_rate_of(F.col("hours")).alias("change_rate_pct_today"),
        F.size("_missing").cast("bigint").alias("missing_hour_count_06_19"),
        _hours_text(F.col("_missing")).alias("missing_hours_list"))


def health_latest(health: DataFrame, n: int = 5) -> DataFrame:
    """Newest n health rows of each location."""
    from vintagecast.operators.profile import top_per_key
    return top_per_key(health, [KEY], [F.col(DAY).desc()], n)
