"""Forecast-shaped tables derived from the driver's ``events`` table.

The definitions follow FIXTURES.md part 2: integer arithmetic on
``event_id`` or a copy of ``value``, so the DuckDB oracle (see
``vintagecast.plans.oracle``) produces the very same doubles.  Every
fixture is a plain Spark job over the whole ``events`` table: grouping
with partial aggregation, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagecast import config
from vintagecast.functions.columns import day_floor, hour_floor, hour_of, plus_hours, to_local
from vintagecast.session import table_path
from vintagecast.sources.envelopes import read_tasks

FIXTURE_ZONE = "UTC"
HEALTH_ZONE = "Europe/Prague"
RUN_OFFSET_HOURS = 6
DIGEST_EXTRA_OFFSET_HOURS = 3

FEED_ZONES = ("UTC", "Europe/Prague", "America/New_York", "Asia/Kolkata")
FEED_START = "2024-03-28 00:00:00"     # Prague's clocks go forward on the 31st
FEED_HOURS = 24                        # horizon of a snapshot
FEED_PACE = 4                          # hours of ``ts`` that make an hour of the feed


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events"))


def _measures(eid: Column, value: Column) -> list[Column]:
    temp = F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(
        ((eid * 7) % 400).cast("double") / 10 - 5)
    feels = temp - (eid % 6).cast("double") / 2
    precip = (F.when(eid % 23 == 0, F.lit(None).cast("double"))
              .when(eid % 5 == 0, value / 100)
              .otherwise(F.lit(0.0)))
    wind = F.when(eid % 29 == 0, F.lit(None).cast("double")).otherwise(value)
    cloud = ((eid * 13) % 101).cast("double")
    return [temp.alias("temperature_c"), feels.alias("feels_like_c"),
            precip.alias("precipitation_mm"), wind.alias("wind_kmh"),
            cloud.alias("cloudcover_pct")]


def _location() -> Column:
    """A location per user: locations, and all that hangs on them, grow with ``events``."""
    return F.concat(F.lit("u"), F.col("user_id").cast("string"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a snapshot per (user, day), forecast hours from ``event_id``.  Events of
    one hour are one row: the smallest id, the largest value."""
    ev = events(spark, sf_dir)
    picked = (
        ev.select(_location().alias("location_name"),
                  day_floor("ts").alias("snapshot_time_utc"),
                  (F.col("event_id") % 48).alias("idx"),
                  "event_id", "value")
        .groupBy("location_name", "snapshot_time_utc", "idx")
        .agg(F.min("event_id").alias("eid"), F.max("value").alias("value"))
    )
    ft = plus_hours("snapshot_time_utc", F.col("idx")).alias("forecast_time_local")
    out = picked.select(
        "location_name", "snapshot_time_utc", F.lit(FIXTURE_ZONE).alias("timezone"),
        F.col("idx").cast("bigint").alias("idx"), ft,
        *_measures(F.col("eid"), F.col("value")))
    return out.select(
        "location_name", "snapshot_time_utc", "timezone", "idx", "forecast_time_local",
        F.to_date("forecast_time_local").alias("forecast_date_local"),
        hour_of("forecast_time_local").alias("forecast_hour_local"),
        "temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct")


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """several snapshots a day in four zones, over a change of clocks; a row for
    each with its hours in ``items``, in order.

    Event time runs four times as fast from ``FEED_START``; a (user, hour) that
    has events is a snapshot, forecast for the 24 hours from its own on the
    location's clock.  The smallest event id gives the measures, which change
    every six hours."""
    ev = events(spark, sf_dir)
    hours = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    start = F.lit(FEED_START).cast("timestamp_ntz")
    zones = F.array(*[F.lit(z) for z in FEED_ZONES])
    # a few bytes become a whole payload: dealt to tasks by number, not by their bytes
    picked = (ev.select("user_id", F.floor(hours / FEED_PACE).alias("h"), "event_id")
              .repartition(read_tasks(spark), "user_id", "h").groupBy("user_id", "h").agg(F.min("event_id").alias("eid")))
    rows = picked.select(
        _location().alias("location_name"), plus_hours(start, F.col("h")).alias("snapshot_time_utc"),
        F.get(zones, (F.col("user_id") % len(FEED_ZONES)).cast("int")).alias("timezone"), "eid")

    def item(i: Column) -> Column:
        ft = hour_floor(to_local(plus_hours("snapshot_time_utc", i), F.col("timezone")))
        wind = ((F.col("eid") * 11) % 50 + i % 3).cast("double")
        return F.struct(i.cast("bigint").alias("idx"), ft.alias("forecast_time_local"),
                        *_measures(F.col("eid") + F.floor(i / 6) * 7, wind))

    return rows.select("location_name", "snapshot_time_utc", "timezone", F.transform(
        F.sequence(F.lit(0), F.lit(FEED_HOURS - 1)), item).alias("items"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, a row for each forecast hour."""
    rows = feed_items(spark, sf_dir).select("location_name", "snapshot_time_utc", "timezone", F.inline("items"))
    return rows.withColumn("forecast_date_local", F.to_date("forecast_time_local")).withColumn(
        "forecast_hour_local", hour_of("forecast_time_local"))


def feed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 as the landed ``raw_snapshots`` table.  A snapshot is a row of ``feed_items``
    as it stands, so its hours aren't gathered again."""
    rows = feed_items(spark, sf_dir)
    items = F.transform("items", lambda r: r.withField("t", _iso_minute(r["forecast_time_local"])))
    return _raw(_payloads(rows.withColumn("items", items)))


def snapshots(hourly_df: DataFrame) -> DataFrame:
    """Distinct (location, snapshot, zone): the list of versions."""
    return hourly_df.select("location_name", "snapshot_time_utc", "timezone").distinct()


def runs(hourly_df: DataFrame, offsets: tuple[int, ...] = (RUN_OFFSET_HOURS,)) -> DataFrame:
    """one run per snapshot at snapshot + 6 hours (more offsets on request)."""
    snaps = snapshots(hourly_df)
    offs = F.explode(F.array(*[F.lit(o) for o in offsets])).alias("off")
    return (snaps.select("location_name", "timezone", "snapshot_time_utc", offs)
            .select("location_name", "timezone",
                    plus_hours("snapshot_time_utc", F.col("off")).alias("as_of_utc"))
            .distinct())


def digest_runs(hourly_df: DataFrame) -> DataFrame:
    """Runs at snapshot + 6 h and + 9 h: one before and one after the 07:00 gate."""
    return runs(hourly_df, (RUN_OFFSET_HOURS, RUN_OFFSET_HOURS + DIGEST_EXTRA_OFFSET_HOURS))


def final_runs(hourly_df: DataFrame) -> DataFrame:
    """One run per location: 6 hours after its newest snapshot."""
    return (snapshots(hourly_df).groupBy("location_name", "timezone")
            .agg(F.max("snapshot_time_utc").alias("s"))
            .select("location_name", "timezone", plus_hours("s", RUN_OFFSET_HOURS).alias("as_of_utc")))


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one registry row per (user, hour of ts)."""
    ev = events(spark, sf_dir)
    g = (ev.groupBy(_location().alias("location_name"), hour_floor("ts").alias("h"))
         .agg(F.min("ts").alias("snapshot_time_utc"), F.min("event_id").alias("eid"),
              F.min_by("props", "event_id").alias("props")))
    return g.select(
        "location_name", "snapshot_time_utc",
        F.concat(F.lit("f"), F.col("eid").cast("string")).alias("raw_file"),
        F.sha2(F.concat(F.lit("k"), (_k(F.col("props")) % 3).cast("string")), 256).alias("content_hash"),
        F.col("snapshot_time_utc").alias("inserted_at_utc"))


def registry_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 with one file in ten landed twice, the copy 30 minutes later."""
    reg = registry(spark, sf_dir)
    eid = F.substring("raw_file", 2, 20).cast("bigint")
    copies = (reg.where(eid % 10 == 0)
              .withColumn("snapshot_time_utc", F.col("snapshot_time_utc") + F.expr("INTERVAL 30 MINUTES"))
              .withColumn("inserted_at_utc", F.col("snapshot_time_utc")))
    return reg.unionByName(copies)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUE alert decisions with a time, keyed by (location, type): every event."""
    ev = events(spark, sf_dir)
    return (ev.select(_location().alias("location_name"),
                    F.col("event_type").alias("alert_type"),
                    F.col("ts").alias("decision_time_utc"),
                    F.col("event_id").alias("decision_id")))


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent-alert log, a row for every event, keyed like the hourly fixture."""
    ev = events(spark, sf_dir)
    a_type = F.when(F.col("user_id") % 2 == 0, F.lit(config.RAIN_ALERT_TYPE)).otherwise(
        F.lit(config.WIND_ALERT_TYPE))
    return (ev.select(F.col("ts").alias("sent_time_utc"), a_type.alias("alert_type"),
                    day_floor("ts").alias("snapshot_time_utc"), F.lit("").alias("message"),
                    _location().alias("location_name")))


def brief_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return (ev.where(F.col("event_type") == "purchase")  # else every run's day would be taken
            .select(F.to_date("ts").alias("sent_date_local"), F.col("ts").alias("sent_time_utc"),
                    _location().alias("location_name"), F.lit("").alias("message")))


# ------------------------------------------------------------------ F4 raw
def _iso_minute(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm")


def payload_rows(hourly_df: DataFrame) -> DataFrame:
    """one raw row per (location, snapshot) with the payload as JSON text.

    The wind array loses its last 3 items when the day of month divides by 7;
    cloud cover is left out for days 1 to 5.  The array per snapshot is bounded
    by the forecast horizon (48 hours here), not by the data size.
    """
    items = F.sort_array(F.collect_list(F.struct(
        "idx", _iso_minute(F.col("forecast_time_local")).alias("t"), "temperature_c", "feels_like_c",
        "precipitation_mm", "wind_kmh", "cloudcover_pct")))
    return _payloads(hourly_df.groupBy("location_name", "snapshot_time_utc", "timezone").agg(items.alias("items")))


def _payloads(g: DataFrame) -> DataFrame:
    dom = F.dayofmonth("snapshot_time_utc")
    field = lambda name: F.transform("items", lambda r: r[name])
    wind = F.when(dom % 7 == 0, F.slice(field("wind_kmh"), 1, F.greatest(F.size("items") - 3, F.lit(0)))
                  ).otherwise(field("wind_kmh"))
    cloud = F.when(dom <= 5, F.lit(None)).otherwise(field("cloudcover_pct"))
    hourly_struct = F.struct(
        field("t").alias("time"), field("temperature_c").alias("temperature_2m"),
        field("feels_like_c").alias("apparent_temperature"), field("precipitation_mm").alias("precipitation"),
        wind.alias("windspeed_10m"), cloud.alias("cloudcover"))
    payload = F.struct(F.lit(50.0).alias("latitude"), F.lit(14.0).alias("longitude"),
                       F.col("timezone").alias("timezone"), hourly_struct.alias("hourly"))
    raw_file = F.concat(F.lit("forecast_"), F.lower("location_name"), F.lit("_"),
                        F.date_format("snapshot_time_utc", "yyyyMMdd'T'HHmmss"), F.lit("Z.json"))
    return g.select(
        "snapshot_time_utc", "location_name", F.lit(50.0).alias("latitude"), F.lit(14.0).alias("longitude"),
        "timezone", payload.alias("payload"), F.to_json(payload).alias("payload_json"),
        dom.alias("_dom"), raw_file.alias("raw_file"))


def envelope_text(hourly_df: DataFrame) -> DataFrame:
    """F4 as whole envelope documents (what a landed file holds), one row each."""
    p = payload_rows(hourly_df)
    iso = F.concat(F.date_format("snapshot_time_utc", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    # source is left out on even days, endpoint when the day divides by 3
    source = F.when(F.col("_dom") % 2 == 0, F.lit(None)).otherwise(F.lit("fixture"))
    endpoint = F.when(F.col("_dom") % 3 == 0, F.lit(None)).otherwise(F.lit("v1/forecast"))
    env = F.struct(
        iso.alias("snapshot_time_utc"), source.alias("source"), endpoint.alias("endpoint"),
        F.struct(F.col("location_name").alias("name"), F.col("latitude").alias("lat"),
                 F.col("longitude").alias("lon"), F.col("timezone").alias("timezone")).alias("location"),
        F.col("payload").alias("payload"))
    # NULL fields (source, endpoint, cloud cover) are left out of the text
    return p.select("raw_file", F.to_json(env).alias("value"))


def raw_snapshots(hourly_df: DataFrame) -> DataFrame:
    """F4 as the landed ``raw_snapshots`` table."""
    return _raw(payload_rows(hourly_df))


def _raw(p: DataFrame) -> DataFrame:
    dom = F.col("_dom")
    return p.select(
        "snapshot_time_utc", "location_name", "latitude", "longitude", "timezone", "payload_json",
        F.when(dom % 2 == 0, F.lit(config.DEFAULT_SOURCE)).otherwise(F.lit("fixture")).alias("source"),
        F.when(dom % 3 == 0, F.lit(config.DEFAULT_ENDPOINT)).otherwise(F.lit("v1/forecast")).alias("endpoint"),
        "raw_file")
