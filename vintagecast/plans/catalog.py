"""Registered queries: one builder per operator, each ``(spark, sf_dir) -> DataFrame``.

Every builder reads the driver's tables (``events``, ``orders``,
``lineitem``) or fixtures Spark derives from them, so its work grows with
the data.  The matching DuckDB SQL lives in ``vintagecast.plans.oracle``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagecast import config
from vintagecast.config import RULES
from vintagecast.operators import alerts, brief, gating, health, normalize, profile, versions
from vintagecast.session import configure, ensure_checkpoint_dir, table_path
from vintagecast.sources import envelopes, fixtures as fx

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}

LOAD_CUTOFF_DAY = 16          # registry rows before this day of month are "already loaded"
LOCATION_FILTER = "u1"
FIXED_INSERT_TIME = "2024-02-01 00:00:00"
LANDED = "*"                  # files of ``write_envelopes``, named as their envelopes


def query(name: str):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        return fn
    return deco


def _h(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return fx.hourly(spark, sf)


def _runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    h = _h(spark, sf)
    return h, fx.runs(h)


# ------------------------------------------------------------------ sources
def _write_envelopes(spark: SparkSession, sf: str) -> str:
    """Land F4 as one JSON file per envelope in the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    out = os.path.join(base, f"envelopes-{uuid.uuid4().hex}")
    envelopes.write_envelopes(fx.envelope_text(_h(spark, sf)), out)
    return out


def _renamed_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    text = envelopes.read_envelope_text(spark, _write_envelopes(spark, sf), glob=LANDED)
    return text


@query("read_envelopes")
def q_read_envelopes(spark, sf):
    text = _renamed_envelopes(spark, sf)
    raw = envelopes.envelope_project(text, spark.conf.get("spark.sql.session.timeZone"))
    n = F.size(F.from_json("payload_json", "hourly struct<time: array<string>>")["hourly"]["time"])
    return raw.select("snapshot_time_utc", "location_name", "latitude", "longitude", "timezone", "source",
                      "endpoint", n.cast("bigint").alias("n_hours"))


@query("newest_file")
def q_newest_file(spark, sf):
    text = fx.envelope_text(_h(spark, sf))
    last = text.agg(F.max("raw_file")).first()[0]
    out = os.path.join(ensure_checkpoint_dir(spark), f"envelopes-{uuid.uuid4().hex}")
    for part in (text.where(F.col("raw_file") != last), text.where(F.col("raw_file") == last)):  # the last is the newest
        envelopes.write_envelopes(part, out)
    newest = envelopes.read_newest_file(spark, out, glob=LANDED)
    raw = envelopes.envelope_project(newest, spark.conf.get("spark.sql.session.timeZone"))
    return raw.select("location_name", "snapshot_time_utc",
                      F.regexp_extract("raw_file", "([^/=]+)(/part-[^/]*)?$", 1).alias("raw_file"))


@query("envelope_project")
def q_envelope_project(spark, sf):
    text = fx.envelope_text(_h(spark, sf))
    raw = envelopes.envelope_project(text, spark.conf.get("spark.sql.session.timeZone"))
    return raw.drop("payload_json")


def _registry(spark, sf):
    configure(spark)
    return fx.registry(spark, sf)


@query("dedup_raw")
def q_dedup_raw(spark, sf):
    configure(spark)
    return normalize.dedup_raw(fx.registry_with_copies(spark, sf))


@query("load_once")
def q_load_once(spark, sf):
    configure(spark)
    incoming = fx.registry_with_copies(spark, sf)
    existing = fx.registry(spark, sf).where(F.dayofmonth("snapshot_time_utc") < LOAD_CUTOFF_DAY)
    return envelopes.load_once(incoming, existing.select("raw_file"), existing)


@query("registry_append")
def q_registry_append(spark, sf):
    configure(spark)
    raw = fx.events(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("location_name"),
        F.col("ts").alias("snapshot_time_utc"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("raw_file"),
        F.col("props").alias("payload_json"))
    return envelopes.registry_rows(raw, F.lit(FIXED_INSERT_TIME).cast("timestamp_ntz"))


@query("content_hash")
def q_content_hash(spark, sf):
    configure(spark)
    ev = fx.events(spark, sf)
    return ev.select("event_id", normalize.canonical_hash(F.col("props")).alias("content_hash"))


@query("content_changed")
def q_content_changed(spark, sf):
    return normalize.content_changed(_registry(spark, sf))


# ------------------------------------------------------------------ normalization
def _raw(spark, sf):
    return fx.raw_snapshots(_h(spark, sf))


@query("normalize_hourly")
def q_normalize_hourly(spark, sf):
    return normalize.normalize_hourly(_raw(spark, sf))


@query("explode_parallel_arrays")
def q_explode(spark, sf):
    e = normalize.explode_parallel_arrays(_raw(spark, sf))
    return e.select("location_name", "snapshot_time_utc", "idx", "forecast_time_str",
                    *[F.expr(f"try_cast({c} AS DOUBLE)").alias(c) for c in
                      ("temperature_2m", "apparent_temperature", "precipitation", "windspeed_10m", "cloudcover")])


@query("has_field_cloudcover")
def q_has_cloud(spark, sf):
    return normalize.has_field(_raw(spark, sf), "$.hourly.cloudcover", "has_cloudcover")


@query("has_field_weathercode")
def q_has_weathercode(spark, sf):
    return normalize.has_field(_raw(spark, sf), "$.hourly.weathercode", "has_hourly_weathercode")


# ------------------------------------------------------------------ versions
@query("latest_snapshot")
def q_latest_snapshot(spark, sf):
    return versions.latest_snapshot_rows(_h(spark, sf))


@query("latest_registered")
def q_latest_registered(spark, sf):
    return versions.latest_per_location(_registry(spark, sf))


@query("latest_two_snapshots")
def q_latest_two(spark, sf):
    return versions.latest_two_snapshots(_h(spark, sf))


@query("latest_two_orders")
def q_latest_two_orders(spark, sf):
    configure(spark)
    o = spark.read.parquet(table_path(sf, "orders")).select("o_custkey", "o_orderkey", "o_orderdate")
    top = versions.latest_n(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 2)
    return top.select("o_custkey", "o_orderkey", "o_orderdate", F.col("rn").cast("bigint").alias("rn"))


@query("snapshot_dense_rank")
def q_dense_rank(spark, sf):
    return versions.snapshot_dense_rank(_h(spark, sf)).select(
        "location_name", "snapshot_time_utc", "idx", "forecast_time_local", "snapshot_rank")


@query("snapshot_deltas")
def q_deltas(spark, sf):
    return versions.snapshot_deltas(_h(spark, sf))


@query("snapshot_deltas_all")
def q_deltas_all(spark, sf):
    return versions.snapshot_deltas_all(_h(spark, sf))


@query("forecast_history")
def q_history(spark, sf):
    return versions.forecast_history(_h(spark, sf))


# ------------------------------------------------------------------ windows and filters
def _current_rows(spark, sf):
    h, r = _runs(spark, sf)
    return h, r, versions.current_versions(versions.snapshot_list(h), r)


_HZ_COLS = ["location_name", "as_of_utc", "snapshot_time_utc", "forecast_time_local", "temperature_c",
            "precipitation_mm", "wind_kmh"]


@query("horizon_exact")
def q_horizon_exact(spark, sf):
    h, _, v = _current_rows(spark, sf)
    return alerts.horizon_rows(h, v, RULES.alert_horizon_hours).select(*_HZ_COLS)


@query("horizon_hour_aligned")
def q_horizon_aligned(spark, sf):
    h, _, v = _current_rows(spark, sf)
    return alerts.horizon_rows(h, v, RULES.digest_horizon_hours, align_hour=True).select(*_HZ_COLS)


@query("today_band")
def q_today_band(spark, sf):
    h, r = _runs(spark, sf)
    return brief._today_band(h, r, RULES).select(*_HZ_COLS)


@query("hour_band")
def q_hour_band(spark, sf):
    h = _h(spark, sf)
    return h.where(F.col("forecast_hour_local").between(RULES.profile_first_hour, RULES.profile_last_hour))


@query("calendar_day_filter")
def q_calendar_day(spark, sf):
    h, _, v = _current_rows(spark, sf)
    from vintagecast.functions.columns import to_local
    from vintagecast.functions.columns import day_floor, plus_hours
    local = to_local("as_of_utc", F.col("timezone"))
    v = v.withColumn("run_date", F.to_date(local)).withColumn("_day", day_floor(local))
    j = alerts.rows_in_windows(h, v, plus_hours("_day", -24), plus_hours("_day", 24))
    back = F.datediff("run_date", "forecast_date_local")
    return j.where(back.isin(0, 1)).select("location_name", "as_of_utc", "snapshot_time_utc",
                                           "forecast_time_local", back.cast("bigint").alias("day_offset"))


@query("data_driven_today")
def q_data_driven_today(spark, sf):
    return brief.data_driven_today(_h(spark, sf))


@query("location_filter")
def q_location_filter(spark, sf):
    return _h(spark, sf).where(F.col("location_name") == LOCATION_FILTER)


def _lineitem(spark, sf):
    configure(spark)
    return spark.read.parquet(table_path(sf, "lineitem"))


@query("having_filter")
def q_having(spark, sf):
    return profile.duplicate_keys(_lineitem(spark, sf), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------ alerts
@query("rain_flag")
def q_rain_flag(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.flags_per_version(h, r).select("location_name", "as_of_utc", F.col("rn").cast("bigint"),
                                                 "snapshot_time_utc", "rain_next6h")


@query("wind_max")
def q_wind_max(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.flags_per_version(h, r).select("location_name", "as_of_utc", F.col("rn").cast("bigint"),
                                                 "snapshot_time_utc", "max_wind_next6h")


@query("rain_pivot")
def q_rain_pivot(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.rain_decision(h, r).drop("should_alert_rain_next6h")


@query("wind_pivot")
def q_wind_pivot(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.wind_decision(h, r).drop("should_alert_wind_next6h")


@query("rain_decision")
def q_rain_decision(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.rain_decision(h, r)


@query("show_decision")
def q_show_decision(spark, sf):
    return q_rain_decision(spark, sf)


@query("wind_decision")
def q_wind_decision(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.wind_decision(h, r)


@query("alert_replay")
def q_alert_replay(spark, sf):
    h, r = _runs(spark, sf)
    return alerts.decisions(h, r)


@query("alert_replay_wide")
def q_alert_replay_wide(spark, sf):
    configure(spark)
    h = fx.hourly(spark, sf)
    return alerts.decisions(h, fx.runs(h))


# ------------------------------------------------------------------ gating
def _log(spark, sf):
    configure(spark)
    return fx.alert_log(spark, sf)


@query("last_sent")
def q_last_sent(spark, sf):
    log = _log(spark, sf)
    rain, wind = (gating.last_sent(log, t).withColumn("alert_type", F.lit(t))
                  for t in (config.RAIN_ALERT_TYPE, config.WIND_ALERT_TYPE))
    return rain.unionByName(wind)


def _gated(spark, sf):
    h, r = _runs(spark, sf)
    d = alerts.decisions(h, r)
    return gating.gated_both(d, _log(spark, sf))


@query("rain_gated")
def q_rain_gated(spark, sf):
    return _gated(spark, sf)[0]


@query("wind_gated")
def q_wind_gated(spark, sf):
    return _gated(spark, sf)[1]


@query("alert_outbox")
def q_alert_outbox(spark, sf):
    h, r = _runs(spark, sf)
    return gating.outbox(alerts.decisions(h, r), _log(spark, sf))


def _stored(h: DataFrame, name: str) -> DataFrame:
    """Hourly rows landed once as Parquet: the version list, the runs and the
    windows all read them."""
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(h.sparkSession, name), "hourly")
    tables.append(h, path)
    return tables.read_table(h.sparkSession, path, h.schema)


def _feed(spark, sf):
    """F7 normalised, with a run at each snapshot."""
    configure(spark)
    h = _stored(normalize.normalize_hourly(fx.feed_raw(spark, sf)), "feed")
    return h, fx.runs(h, (0,))


@query("alert_feed")
def q_alert_feed(spark, sf):
    return alerts.decisions(*_feed(spark, sf))


@query("alert_feed_outbox")
def q_alert_feed_outbox(spark, sf):
    from vintagecast.schemas import ALERT_LOG
    return gating.outbox(alerts.decisions(*_feed(spark, sf)), spark.createDataFrame([], ALERT_LOG))


@query("brief_feed")
def q_brief_feed(spark, sf):
    return brief.brief_final(*_feed(spark, sf))


@query("cooldown_replay")
def q_cooldown_replay(spark, sf):
    configure(spark)
    return gating.cooldown_replay(fx.decisions(spark, sf))


# ------------------------------------------------------------------ health
def _zone():
    return F.lit(fx.HEALTH_ZONE)


@query("snapshots_of_day")
def q_snapshots_of_day(spark, sf):
    return health.snapshots_of_day(_registry(spark, sf), _zone())


@query("dedup_hours")
def q_dedup_hours(spark, sf):
    return health.dedup_hours(health.snapshots_of_day(_registry(spark, sf), _zone()))


@query("expected_hours")
def q_expected_hours(spark, sf):
    s = health.snapshots_of_day(_registry(spark, sf), _zone())
    return health.expected_hours(health.day_spine(s))


@query("missing_hours")
def q_missing_hours(spark, sf):
    s = health.snapshots_of_day(_registry(spark, sf), _zone())
    return health.missing_hours(health.day_rows(s))


@query("hash_changes")
def q_hash_changes(spark, sf):
    s = health.snapshots_of_day(_registry(spark, sf), _zone())
    return health.hash_changes(health.dedup_hours(s))


@query("change_rate")
def q_change_rate(spark, sf):
    s = health.snapshots_of_day(_registry(spark, sf), _zone())
    return health.change_rate(health.hash_changes(health.dedup_hours(s)))


@query("missing_hours_list")
def q_missing_list(spark, sf):
    s = health.snapshots_of_day(_registry(spark, sf), _zone())
    return health.missing_hours_list(health.day_rows(s))


@query("snapshot_health")
def q_snapshot_health(spark, sf):
    return health.snapshot_health(_registry(spark, sf), _zone())


@query("health_latest")
def q_health_latest(spark, sf):
    return health.health_latest(health.snapshot_health(_registry(spark, sf), _zone()))


# ------------------------------------------------------------------ digest
@query("brief_v1")
def q_brief_v1(spark, sf):
    return brief.brief_v1(*_runs(spark, sf))


@query("brief_v2")
def q_brief_v2(spark, sf):
    return brief.brief_v2(*_runs(spark, sf))


@query("dayparts_line")
def q_dayparts_line(spark, sf):
    return brief.dayparts_line(*_runs(spark, sf))


@query("dayparts_meta")
def q_dayparts_meta(spark, sf):
    return brief.dayparts_meta(*_runs(spark, sf))


@query("brief_final")
def q_brief_final(spark, sf):
    return brief.brief_final(*_runs(spark, sf))


def _final_runs(spark, sf):
    h = _h(spark, sf)
    return h, fx.final_runs(h)


@query("brief_metrics")
def q_brief_metrics(spark, sf):
    return brief.brief_metrics(*_final_runs(spark, sf))


@query("brief_metrics_faithful")
def q_brief_metrics_faithful(spark, sf):
    return brief.brief_metrics_faithful(_h(spark, sf))


def _stored_runs(spark, sf):
    h = _stored(_h(spark, sf), "history")
    return h, fx.runs(h)


@query("last4_avg")
def q_last4(spark, sf):
    return brief.last4_avg(*_stored_runs(spark, sf))


@query("most_changed_daypart")
def q_most_changed(spark, sf):
    return brief.most_changed_daypart(*_stored_runs(spark, sf))


@query("daily_headline")
def q_daily_headline(spark, sf):
    return brief.daily_headline(*_stored_runs(spark, sf))


@query("brief_outbox")
def q_brief_outbox(spark, sf):
    h = _h(spark, sf)
    r = fx.digest_runs(h)
    final = brief.brief_final(h, r)
    return brief.brief_outbox(final, r, fx.brief_log(spark, sf)).drop("to_log")


# ------------------------------------------------------------------ profile
@query("raw_summary")
def q_raw_summary(spark, sf):
    return profile.key_summary(_raw(spark, sf), "location_name", "snapshot_time_utc", "n_snapshots",
                               "first_snapshot_utc", "last_snapshot_utc")


@query("registry_summary")
def q_registry_summary(spark, sf):
    return profile.key_summary(_registry(spark, sf), "location_name", "snapshot_time_utc", "n_files_loaded",
                               "first_snapshot", "last_snapshot")


@query("hourly_summary")
def q_hourly_summary(spark, sf):
    return profile.hourly_summary(_h(spark, sf))


@query("duplicate_key_count")
def q_dup_count(spark, sf):
    return profile.duplicate_key_count(_h(spark, sf), ["location_name", "snapshot_time_utc", "forecast_time_local"])


@query("duplicate_key_count_lineitem")
def q_dup_count_li(spark, sf):
    return profile.duplicate_key_count(_lineitem(spark, sf), ["l_orderkey", "l_linenumber"])


@query("duplicate_examples")
def q_dup_examples(spark, sf):
    return profile.duplicate_examples(_lineitem(spark, sf), ["l_orderkey", "l_linenumber"], "l_suppkey",
                                      [F.col("l_orderkey").desc(), F.col("l_linenumber")])


@query("hours_per_snapshot")
def q_hours_per_snapshot(spark, sf):
    g = profile.rows_per_snapshot(_h(spark, sf)).withColumnRenamed("rows", "n_hours")
    return profile.top_per_key(g, ["location_name"], [F.col("snapshot_time_utc").desc()], 20)


@query("rows_per_snapshot")
def q_rows_per_snapshot(spark, sf):
    return profile.rows_per_snapshot(_h(spark, sf))


@query("rows_per_snapshot_newest")
def q_rows_per_snapshot_newest(spark, sf):
    g = profile.rows_per_snapshot(_h(spark, sf))
    return profile.top_per_key(g, ["location_name"], [F.col("snapshot_time_utc").desc()], 10)


@query("cloud_range")
def q_cloud_range(spark, sf):
    g = _h(spark, sf).groupBy("location_name", "snapshot_time_utc").agg(
        F.min("cloudcover_pct").alias("min_cloud"), F.max("cloudcover_pct").alias("max_cloud"))
    return profile.top_per_key(g, ["location_name"], [F.col("snapshot_time_utc").desc()], 3)


@query("latest_raw")
def q_latest_raw(spark, sf):
    r = _raw(spark, sf).select("location_name", "snapshot_time_utc", "raw_file")
    return profile.top_per_key(r, ["location_name"], [F.col("snapshot_time_utc").desc()], 5)


@query("registry_latest")
def q_registry_latest(spark, sf):
    r = _registry(spark, sf).select("location_name", "snapshot_time_utc")
    return profile.top_per_key(r, ["location_name"], [F.col("snapshot_time_utc").desc()], 5)


@query("total_rows")
def q_total_rows(spark, sf):
    return _h(spark, sf).agg(F.count(F.lit(1)).alias("total_rows"))


@query("distribution_profile")
def q_distribution(spark, sf):
    measures = {"temperature_c": "temp", "feels_like_c": "feels", "precipitation_mm": "precip",
                "wind_kmh": "wind"}
    qs = {"temperature_c": [0.05, 0.5, 0.95], "feels_like_c": [0.5], "precipitation_mm": [0.5, 0.95],
          "wind_kmh": [0.5, 0.95]}
    return profile.distribution_profile(_h(spark, sf), "location_name", measures, qs,
                                        zero_rate=("precipitation_mm",))


@query("distribution_profile_lineitem")
def q_distribution_li(spark, sf):
    measures = {"l_quantity": "qty", "l_extendedprice": "price", "l_discount": "disc"}
    qs = {m: [0.05, 0.5, 0.95] for m in measures}
    return profile.distribution_profile(_lineitem(spark, sf), "l_returnflag", measures, qs,
                                        zero_rate=("l_discount",))


@query("daypart_summary_today")
def q_daypart_today(spark, sf):
    return brief.daypart_summary_today(*_runs(spark, sf))


@query("daypart_summary_yesterday")
def q_daypart_yesterday(spark, sf):
    return brief.daypart_summary_yesterday(*_runs(spark, sf))


@query("compare_days")
def q_compare_days(spark, sf):
    return brief.compare_days(*_runs(spark, sf))


@query("latest_rows_with_type")
def q_latest_rows_with_type(spark, sf):
    return profile.latest_rows_with_type(_h(spark, sf))


@query("stats_and_sample")
def q_stats_and_sample(spark, sf):
    return profile.stats_and_sample(_h(spark, sf))


# ------------------------------------------------------------------ streaming
# Each key lands its input as files in the shared checkpoint folder, runs the
# streaming query with an availableNow trigger and reads the sink back.  One
# trigger sees every file, so the result equals the batch rule and the
# batch oracle applies; multi-batch behaviour is covered in
# tests/test_streaming.py.
def _stream_base(spark: SparkSession, name: str) -> str:
    configure(spark)
    return os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex}")


def _landed(df: DataFrame, base: str) -> str:
    path = os.path.join(base, "in")
    df.write.parquet(path)
    return path


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    from vintagecast.streaming import streams
    folder = _write_envelopes(spark, sf)
    base = _stream_base(spark, "ingest")
    raw_p, reg_p = os.path.join(base, "raw"), os.path.join(base, "registry")
    streams.stream_ingest(spark, folder, raw_p, reg_p, os.path.join(base, "ckpt"), glob=LANDED)
    raw = spark.read.parquet(raw_p)
    n = F.size(F.from_json("payload_json", "hourly struct<time: array<string>>")["hourly"]["time"])
    return raw.select("snapshot_time_utc", "location_name", "latitude", "longitude", "timezone", "source",
                      "endpoint", n.cast("bigint").alias("n_hours"))


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    from vintagecast.streaming import streams
    base = _stream_base(spark, "dedup")
    reg = fx.registry_with_copies(spark, sf)
    src = streams.table_stream(spark, _landed(reg, base), reg.schema)
    out = os.path.join(base, "out")
    streams.stream_dedup(src, out, os.path.join(base, "ckpt"))
    return spark.read.parquet(out).select("location_name", "raw_file", "snapshot_time_utc")


@query("stream_hour_counts")
def q_stream_hour_counts(spark, sf):
    from vintagecast.streaming import streams
    base = _stream_base(spark, "hours")
    reg = fx.registry_with_copies(spark, sf)
    src = streams.table_stream(spark, _landed(reg, base), reg.schema)
    out = os.path.join(base, "out")
    streams.run_updates_to_parquet(streams.stream_hour_counts(src), out, os.path.join(base, "ckpt"))
    return streams.newest_updates(spark, out, ["location_name", "hour_start_utc"])


@query("stream_change")
def q_stream_change(spark, sf):
    from vintagecast.streaming import streams
    base = _stream_base(spark, "change")
    reg = _registry(spark, sf)
    src = streams.table_stream(spark, _landed(reg, base), reg.schema)
    out = os.path.join(base, "out")
    streams.run_to_parquet(streams.stream_change(src), out, os.path.join(base, "ckpt"))
    return spark.read.parquet(out)


@query("stream_cooldown")
def q_stream_cooldown(spark, sf):
    from vintagecast.streaming import streams
    configure(spark)
    base = _stream_base(spark, "cooldown")
    dec = fx.decisions(spark, sf)
    src = streams.table_stream(spark, _landed(dec, base), dec.schema)
    out = os.path.join(base, "out")
    streams.run_to_parquet(streams.stream_cooldown(src), out, os.path.join(base, "ckpt"))
    return spark.read.parquet(out)


@query("stream_change_by_snapshot")
def q_stream_change_by_snapshot(spark, sf):
    from vintagecast.streaming import streams
    base = _stream_base(spark, "change-late")
    reg = _registry(spark, sf)
    path, out = os.path.join(base, "in"), os.path.join(base, "out")
    odd = F.pmod(F.xxhash64("raw_file"), F.lit(2)) == 1
    for part in (reg.where(odd), reg.where(~odd)):      # every second file comes late
        part.write.mode("append").parquet(path)
        src = streams.table_stream(spark, path, reg.schema)
        streams.stream_change_by_snapshot(src, out, os.path.join(base, "ckpt"))
    return streams.newest_updates(spark, out, ["raw_file"])


def _forecast_chain(spark: SparkSession, sf: str, name: str) -> str:
    """F7 landed in three parts in time order, the job run after each; the folder of its tables."""
    from vintagecast.schemas import RAW_SNAPSHOTS
    from vintagecast.streaming import streams
    base = _stream_base(spark, name)
    raw = fx.feed_raw(spark, sf).select(*RAW_SNAPSHOTS.fieldNames())
    path = os.path.join(base, "in")
    third = F.least(F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{fx.FEED_START}', snapshot_time_utc) div 60"), F.lit(2))
    for i in range(3):
        raw.where(third == i).write.mode("append").parquet(path)
        src = streams.table_stream(spark, path, RAW_SNAPSHOTS)
        streams.stream_forecasts(src, base, os.path.join(base, "ckpt"))
    return base


@query("stream_alert")
def q_stream_alert(spark, sf):
    from vintagecast.schemas import ALERT_LOG
    from vintagecast.sources import tables
    log = os.path.join(_forecast_chain(spark, sf, "alert"), "alert_log")
    return tables.read_table(spark, log, ALERT_LOG).select(*ALERT_LOG.fieldNames())


@query("stream_brief_once")
def q_stream_brief_once(spark, sf):
    from vintagecast.schemas import BRIEF_LOG
    from vintagecast.sources import tables
    log = os.path.join(_forecast_chain(spark, sf, "brief"), "brief_log")
    return tables.read_table(spark, log, BRIEF_LOG).select(*BRIEF_LOG.fieldNames())


# ------------------------------------------------------------------ sinks
# Each writes in two appends to a fresh table in the shared folder and reads it back.
def _halves(df: DataFrame, key: str) -> list[DataFrame]:
    half = F.pmod(F.xxhash64(key), F.lit(2))
    return [df.where(half == i) for i in (0, 1)]


@query("append_alert_log")
def q_append_alert_log(spark, sf):
    from vintagecast.schemas import ALERT_LOG
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(spark, "alert-log"), "t")
    tables.create_if_missing(spark, path, ALERT_LOG)
    for part in _halves(q_alert_outbox(spark, sf), "location_name"):
        tables.append_alert_log(part.select(*ALERT_LOG.fieldNames()), path)
    return tables.read_table(spark, path, ALERT_LOG).select(*ALERT_LOG.fieldNames())


@query("append_brief_log")
def q_append_brief_log(spark, sf):
    from vintagecast.schemas import BRIEF_LOG
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(spark, "brief-log"), "t")
    rows = q_brief_outbox(spark, sf).withColumn("to_log", F.lit(True))
    for part in _halves(rows, "location_name"):
        tables.append_brief_log(part, path)
    return tables.read_table(spark, path, BRIEF_LOG).select(*BRIEF_LOG.fieldNames())


@query("append_health")
def q_append_health(spark, sf):
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(spark, "health"), "t")
    reg = _registry(spark, sf)
    spine = health.day_spine(health.snapshots_of_day(reg, _zone()))
    for part in _halves(spine, health.DAY):  # a run writes the health of its own dates
        out = health.snapshot_health(reg, _zone(), dates=part)
        tables.append_health(out, F.lit(FIXED_INSERT_TIME).cast("timestamp_ntz"), path)
    return spark.read.parquet(path).drop("run_time_utc")


@query("rebuild_table")
def q_rebuild_table(spark, sf):
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(spark, "rebuild"), "t")
    h = _h(spark, sf).withColumn("snapshot_date", F.to_date("snapshot_time_utc"))
    tables.rebuild_table(h.withColumn("wind_kmh", F.lit(-1.0)), path, ["snapshot_date"])
    for part in _halves(h, "snapshot_date"):  # dates present are replaced, others stay
        tables.rebuild_table(part, path, ["snapshot_date"])
    return spark.read.parquet(path).drop("snapshot_date")


@query("create_if_missing")
def q_create_if_missing(spark, sf):
    from vintagecast.schemas import SNAPSHOT_REGISTRY
    from vintagecast.sources import tables
    path = os.path.join(_stream_base(spark, "create"), "t")
    for part in _halves(_registry(spark, sf), "raw_file"):
        tables.create_if_missing(spark, path, SNAPSHOT_REGISTRY)
        tables.append(part.select(*SNAPSHOT_REGISTRY.fieldNames()), path)
    return tables.read_table(spark, path, SNAPSHOT_REGISTRY)


# ------------------------------------------------------------------ wide variants
# Kept from when only these were keyed by user; F1 is now as well.
def _hw(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return fx.hourly(spark, sf)


@query("brief_final_wide")
def q_brief_final_wide(spark, sf):
    h = _hw(spark, sf)
    return brief.brief_final(h, fx.runs(h))


@query("compare_days_wide")
def q_compare_days_wide(spark, sf):
    h = _hw(spark, sf)
    return brief.compare_days(h, fx.runs(h))


@query("brief_metrics_wide")
def q_brief_metrics_wide(spark, sf):
    h = _hw(spark, sf)
    return brief.brief_metrics(h, fx.final_runs(h))


@query("snapshot_deltas_all_wide")
def q_deltas_all_wide(spark, sf):
    return versions.snapshot_deltas_all(_hw(spark, sf))


@query("forecast_history_wide")
def q_history_wide(spark, sf):
    return versions.forecast_history(_hw(spark, sf))


@query("normalize_hourly_wide")
def q_normalize_wide(spark, sf):
    return normalize.normalize_hourly(fx.raw_snapshots(_hw(spark, sf)))
