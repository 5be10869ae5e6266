"""Envelope and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# payload array name -> hourly column (fixed by the source feed's field names)
HOURLY_ARRAYS: tuple[tuple[str, str], ...] = (
    ("temperature_2m", "temperature_c"),
    ("apparent_temperature", "feels_like_c"),
    ("precipitation", "precipitation_mm"),
    ("windspeed_10m", "wind_kmh"),
    ("cloudcover", "cloudcover_pct"),
)

_TEXT_ARRAY = T.ArrayType(T.StringType())
# Numbers are read as text and cast per element: a bad element gives one NULL
# instead of a NULL array.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType(
        [T.StructField("time", _TEXT_ARRAY)] + [T.StructField(src, _TEXT_ARRAY) for src, _ in HOURLY_ARRAYS]))
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("snapshot_time_utc", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("name", T.StringType()), T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()), T.StructField("timezone", T.StringType())])),
    # a STRING field keeps the nested object as its raw JSON text
    T.StructField("payload", T.StringType()),
])

RAW_SNAPSHOTS = T.StructType([
    T.StructField("snapshot_time_utc", T.TimestampNTZType()), T.StructField("location_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()), T.StructField("payload_json", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("endpoint", T.StringType()),
    T.StructField("raw_file", T.StringType()),
])

SNAPSHOT_REGISTRY = T.StructType([
    T.StructField("location_name", T.StringType()), T.StructField("snapshot_time_utc", T.TimestampNTZType()),
    T.StructField("raw_file", T.StringType()), T.StructField("content_hash", T.StringType()),
    T.StructField("inserted_at_utc", T.TimestampNTZType()),
])

ALERT_LOG = T.StructType([
    T.StructField("sent_time_utc", T.TimestampNTZType()), T.StructField("alert_type", T.StringType()),
    T.StructField("snapshot_time_utc", T.TimestampNTZType()), T.StructField("message", T.StringType()),
    T.StructField("location_name", T.StringType()),
])

BRIEF_LOG = T.StructType([
    T.StructField("sent_date_local", T.DateType()), T.StructField("sent_time_utc", T.TimestampNTZType()),
    T.StructField("location_name", T.StringType()), T.StructField("message", T.StringType()),
])

SNAPSHOT_HEALTH = T.StructType([
    T.StructField("run_time_utc", T.TimestampNTZType()), T.StructField("location_name", T.StringType()),
    T.StructField("today_local_date", T.DateType()), T.StructField("snapshots_today", T.LongType()),
    T.StructField("last_snapshot_local", T.TimestampNTZType()),
    T.StructField("change_rate_pct_today", T.DoubleType()),
    T.StructField("missing_hour_count_06_19", T.LongType()), T.StructField("missing_hours_list", T.StringType()),
])

#: What ``normalize_hourly`` gives; stored by snapshot date.
SNAPSHOTS_HOURLY = T.StructType([
    *(T.StructField(n, t) for n, t in (
        ("location_name", T.StringType()), ("snapshot_time_utc", T.TimestampNTZType()), ("timezone", T.StringType()),
        ("idx", T.LongType()), ("forecast_time_local", T.TimestampNTZType()), ("forecast_date_local", T.DateType()),
        ("forecast_hour_local", T.LongType()))),
    *(T.StructField(n, T.DoubleType()) for n in (
        "temperature_c", "feels_like_c", "precipitation_mm", "wind_kmh", "cloudcover_pct")),
])
