"""Raw JSON payloads -> one row per (location, snapshot, forecast hour).

One ``from_json`` per payload with a typed schema (not one JSON parse per
array element), then ``posexplode`` of the ``time`` array and ``get`` on the
other arrays: an index past the end of a shorter array gives NULL, a missing
array gives NULL, a missing ``time`` array gives no rows.  Narrow, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagecast.schemas import HOURLY_ARRAYS, PAYLOAD_SCHEMA
from vintagecast.functions.columns import hour_of

KEY = "location_name"
SNAP = "snapshot_time_utc"


def parse_payload(raw: DataFrame) -> DataFrame:
    """Add the typed ``hourly`` struct of arrays (values kept as text, cast
    per element with ``try_cast`` so one bad number spoils one cell only)."""
    return raw.withColumn("_p", F.from_json("payload_json", PAYLOAD_SCHEMA))


def explode_parallel_arrays(raw: DataFrame) -> DataFrame:
    """(location, snapshot, zone, idx 0-based, forecast_time_str, raw element texts).

    The outer form with the filter behind it: for the inner form the optimizer
    puts filters on the array below, which parse each payload two times more."""
    p = parse_payload(raw)
    e = p.select(KEY, SNAP, "timezone", "_p.hourly.*").select(
        KEY, SNAP, "timezone", F.posexplode_outer("time").alias("idx", "forecast_time_str"),
        *[F.col(src) for src, _ in HOURLY_ARRAYS]).where(F.col("idx").isNotNull())
    return e.select(KEY, SNAP, "timezone", F.col("idx").cast("bigint").alias("idx"), "forecast_time_str",
                    *[F.get(F.col(src), F.col("idx")).alias(src) for src, _ in HOURLY_ARRAYS])


def normalize_hourly(raw: DataFrame) -> DataFrame:
    """raw_snapshots -> snapshots_hourly (union of both source builders' columns)."""
    e = explode_parallel_arrays(raw)
    ft = F.try_to_timestamp(F.col("forecast_time_str")).cast("timestamp_ntz")
    e = e.withColumn("forecast_time_local", ft)
    return e.select(
        KEY, SNAP, "timezone", "idx", "forecast_time_local",
        F.to_date("forecast_time_local").alias("forecast_date_local"),
        hour_of("forecast_time_local").alias("forecast_hour_local"),
        *[F.expr(f"try_cast({src} AS DOUBLE)").alias(dst) for src, dst in HOURLY_ARRAYS])


def has_field(raw: DataFrame, path: str, name: str) -> DataFrame:
    """Does each payload carry the field (JSON null counts as absent)."""
    return raw.select(KEY, SNAP, F.get_json_object("payload_json", path).isNotNull().alias(name))


def dedup_raw(raw: DataFrame, tie: str = "raw_file") -> DataFrame:
    """One row per ``raw_file``: the earliest snapshot time (keyed ``min_by``,
    partial aggregation; no window sort)."""
    cols = [c for c in raw.columns]
    best = F.min_by(F.struct(*cols), F.struct(SNAP, *[c for c in cols if c != SNAP]))
    return raw.groupBy("raw_file").agg(best.alias("_b")).select("_b.*")


def content_changed(registry: DataFrame) -> DataFrame:
    """Is the hash unlike that of the location's previous registered snapshot
    (TRUE for the first)."""
    from vintagecast.operators.asof import prev_in_key
    r = registry.select(KEY, SNAP, "raw_file", "content_hash")
    p = prev_in_key(r, [KEY], SNAP, ["raw_file"], ["content_hash"], out="_p")
    return p.select(KEY, SNAP, "raw_file", "content_hash",
                    F.coalesce(F.col("_p.content_hash") != F.col("content_hash"), F.lit(True)).alias("content_changed"))


def canonical_hash(json_text: F.Column, path: str = "$") -> F.Column:
    """sha256 of a JSON text, or of the part of it at ``path``, with every
    object's keys in order and no white space.  All fields count, whatever
    they are called; a text that isn't JSON has the hash of the text itself."""
    value = F.try_parse_json(json_text)
    part = value if path == "$" else F.try_variant_get(value, path, "variant")
    return F.when(value.isNull(), F.sha2(json_text, 256)).otherwise(F.sha2(F.to_json(part), 256))
