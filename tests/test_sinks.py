"""Table sinks: create when missing, appends, rebuild with dynamic overwrite,
hourly layout with partition pruning."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vintagecast.operators import health, versions
from vintagecast.schemas import ALERT_LOG, BRIEF_LOG, SNAPSHOT_HEALTH
from vintagecast.sources import fixtures as fx
from vintagecast.sources import tables


def _dir():
    return tempfile.mkdtemp(prefix="vc-sink-")


def test_create_if_missing_keeps_existing(spark):
    p = os.path.join(_dir(), "alert_log")
    tables.create_if_missing(spark, p, ALERT_LOG)
    assert tables.exists(spark, p) and spark.read.parquet(p).count() == 0
    row = spark.createDataFrame([(dt.datetime(2024, 3, 1, 8), "rain_next6h", None, "m", "L")], ALERT_LOG)
    tables.append_alert_log(row, p)
    tables.create_if_missing(spark, p, ALERT_LOG)          # must not wipe the log
    assert spark.read.parquet(p).count() == 1


def test_brief_log_only_logged_rows(spark):
    p = os.path.join(_dir(), "brief_log")
    rows = spark.createDataFrame(
        [(dt.date(2024, 3, 1), dt.datetime(2024, 3, 1, 8), "L", "hi", True),
         (dt.date(2024, 3, 1), dt.datetime(2024, 3, 1, 8), "M", "hi", False)],
        "sent_date_local date, sent_time_utc timestamp_ntz, location_name string, message string, to_log boolean")
    tables.append_brief_log(rows, p)
    got = tables.read_table(spark, p, BRIEF_LOG)
    assert [r.location_name for r in got.collect()] == ["L"]


def test_append_health_keeps_history(spark):
    p = os.path.join(_dir(), "health")
    h = health.snapshot_health(fx.registry(spark, SF_SMALL), F.lit(fx.HEALTH_ZONE))
    n = h.count()
    tables.append_health(h, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), p)
    tables.append_health(h, F.lit("2024-02-01 01:00:00").cast("timestamp_ntz"), p)
    got = spark.read.parquet(p)
    assert got.count() == 2 * n
    assert set(SNAPSHOT_HEALTH.fieldNames()) <= set(got.columns)


def test_rebuild_replaces_only_given_partitions(spark):
    p = os.path.join(_dir(), "hourly")
    h = fx.hourly(spark, SF_SMALL)
    tables.write_hourly(h, p)
    first_day = h.where(F.dayofmonth("snapshot_time_utc") == 1)
    tables.write_hourly(first_day.withColumn("temperature_c", F.lit(99.0)), p)
    got = tables.read_hourly(spark, p)
    assert got.count() == h.count()
    assert got.where("temperature_c = 99.0").count() == first_day.count()


def test_hourly_layout_prunes_partitions(spark):
    p = os.path.join(_dir(), "hourly")
    tables.write_hourly(fx.hourly(spark, SF_SMALL), p)
    h = tables.read_hourly(spark, p)
    day = h.where(F.col("snapshot_date") == F.lit("2024-01-05").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    latest = versions.latest_snapshot_rows(h)
    assert latest.count() == versions.latest_snapshot_rows(fx.hourly(spark, SF_SMALL)).count()


def test_stored_hourly_gets_dynamic_partition_pruning(spark):
    from vintagecast.operators import alerts
    p = os.path.join(_dir(), "hourly")
    h0 = fx.hourly(spark, SF_SMALL)
    tables.write_hourly(h0, p)
    h = tables.read_hourly(spark, p)
    runs = fx.final_runs(h0)           # one run per location: only its newest two snapshot dates are needed
    v = versions.visible_versions(versions.snapshot_list(h0), runs)
    rows = alerts.horizon_rows(h, v, 6)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert rows.drop("snapshot_date").exceptAll(alerts.horizon_rows(h0, v, 6)).count() == 0


def test_append_hourly_keeps_same_day_snapshots(spark):
    p = os.path.join(_dir(), "hourly")
    h = fx.hourly(spark, SF_SMALL)
    first = h.where(F.col("location_name") == "click")
    rest = h.where(F.col("location_name") != "click")
    tables.append_hourly(first, p)
    tables.append_hourly(rest, p)          # same dates, other snapshots: nothing lost
    assert tables.read_hourly(spark, p).count() == h.count()


def test_alert_log_of_batch_and_stream_is_one(spark, tmp_path):
    from vintagecast.schemas import ALERT_LOG
    path = str(tmp_path / "log")
    row = lambda t: spark.createDataFrame([(t, "rain_next6h", t, "m", "L")], "sent_time_utc string, alert_type string, snapshot_time_utc string, message string, location_name string").selectExpr(
        "cast(sent_time_utc as timestamp_ntz) AS sent_time_utc", "alert_type", "cast(snapshot_time_utc as timestamp_ntz) AS snapshot_time_utc", "message", "location_name")
    for t in ("2024-01-01 09:00:00", "2024-01-02 09:00:00"):
        tables.append_alert_log(row(t), path)
    assert tables.read_table(spark, path, ALERT_LOG).count() == 2


def test_outbox_never_sends_twice_within_the_cooldown(spark):
    import datetime as dt
    from tests.conftest import hourly_rows, runs_df
    from vintagecast.operators import alerts, gating
    from vintagecast.schemas import ALERT_LOG
    rows = []
    for hour, wind in ((8, 0.0), (9, 40.0), (10, 80.0), (11, 120.0), (12, 160.0)):
        for ahead in range(1, 7):
            rows.append(("L", f"2024-01-01T{hour:02d}:00:00", f"2024-01-01T{hour + ahead:02d}:00:00", 1.0, 0.0, wind, 0.0))
    dec = alerts.decisions(hourly_rows(spark, rows), runs_df(spark, [("L", f"2024-01-01T{h:02d}:00:00") for h in (9, 10, 11, 12)]))
    empty = spark.createDataFrame([], ALERT_LOG)
    assert [r.sent_time_utc.hour for r in gating.outbox(dec, empty).orderBy("sent_time_utc").collect()] == [9, 11]
    sent = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 30), "wind_next6h", dt.datetime(2024, 1, 1, 8), "", "L")],
                                 "sent_time_utc timestamp_ntz, alert_type string, snapshot_time_utc timestamp_ntz, message string, location_name string")
    assert [r.sent_time_utc.hour for r in gating.outbox(dec, sent.select(*ALERT_LOG.fieldNames())).orderBy("sent_time_utc").collect()] == [11]
