"""Streaming = batch on the same files, over many micro-batches.

Input files are landed one per day with increasing modification times and
read one file per trigger, so state must carry across micro-batches.
"""

from __future__ import annotations

import json
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vintagecast.operators import alerts, brief, gating, normalize
from vintagecast.schemas import ALERT_LOG, BRIEF_LOG, RAW_SNAPSHOTS
from vintagecast.sources import fixtures as fx
from vintagecast.sources import tables
from vintagecast.streaming import streams


def _land_by_day(df, time_col, folder):
    """One parquet file per day, mtimes increasing with the day."""
    pdf = df.toPandas()
    schema = df.schema
    days = sorted(pdf[time_col].dt.normalize().unique())
    for i, d in enumerate(days):
        part = pdf[pdf[time_col].dt.normalize() == d]
        path = os.path.join(folder, f"d{i:03d}.parquet")
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False), path, coerce_timestamps="us",
                       allow_truncated_timestamps=True)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return schema, len(days)


def _tmp(name):
    return tempfile.mkdtemp(prefix=f"vc-{name}-")


def test_stream_change_equals_batch(spark):
    reg = fx.registry(spark, SF_SMALL)
    src_dir, base = _tmp("chg-in"), _tmp("chg")
    schema, n_files = _land_by_day(reg, "snapshot_time_utc", src_dir)
    assert n_files > 5
    src = streams.table_stream(spark, src_dir, schema, max_files=1)
    out = os.path.join(base, "out")
    q = streams.run_to_parquet(streams.stream_change(src), out, os.path.join(base, "ckpt"))
    assert len(q.recentProgress) >= n_files or q.lastProgress is not None
    got = spark.read.parquet(out)
    exp = normalize.content_changed(reg)
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_stream_cooldown_equals_batch(spark):
    dec = fx.decisions(spark, SF_SMALL)
    src_dir, base = _tmp("cool-in"), _tmp("cool")
    schema, _ = _land_by_day(dec, "decision_time_utc", src_dir)
    src = streams.table_stream(spark, src_dir, schema, max_files=1)
    out = os.path.join(base, "out")
    streams.run_to_parquet(streams.stream_cooldown(src), out, os.path.join(base, "ckpt"))
    got = spark.read.parquet(out)
    exp = gating.cooldown_replay(dec)
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_stream_dedup_keeps_one_per_file(spark):
    reg = fx.registry_with_copies(spark, SF_SMALL)
    src_dir, base = _tmp("dd-in"), _tmp("dd")
    schema, _ = _land_by_day(reg, "snapshot_time_utc", src_dir)
    src = streams.table_stream(spark, src_dir, schema, max_files=2)
    out = os.path.join(base, "out")
    streams.stream_dedup(src, out, os.path.join(base, "ckpt"))
    got = spark.read.parquet(out)
    assert got.count() == got.select("raw_file").distinct().count() == fx.registry(spark, SF_SMALL).count()


def test_stream_ingest_restart_adds_nothing(spark):
    h = fx.hourly(spark, SF_SMALL)
    folder = _tmp("env")
    for i, r in enumerate(fx.envelope_text(h).orderBy("raw_file").collect()[:12]):
        with open(os.path.join(folder, r.raw_file), "w") as fh:
            fh.write(json.dumps(json.loads(r.value), indent=2))
    base = _tmp("ing")
    raw_p, reg_p, ck = os.path.join(base, "raw"), os.path.join(base, "reg"), os.path.join(base, "ckpt")
    streams.stream_ingest(spark, folder, raw_p, reg_p, ck, max_files=5)
    streams.stream_ingest(spark, folder, raw_p, reg_p, ck, max_files=5)      # restart: nothing new
    assert spark.read.parquet(raw_p).count() == 12
    assert spark.read.parquet(reg_p).count() == 12
    # a fresh checkpoint replays every file: the anti-joins keep the tables whole
    streams.stream_ingest(spark, folder, raw_p, reg_p, os.path.join(base, "ckpt2"))
    assert spark.read.parquet(raw_p).count() == 12
    assert spark.read.parquet(reg_p).select("raw_file").distinct().count() == 12


def _hourly_landed(spark):
    h = fx.hourly(spark, SF_SMALL)
    hourly_dir, src_dir = _tmp("hourly"), _tmp("hourly-in")
    h.write.mode("overwrite").parquet(hourly_dir)
    schema, _ = _land_by_day(h, "snapshot_time_utc", src_dir)
    return h, hourly_dir, streams.table_stream(spark, src_dir, schema, max_files=1)


def test_stream_alert_equals_batch(spark):
    h, hourly_dir, src = _hourly_landed(spark)
    base = _tmp("alert")
    log_p = os.path.join(base, "log")
    streams.stream_alert(src, hourly_dir, log_p, os.path.join(base, "ckpt"), run_offset_hours=6)
    got = tables.read_table(spark, log_p, ALERT_LOG)
    dec = alerts.decisions(h, fx.runs(h))
    # runs are a day apart per location, so the 2h cooldown never holds one back
    exp_n = dec.where("should_alert_rain_next6h").count() + dec.where("should_alert_wind_next6h").count()
    assert got.count() == exp_n


def test_stream_brief_once_per_day(spark):
    h, hourly_dir, src = _hourly_landed(spark)
    base = _tmp("brief")
    log_p = os.path.join(base, "log")
    streams.stream_brief_once(src, hourly_dir, log_p, os.path.join(base, "ckpt"), run_offset_hours=9)
    got = tables.read_table(spark, log_p, BRIEF_LOG)
    runs = fx.runs(h, (9,))
    exp = brief.brief_outbox(brief.brief_final(h, runs), runs, spark.createDataFrame([], BRIEF_LOG))
    assert got.count() == exp.count()
    assert got.groupBy("location_name", "sent_date_local").count().where(F.col("count") > 1).count() == 0


def test_stream_dedup_takes_late_files(spark):
    src_dir, base = _tmp("late-in"), _tmp("late")
    rows = [("a", f"2024-01-{d:02d} 00:00:00", f"f{d}") for d in (5, 6, 2)]
    frame = spark.createDataFrame(rows, "location_name string, t string, raw_file string").selectExpr(
        "location_name", "cast(t as timestamp_ntz) AS snapshot_time_utc", "raw_file")
    schema = frame.schema
    for i, f in enumerate(("f5", "f6", "f2")):
        pdf = frame.where(F.col("raw_file") == f).toPandas()
        path = os.path.join(src_dir, f"{i}.parquet")
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    out = os.path.join(base, "out")
    streams.stream_dedup(streams.table_stream(spark, src_dir, schema, max_files=1), out, os.path.join(base, "ckpt"))
    assert sorted(r.raw_file for r in spark.read.parquet(out).collect()) == ["f2", "f5", "f6"]


def test_stream_cooldown_survives_late_decisions(spark):
    src_dir, base = _tmp("coollate-in"), _tmp("coollate")
    batches = [[("A", "2024-01-01 10:00:00", 1), ("B", "2024-01-01 20:00:00", 2)],
               [("A", "2024-01-01 19:00:00", 3), ("A", "2024-01-01 15:00:00", 4)],
               [("A", "2024-01-01 20:30:00", 5), ("A", "2024-01-01 21:00:00", 6)]]
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame([(k, "rain", t, n) for k, t, n in rows], "location_name string, alert_type string, t string, decision_id long")
        frame = frame.selectExpr("location_name", "alert_type", "cast(t as timestamp_ntz) AS decision_time_utc", "decision_id")
        path = os.path.join(src_dir, f"{i}.parquet")
        pq.write_table(pa.Table.from_pandas(frame.toPandas(), preserve_index=False), path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    src = streams.table_stream(spark, src_dir, frame.schema, max_files=1)
    out = os.path.join(base, "out")
    streams.run_to_parquet(streams.stream_cooldown(src), out, os.path.join(base, "ckpt"))
    got = {r.decision_id: r.should_send_after_gating for r in spark.read.parquet(out).collect()}
    assert {k: got[k] for k in (1, 2, 3, 5, 6)} == {1: True, 2: True, 3: True, 5: False, 6: True}
    assert got.get(4, False) in (False, True)


def test_stream_cooldown_calls_python_by_bucket(spark):
    """Few calls hold many keys; decisions without a time or a key never crash; state goes behind the watermark."""
    src_dir, base = _tmp("coolbucket-in"), _tmp("coolbucket")
    schema = "location_name string, alert_type string, t string, decision_id long"
    rows = [(f"L{k}", "rain", f"2024-01-{1 + d:02d} {h:02d}:00:00", 1000 * d + 10 * k + h)
            for d in range(3) for k in range(40) for h in (1, 2, 3, 5)]
    rows += [(None, "rain", "2024-01-01 01:30:00", -1), (None, "rain", None, -2), ("only", "rain", None, -3)]
    for i in range(3):
        part = [r for r in rows if (r[3] // 1000 if r[3] >= 0 else 0) == i]
        frame = spark.createDataFrame(part, schema).selectExpr(
            "location_name", "alert_type", "cast(t as timestamp_ntz) AS decision_time_utc", "decision_id")
        path = os.path.join(src_dir, f"{i}.parquet")
        pq.write_table(pa.Table.from_pandas(frame.toPandas(), schema=pa.schema([
            ("location_name", pa.string()), ("alert_type", pa.string()), ("decision_time_utc", pa.timestamp("us")),
            ("decision_id", pa.int64())]), preserve_index=False), path)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    out = os.path.join(base, "out")
    src = streams.table_stream(spark, src_dir, frame.schema, max_files=1)
    q = streams.run_to_parquet(streams.stream_cooldown(src, buckets=8), out, os.path.join(base, "ckpt"))
    got = {r.decision_id: r.should_send_after_gating for r in spark.read.parquet(out).collect()}
    want = {i: int(t[11:13]) in (1, 3, 5) for loc, _, t, i in rows if i >= 0}
    assert {k: v for k, v in got.items() if k >= 0} == want and got[-1] is True
    assert not any(got.get(i, False) for i in (-2, -3))
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators) <= 8


def _land_files(spark, rows, schema, folder, first=0):
    """A file for each list of rows, in the order given."""
    for i, part in enumerate(rows, first):
        frame = spark.createDataFrame(part, schema).withColumn("snapshot_time_utc", F.col("snapshot_time_utc").cast("timestamp_ntz"))
        path = os.path.join(folder, f"{i}.parquet")
        pq.write_table(pa.Table.from_pandas(frame.toPandas(), preserve_index=False), path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return frame.schema


REG = "location_name string, snapshot_time_utc string, raw_file string, content_hash string"


def _reg(loc, hour, h):
    return loc, f"2024-01-{1 + hour // 24:02d} {hour % 24:02d}:00:00", f"{loc}{hour}", h


def test_stream_change_by_snapshot_mends_successors(spark):
    src_dir, base = _tmp("chgsnap-in"), _tmp("chgsnap")
    files = [[_reg("p", 1, "a"), _reg("q", 5, "x")], [_reg("p", 3, "a"), _reg("q", 50, "x")],
             [_reg("p", 2, "b"), _reg("q", 30, "x")],       # 3 o'clock turns TRUE
             [_reg("p", 2, "b"), _reg("q", 29, "y")]]       # a file again; 30 turns TRUE
    schema = _land_files(spark, files, REG, src_dir)
    out, ck = os.path.join(base, "out"), os.path.join(base, "ckpt")

    def run(checkpoint):
        streams.stream_change_by_snapshot(streams.table_stream(spark, src_dir, schema, max_files=1), out, checkpoint)
        return {r.raw_file: r.content_changed for r in streams.newest_updates(spark, out, ["raw_file"]).collect()}

    want = {"p1": True, "p2": True, "p3": True, "q5": True, "q29": True, "q30": True, "q50": False}
    assert run(ck) == want
    assert run(ck) == want                                  # nothing new
    assert run(os.path.join(base, "replayed")) == want      # every batch again, into the same folders


def test_stream_change_by_snapshot_any_order(spark):
    import random
    rng = random.Random(5)
    rows = [_reg(rng.choice("pqr"), h, rng.choice("abc")) for h in range(60)]
    exp = {r.raw_file: r.content_changed for r in normalize.content_changed(spark.createDataFrame(rows, REG).withColumn(
        "snapshot_time_utc", F.col("snapshot_time_utc").cast("timestamp_ntz"))).collect()}
    rng.shuffle(rows)
    src_dir, base = _tmp("chgany-in"), _tmp("chgany")
    schema = _land_files(spark, [rows[i:i + 12] for i in range(0, 60, 12)], REG, src_dir)
    out = os.path.join(base, "out")
    streams.stream_change_by_snapshot(streams.table_stream(spark, src_dir, schema, max_files=1), out, os.path.join(base, "ckpt"))
    assert {r.raw_file: r.content_changed for r in streams.newest_updates(spark, out, ["raw_file"]).collect()} == exp


def test_stream_forecasts_reads_only_the_seen_dates_and_survives_replay(spark):
    raw = fx.raw_snapshots(fx.feed(spark, SF_SMALL)).where(F.col("location_name").isin("u1", "u2", "u3", "u7"))
    raw = raw.select(*RAW_SNAPSHOTS.fieldNames())
    src_dir, base = _tmp("chain-in"), _tmp("chain")
    raw.where("snapshot_time_utc < '2024-04-01'").coalesce(1).write.mode("append").parquet(src_dir)
    raw.where("snapshot_time_utc >= '2024-04-01'").coalesce(1).write.mode("append").parquet(src_dir)
    names = ("raw", "registry", "hourly", "alert_log", "brief_log")

    def run(checkpoint):
        src = streams.table_stream(spark, src_dir, RAW_SNAPSHOTS, max_files=1)
        q = streams.stream_forecasts(src, base, os.path.join(base, checkpoint))
        assert len([p for p in q.recentProgress if p.numInputRows]) in (0, 2)
        return {n: sorted(map(str, spark.read.parquet(f"{base}/{n}").drop("inserted_at_utc").collect())) for n in names}

    first = run("ckpt")
    assert len(first["raw"]) == len(first["registry"]) == raw.count() and len(first["hourly"]) == 24 * raw.count()
    assert first["alert_log"] and first["brief_log"]
    assert run("ckpt") == first
    assert run("replayed") == first     # the same files under a new checkpoint
    # a run early in the span opens none of the later dates' files
    runs = raw.where("snapshot_time_utc < '2024-03-30'").select("location_name", "timezone", F.col("snapshot_time_utc").alias("as_of_utc"))
    hourly, _ = streams._visible(spark, runs, f"{base}/hourly", f"{base}/registry")
    read = {r[0] for r in hourly.select(F.input_file_name()).distinct().collect()}
    assert read and all("snapshot_date=2024-03-28" in f or "snapshot_date=2024-03-29" in f for f in read)
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "PartitionFilters: [snapshot_date" in plan


def test_stream_forecasts_completes_a_broken_batch(spark):
    raw = fx.raw_snapshots(fx.feed(spark, SF_SMALL)).where(F.col("location_name") == "u1").select(*RAW_SNAPSHOTS.fieldNames())
    whole, broken = _tmp("whole"), _tmp("broken")
    raw = raw.cache()
    streams.land(raw, whole)
    # stopped after the raw table, half of the registry written
    tables.append(raw, f"{broken}/raw")
    tables.append(spark.read.parquet(f"{whole}/registry").where(F.pmod(F.xxhash64("raw_file"), F.lit(2)) == 0), f"{broken}/registry")
    streams.land(raw, broken)
    streams.land(raw, broken)
    for n in ("raw", "registry", "hourly"):
        a, b = (spark.read.parquet(f"{d}/{n}").drop("inserted_at_utc") for d in (whole, broken))
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_stream_hour_counts_drops_state_and_survives_replay(spark):
    reg = fx.registry_with_copies(spark, SF_SMALL)
    src_dir, base = _tmp("hours-in"), _tmp("hours")
    schema, n_files = _land_by_day(reg, "snapshot_time_utc", src_dir)
    out, keys = os.path.join(base, "out"), ["location_name", "hour_start_utc"]

    def run(checkpoint):
        src = streams.table_stream(spark, src_dir, schema, max_files=4)
        q = streams.run_updates_to_parquet(streams.stream_hour_counts(src), out, os.path.join(base, checkpoint))
        return q, sorted(map(tuple, streams.newest_updates(spark, out, keys).select(
            *keys, "n_snapshots", "content_hash").collect()))

    exp = sorted(map(tuple, reg.groupBy("location_name", F.date_trunc("hour", "snapshot_time_utc").cast(
        "timestamp_ntz").alias("h")).agg(F.count(F.lit(1)), F.min("content_hash")).collect()))
    q, got = run("ckpt")
    assert got == exp
    assert n_files > 8 and q.lastProgress.stateOperators[0].numRowsTotal < len(exp) / 4
    assert run("ckpt")[1] == exp        # nothing new
    assert run("replayed")[1] == exp    # every batch again, into the same folders


def test_stream_hour_counts_late_rows(spark):
    src_dir, base = _tmp("hourslate-in"), _tmp("hourslate")
    batches = [["01 10:00:00", "01 11:30:00"], ["01 10:20:00", "01 18:00:00"], ["01 10:40:00", "01 17:10:00"],
               ["01 10:50:00", "01 18:10:00"]]
    for i, times in enumerate(batches):
        frame = spark.createDataFrame([("a", f"2024-01-{t}", f"h{i}") for t in times], "location_name string, t string, content_hash string")
        frame = frame.selectExpr("location_name", "cast(t as timestamp_ntz) AS snapshot_time_utc", "content_hash")
        path = os.path.join(src_dir, f"{i}.parquet")
        pq.write_table(pa.Table.from_pandas(frame.toPandas(), preserve_index=False), path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    src = streams.table_stream(spark, src_dir, frame.schema, max_files=1)
    out = os.path.join(base, "out")
    streams.run_updates_to_parquet(streams.stream_hour_counts(src), out, os.path.join(base, "ckpt"))
    got = {r.hour_start_utc.hour: r.n_snapshots for r in streams.newest_updates(
        spark, out, ["location_name", "hour_start_utc"]).collect()}
    # the second batch takes the watermark to 16:00; the third still counts 10:40 and closes the hour
    assert got == {10: 3, 11: 1, 17: 1, 18: 2}
