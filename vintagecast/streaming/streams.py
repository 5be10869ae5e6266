"""Structured Streaming versions of the scheduled steps.

The source pipeline is an hourly micro-batch by scheduler whose state lives
in tables.  Here the file source (with its checkpoint) replaces "load the
newest file", keyed state replaces "look up the last row in the registry /
alert log", and ``foreachBatch`` runs the batch operators for steps that
read tables.  Every query is restartable from its checkpoint folder, which
must be on shared storage (the cluster's ``spark.checkpoint.dir`` by
default).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vintagecast.config import RULES, Rules
from vintagecast.operators import alerts, brief, gating, normalize
from vintagecast.operators.versions import PART, visible_versions
from vintagecast.schemas import ALERT_LOG, BRIEF_LOG, RAW_SNAPSHOTS, SNAPSHOT_REGISTRY, SNAPSHOTS_HOURLY
from vintagecast.session import cut_lineage
from vintagecast.sources import envelopes, tables

KEY = "location_name"
SNAP = "snapshot_time_utc"


def event_time(c: str) -> F.Column:
    """Watermarks need a zoned TIMESTAMP; the tables keep UTC wall clocks as
    TIMESTAMP_NTZ.  With the session zone UTC (``session.configure``) the cast
    is the same instant."""
    return F.col(c).cast("timestamp")


# ------------------------------------------------------------------ sources
def envelope_stream(spark: SparkSession, folder: str, glob: str = "*.json",
                    max_files: int | None = None) -> DataFrame:
    """Landed envelope files as a stream of raw rows (one row per new file)."""
    r = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
         .option("recursiveFileLookup", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    text = r.load(folder).select("value", F.col("_metadata.file_path").alias("raw_file")).coalesce(envelopes.read_tasks(spark))
    return envelopes.envelope_project(text, spark.conf.get("spark.sql.session.timeZone"))


def table_stream(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def run_available(writer, checkpoint: str):
    """Process everything available now, then stop (batch-like, restartable)."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_to_parquet(df: DataFrame, out: str, checkpoint: str):
    """Append-mode stream into a Parquet folder (exactly once via the sink log)."""
    return run_available(df.writeStream.format("parquet").option("path", out), checkpoint)


def run_updates_to_parquet(df: DataFrame, out: str, checkpoint: str):
    """Update-mode aggregate: micro-batch n writes the rows it changed to
    ``batch=n`` of the folder, so a replayed batch rewrites its own rows and no
    batch rewrites another's.  State behind the watermark is dropped.
    ``newest_updates`` reads the result."""
    def batch(b: DataFrame, batch_id: int) -> None:
        b.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return run_available(df.writeStream.outputMode("update").foreachBatch(batch), checkpoint)


def newest_updates(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Of every key the row of its newest micro-batch (partial aggregation, no sort)."""
    t = spark.read.parquet(out)
    rest = [c for c in t.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_r")
    return t.groupBy(*keys).agg(newest).select(*keys, "_r.*")


# ------------------------------------------------------------------ stream_ingest
def stream_ingest(spark: SparkSession, folder: str, raw_path: str, registry_path: str, checkpoint: str,
                  max_files: int | None = None, glob: str = "*.json"):
    """New envelope files -> ``raw_snapshots`` and ``snapshot_registry``.

    Each micro-batch is anti-joined against each table on its own, so a
    batch replayed after a failure between the two appends fills only what
    is missing (no duplicates, no gaps)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        raw_now = tables.read_table(spark, raw_path, RAW_SNAPSHOTS)
        reg_now = tables.read_table(spark, registry_path, SNAPSHOT_REGISTRY)
        tables.append(envelopes.missing_from(df, raw_now).select(*RAW_SNAPSHOTS.fieldNames()), raw_path)
        tables.append(envelopes.registry_rows(envelopes.missing_from(df, reg_now)), registry_path)
        df.unpersist()

    with envelopes.listed_by_tasks(spark):
        w = envelope_stream(spark, folder, glob=glob, max_files=max_files).writeStream.foreachBatch(batch)
        return run_available(w, checkpoint)


# ------------------------------------------------------------------ stream_dedup
def stream_dedup(rows: DataFrame, out: str, checkpoint: str):
    """One row per ``raw_file`` in the table at ``out``, however late a file comes.

    Of a micro-batch's copies the earliest snapshot time stays; files that the
    table has are left out.  A replayed batch adds nothing."""
    spark = rows.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        tables.append(envelopes.missing_from(df, tables.read_table(spark, out, rows.schema)), out)

    return run_available(rows.writeStream.foreachBatch(batch), checkpoint)


# ------------------------------------------------------------------ stream_hour_counts
def stream_hour_counts(registry_rows: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Snapshots and min hash per (location, hour): tumbling 1-hour windows;
    late rows count until the micro-batch after the one whose rows take the
    watermark past the end of their hour; that micro-batch also drops the hour's
    state (``run_updates_to_parquet``)."""
    g = (registry_rows.withColumn("_event", event_time(SNAP)).withWatermark("_event", delay)
         .groupBy(KEY, F.window("_event", "1 hour").alias("w"))
         .agg(F.count(F.lit(1)).alias("n_snapshots"), F.min("content_hash").alias("content_hash")))
    return g.select(KEY, F.col("w.start").cast("timestamp_ntz").alias("hour_start_utc"), "n_snapshots",
                    "content_hash")


# ------------------------------------------------------------------ stream_change
CHANGE_OUT = ("location_name string, snapshot_time_utc timestamp_ntz, raw_file string, content_hash string, "
              "content_changed boolean")
CHANGE_STATE = "last_time timestamp_ntz, last_hash string"


def _change(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per location: compare each new snapshot's hash with the newest one
    registered before it (arrival order inside the batch = time order)."""
    pdf = pd.concat(list(batches), ignore_index=True).sort_values([SNAP, "raw_file"], kind="mergesort")
    last_t, last_h = state.get if state.exists else (None, None)
    changed = []
    for t, h in zip(pdf[SNAP], pdf["content_hash"]):
        changed.append(True if last_h is None else bool(h != last_h))
        if last_t is None or t >= last_t:
            last_t, last_h = t, h
    state.update((last_t, last_h))
    pdf = pdf.assign(content_changed=changed)
    yield pdf[[KEY, SNAP, "raw_file", "content_hash", "content_changed"]]


def stream_change(registry_rows: DataFrame) -> DataFrame:
    cols = registry_rows.select(KEY, SNAP, "raw_file", "content_hash")
    return cols.groupBy(KEY).applyInPandasWithState(
        _change, CHANGE_OUT, CHANGE_STATE, "append", GroupStateTimeout.NoTimeout)


def stream_change_by_snapshot(registry_rows: DataFrame, out: str, checkpoint: str):
    """The change flag by snapshot time, whatever the order of arrival.

    ``stream_change`` compares a snapshot with the newest one that had arrived.
    Here a late one is put between its neighbours: micro-batch n writes its own
    rows, and those whose flag it turned, to ``batch=n``;
    ``newest_updates(spark, out, ["raw_file"])`` reads the result, which equals
    ``normalize.content_changed`` of all rows so far.  A replayed batch rewrites
    its own folder from the batches before it."""
    spark = registry_rows.sparkSession
    names = [KEY, SNAP, "raw_file", "content_hash"]

    def batch(df: DataFrame, batch_id: int) -> None:
        new = normalize.dedup_raw(df.select(*names))
        if batch_id == 0:
            rows = normalize.content_changed(new)
        else:
            known = spark.read.parquet(out).where(F.col("batch") < batch_id)
            known = known.join(new.select(KEY).distinct(), KEY, "left_semi")
            newest = F.max_by(F.struct(KEY, SNAP, "content_hash", "content_changed"), "batch").alias("_r")
            known = known.groupBy("raw_file").agg(newest).select("raw_file", "_r.*")
            new = new.join(known.select("raw_file"), "raw_file", "left_anti").select(*names)
            flagged = normalize.content_changed(known.select(*names).unionByName(new))
            was = known.select("raw_file", F.col("content_changed").alias("_was"))
            rows = flagged.join(was, "raw_file", "left").where(
                ~F.col("_was").eqNullSafe(F.col("content_changed"))).drop("_was")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return run_available(registry_rows.writeStream.foreachBatch(batch), checkpoint)


# ------------------------------------------------------------------ stream_cooldown
COOL_OUT = ("location_name string, alert_type string, decision_time_utc timestamp_ntz, decision_id bigint, "
            "should_send_after_gating boolean")
COOL_STATE = "location_name array<string>, alert_type array<string>, last_sent array<bigint>"
#: Keys are dealt to so many states.  The state of a running query hangs on it: a new number needs a new checkpoint.
COOL_BUCKETS = 4096


def _cooldown(hours: int):
    gap = hours * 3_600_000_000

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last: dict = {}      # (location, type) -> microseconds of its last send
        if state.exists:
            locations, types, times = state.get
            last = dict(zip(zip(locations, types), map(int, times)))
        if not state.hasTimedOut:
            pdf = pd.concat(list(batches), ignore_index=True).sort_values(
                ["decision_time_utc", "decision_id"], kind="mergesort")
            times = pdf["decision_time_utc"]
            send = []
            for k, t, timed in zip(zip(pdf[KEY], pdf["alert_type"]), times.astype("datetime64[us]").astype("int64").tolist(),
                                   times.notna().tolist()):
                ok = timed and (k not in last or t >= last[k] + gap)
                send.append(ok)
                if ok:
                    last[k] = t
        # a send that is free behind the watermark blocks nothing any more
        now = state.getCurrentWatermarkMs()
        last = {k: t for k, t in last.items() if (t + gap) // 1000 > now}
        if last:
            state.update(([k[0] for k in last], [k[1] for k in last], list(last.values())))
            state.setTimeoutTimestamp((min(last.values()) + gap) // 1000)
        elif state.exists:
            state.remove()
        if not state.hasTimedOut:
            yield pdf.assign(should_send_after_gating=send)[
                [KEY, "alert_type", "decision_time_utc", "decision_id", "should_send_after_gating"]]
    return fn


def stream_cooldown(decisions: DataFrame, rules: Rules = RULES, delay: str = "2 hours",
                    buckets: int = COOL_BUCKETS) -> DataFrame:
    """Self-fed cooldown with keyed state (last send per location and type).
    A send leaves the state 2h after it, so the state stays bounded by active keys.
    Decisions without a time never send.

    A call into Python costs milliseconds, a decision less than a microsecond or
    two: a state holds a bucket of keys, not one.

    Late decisions: up to ``delay`` behind the newest, a decision is judged
    against the last send of its key (none is sent at a time before that send);
    further behind, Spark may leave it out."""
    d = decisions.select(KEY, "alert_type", "decision_time_utc", "decision_id",
                         event_time("decision_time_utc").alias("_event")).withWatermark("_event", delay)
    d = d.withColumn("_bucket", F.pmod(F.xxhash64(KEY, "alert_type"), F.lit(buckets)))
    return d.groupBy("_bucket").applyInPandasWithState(
        _cooldown(rules.cooldown_hours), COOL_OUT, COOL_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------------------------ stream_alert / stream_brief_once
def _runs(df: DataFrame, offset_hours: int) -> DataFrame:
    """A run per new snapshot, ``offset_hours`` after it."""
    at = F.col(SNAP) + F.make_dt_interval(F.lit(0), F.lit(offset_hours))
    return df.select(KEY, "timezone", at.alias("as_of_utc")).distinct()


def _dates(times: DataFrame) -> list:
    """The distinct dates of a frame's snapshots: as many as the days they span."""
    return [r[0] for r in times.select(F.to_date(SNAP)).distinct().collect()]


def _visible(spark: SparkSession, runs: DataFrame, hourly_path: str, registry_path: str | None
             ) -> tuple[DataFrame, DataFrame]:
    """(hourly, version list) for the runs of a micro-batch: the versions of its
    locations come from the registry, and of a table stored by snapshot date
    only the dates of the versions that the runs see are read."""
    hourly = tables.read_hourly(spark, hourly_path)
    listed = hourly if registry_path is None else tables.read_table(spark, registry_path, SNAPSHOT_REGISTRY)
    snaps = cut_lineage(listed.select(KEY, SNAP).join(runs.select(KEY).distinct(), KEY, "left_semi").distinct())
    if PART in hourly.columns:
        hourly = hourly.where(F.col(PART).isin(_dates(visible_versions(snaps, runs))))
    return hourly, snaps


def send_alerts(runs: DataFrame, hourly_path: str, log_path: str, rules: Rules = RULES,
                registry_path: str | None = None, seen: tuple[DataFrame, DataFrame] | None = None) -> None:
    """Decide the runs, gate them against the alert log and append what is sent.
    Runs that were sent before find themselves in the log: a replay adds nothing."""
    spark = runs.sparkSession
    hourly, snaps = seen or _visible(spark, runs, hourly_path, registry_path)
    dec = alerts.decisions(hourly, runs, rules, snaps=snaps)
    out = gating.outbox(dec, tables.read_table(spark, log_path, ALERT_LOG), rules)
    tables.append_alert_log(out.select(*ALERT_LOG.fieldNames()), log_path)


def send_briefs(runs: DataFrame, hourly_path: str, log_path: str, rules: Rules = RULES,
                registry_path: str | None = None, seen: tuple[DataFrame, DataFrame] | None = None) -> None:
    """The runs' digests, at most one per (location, local date) of the log."""
    spark = runs.sparkSession
    hourly, snaps = seen or _visible(spark, runs, hourly_path, registry_path)
    final = brief.brief_final(hourly, runs, rules, snaps=snaps)
    out = brief.brief_outbox(final, runs, tables.read_table(spark, log_path, BRIEF_LOG), rules)
    tables.append_brief_log(out, log_path)


def stream_alert(hourly_stream: DataFrame, hourly_path: str, log_path: str, checkpoint: str,
                 rules: Rules = RULES, run_offset_hours: int = 0, registry_path: str | None = None):
    """For each micro-batch of new snapshots: run the decision at
    ``snapshot + offset`` against the hourly table, gate against the
    alert log and append the sends to it (the log is the state)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        send_alerts(_runs(df, run_offset_hours), hourly_path, log_path, rules, registry_path)

    return run_available(hourly_stream.writeStream.foreachBatch(batch), checkpoint)


def stream_brief_once(hourly_stream: DataFrame, hourly_path: str, log_path: str, checkpoint: str,
                      rules: Rules = RULES, run_offset_hours: int = 0, registry_path: str | None = None):
    """Digest per new snapshot's run, at most once per (location, local date)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        send_briefs(_runs(df, run_offset_hours), hourly_path, log_path, rules, registry_path)

    return run_available(hourly_stream.writeStream.foreachBatch(batch), checkpoint)


# ------------------------------------------------------------------ stream_forecasts
def _lacking(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys the table lacks.  The keys alone are compared first: only
    if the table has some of them, not none or all, are whole rows shuffled."""
    have = table.select(*keys).distinct()
    if rows.select(*keys).join(have, keys, "left_semi").isEmpty():
        return rows
    return rows.join(have, keys, "left_anti").select(*rows.columns)


def land(rows: DataFrame, folder: str) -> None:
    """Raw rows -> the tables ``raw``, ``registry`` and ``hourly`` below ``folder``,
    each asked on its own for what it lacks.  Of the hourly table only the
    rows' snapshot dates are read.  Rows of a file that comes more than once are
    shuffled to find the earliest; payloads aren't otherwise."""
    spark = rows.sparkSession
    raw_path, registry_path, hourly_path = (f"{folder}/{t}" for t in ("raw", "registry", "hourly"))
    if not rows.groupBy("raw_file").count().where("count > 1").isEmpty():
        rows = normalize.dedup_raw(rows)
    missing = _lacking(rows, tables.read_table(spark, raw_path, RAW_SNAPSHOTS), ["raw_file"])
    tables.append(missing.select(*RAW_SNAPSHOTS.fieldNames()), raw_path)
    missing = _lacking(rows, tables.read_table(spark, registry_path, SNAPSHOT_REGISTRY), ["raw_file"])
    tables.append(envelopes.registry_rows(missing), registry_path)
    stored = tables.read_table(spark, hourly_path, SNAPSHOTS_HOURLY)
    if PART in stored.columns:
        stored = stored.where(F.col(PART).isin(_dates(rows)))
    fresh = _lacking(rows, stored, [KEY, SNAP])
    tables.append_hourly(normalize.normalize_hourly(fresh), hourly_path)


def stream_forecasts(raw_rows: DataFrame, folder: str, checkpoint: str, rules: Rules = RULES,
                     run_offset_hours: int = 0):
    """The whole hourly job on a stream of raw rows (``envelope_stream``): land
    them, normalise, decide and gate alerts, write digests.  Tables: ``raw``,
    ``registry``, ``hourly``, ``alert_log``, ``brief_log`` below ``folder``.

    A micro-batch that is replayed after a stop at any point completes what is
    missing.  A snapshot that arrives late is judged as of its own time, by the
    versions that have arrived."""
    spark, held = raw_rows.sparkSession, f"{folder}/batch"

    def batch(df: DataFrame, batch_id: int) -> None:
        # read several times: as Parquet it packs, and takes no executor's memory
        df.write.mode("overwrite").parquet(held)
        df = spark.read.schema(df.schema).parquet(held)
        land(df, folder)
        runs = cut_lineage(_runs(df, run_offset_hours))
        tables.drop(spark, held)
        seen = _visible(spark, runs, f"{folder}/hourly", f"{folder}/registry")
        send_alerts(runs, f"{folder}/hourly", f"{folder}/alert_log", rules, f"{folder}/registry", seen)
        send_briefs(runs, f"{folder}/hourly", f"{folder}/brief_log", rules, f"{folder}/registry", seen)

    return run_available(raw_rows.writeStream.foreachBatch(batch), checkpoint)
