"""Table sinks: append logs, rebuild derived tables, create when missing.

Storage is Parquet under a shared folder; logs are partitioned by date so an
append touches only new files and readers prune by date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that was staged for one job."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType,
                      partition_by: list[str] | None = None) -> None:
    if not exists(spark, path):
        w = spark.createDataFrame([], schema).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of its schema when it does not exist yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def rebuild_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Drop-and-create semantics; with ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def append_alert_log(outbox: DataFrame, path: str) -> None:
    append(outbox.withColumn("sent_date", F.to_date("sent_time_utc")), path, ["sent_date"])


def append_brief_log(outbox: DataFrame, path: str) -> None:
    rows = outbox.where(F.col("to_log")).select("sent_date_local", "sent_time_utc", "location_name", "message")
    append(rows, path, ["sent_date_local"])


def append_health(health: DataFrame, run_time_utc: F.Column, path: str) -> None:
    """Health rows of one run; pass those of its dates (``snapshot_health(dates=...)``)."""
    append(health.withColumn("run_time_utc", run_time_utc), path, ["today_local_date"])


def write_hourly(hourly: DataFrame, path: str) -> None:
    """Hourly layout: Parquet partitioned by snapshot date, rows sorted by
    (location, snapshot) inside each file.  Version picks join on
    (location, snapshot), so dynamic partition pruning skips other dates."""
    out = hourly.withColumn("snapshot_date", F.to_date("snapshot_time_utc"))
    (out.repartition("snapshot_date").sortWithinPartitions("location_name", "snapshot_time_utc")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_hourly(hourly: DataFrame, path: str) -> None:
    """Incremental landing: new snapshots are appended to their date partitions
    (``write_hourly`` rebuilds whole dates instead)."""
    out = hourly.withColumn("snapshot_date", F.to_date("snapshot_time_utc"))
    append(out.sortWithinPartitions("location_name", "snapshot_time_utc"), path, ["snapshot_date"])
