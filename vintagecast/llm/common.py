"""What the operators share: the shared folder, staged tables, running totals
over a total order and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side of at most this many narrow rows (ids and small numbers) may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Bytes that a side of wider rows may have to be broadcast.
BROADCAST_BYTES = 32 << 20
#: Rows of one batch of whole texts that goes to Python.
BATCH_ROWS = 1_000
#: Bytes of text one task should hold.
TASK_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of
    the session.  Only a local master may go without it (a temporary folder)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts
    the lineage, survives lost executors and is computed only once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def small_batches(texts: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``texts`` as they are; batches of whole texts on their way to Python hold at
    most ``rows`` rows from now on (a setting of the session)."""
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", texts.sparkSession
    now = int(spark.conf.get(key, "10000"))
    if not 0 < now <= rows:
        spark.conf.set(key, str(rows))
    return texts


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches that go to Python hold at most ``rows`` rows in jobs that run inside;
    the session's setting is restored afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parts_for(df: DataFrame, text: str, task_bytes: int = TASK_BYTES) -> int:
    """Number of tasks for the whole texts of ``df``, by their total bytes."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(partitions(df.sparkSession), -(-int(total) // task_bytes))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged, narrow) with a broadcast hint if it has at most ``rows``
    rows; else as it is, for a shuffled join that AQE may split."""
    return F.broadcast(df) if df.count() <= rows else df


def small_bytes(df: DataFrame, row_bytes: int) -> DataFrame:
    """``small`` for rows of about ``row_bytes`` bytes: at most BROADCAST_BYTES."""
    return small(df, max(1, BROADCAST_BYTES // row_bytes))


def running_total(df: DataFrame, order: list[Column], value: Column, out: str, name: str = "order") -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows before this one
    in the total order.  Rows are dealt by range; only one sum per range meets
    in one place."""
    n = partitions(df.sparkSession)
    dealt = staged(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    sums = dealt.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(F.broadcast(base), "_part")  # one row per range: at most the number of shuffle partitions
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_base")
    )
