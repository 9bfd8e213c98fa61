"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

#: White space of the contracts: space and the control characters \t \n \v \f \r.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that Spark hands to a worker at once, about; its own limit of 64 MB counts twice, in both processes.
BATCH_BYTES = "4m"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives the loss of executors, and lets
    several consumers read one evaluation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str | Column) -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` (a saved or otherwise cheap table) for broadcast when it has at most ``max_rows`` rows; beyond that
    leave the join to a shuffle. The count reads at most ``max_rows + 1`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands rows to workers in batches of about BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nobody holds any more, which it does only after the
    driver's garbage was collected; else they stay on the executors' disks while the next step writes its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
