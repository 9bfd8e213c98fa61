"""Sinks and data movement: exports, loads, daily incremental exports, compaction, partitioned writes.

Writers are Spark's: every task writes its own part files in parallel; output goes to a fresh or partition-scoped
location so that a retried or re-run job overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import compaction
from tidewater.sources.files import read_by_suffix, timestamps_to_text
from tidewater.sources.ledger import DAY, Ledger, Ranges, as_time
from tidewater.sources.partitions import delete, file_names, move, partition_values

SUFFIXES = {"json": ".json.gz", "csv": ".csv", "parquet": ".parquet"}


def output_path(parts: list[str | None], fmt: str) -> str:
    """Join the non-empty path parts with `/` (slashes at part ends stripped) and add the format's suffix."""
    if fmt not in SUFFIXES:
        raise ValueError(f"output format must be one of {sorted(SUFFIXES)}")
    keep = [p.strip("/") for p in parts if p and p.strip("/")]
    head = "/" if parts and parts[0] and parts[0].startswith("/") else ""
    return head + "/".join(keep) + SUFFIXES[fmt]


def export_table(df: DataFrame, path: str, fmt: str = "json", header: bool = True,
                 transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "overwrite") -> bool:
    """Write a query result as gzip JSON lines, CSV (plain, with optional header) or Parquet. An empty result writes
    nothing and returns False. ``transform`` is a DataFrame -> DataFrame function applied before writing (row-level
    Python logic goes through ``mapInPandas`` inside it). JSON export writes times as text."""
    if fmt not in SUFFIXES:
        raise ValueError(f"output format must be one of {sorted(SUFFIXES)}")
    out = transform(df) if transform else df
    if mode != "overwrite":
        if out.isEmpty():
            return False
        _write_as(out, path, fmt, header, mode)
        return True
    # written once, beside the target, and counted on the way; only a result with rows takes the target's place
    spark, seen = df.sparkSession, Observation()
    folder, slash, name = path.rstrip("/").rpartition("/")
    beside = f"{folder}{slash}_{name}-{uuid.uuid4().hex[:12]}"
    _write_as(out.observe(seen, F.count(F.lit(1)).alias("n")), beside, fmt, header, mode)
    if not seen.get["n"]:
        delete(spark, beside)
        return False
    delete(spark, path)
    move(spark, beside, path)
    return True


def _write_as(out: DataFrame, path: str, fmt: str, header: bool, mode: str) -> None:
    if fmt == "json":
        timestamps_to_text(out).write.mode(mode).option("compression", "gzip").json(path)
    elif fmt == "csv":
        out.write.mode(mode).option("header", header).csv(path)
    else:
        out.write.mode(mode).parquet(path)


def load_overwrite(spark: SparkSession, file_path: str, target: str, schema=None,
                   date_columns: list[str] | None = None, as_table: bool = False) -> DataFrame:
    """Load CSV / Parquet / JSON (chosen by suffix), cast the named columns to timestamps and replace the target
    (a table name with ``as_table`` or a path)."""
    df = read_by_suffix(spark, file_path, schema)
    for c in date_columns or []:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    w = df.write.mode("overwrite")
    if as_table:
        w.saveAsTable(target)
        return spark.table(target)
    w.parquet(target)
    return spark.read.parquet(target)


def export_daily_incremental(df: DataFrame, ts_col: str, start: str | datetime, end: str | datetime, out_path: str,
                             day_col: str = "day") -> Ranges:
    """Export ``[start, end)`` as one output partition per day, reading only what the output doesn't hold yet; returns
    what was asked for and missing. A last day that ``end`` cuts is left to the next run.

    Which stretches of time the output holds is kept in a ledger (``ledger.py``), not guessed from the folders. A day
    that is touched is written anew with all that it should hold: what is missing, and what it held before. The ledger
    notes the days before the first file changes and what they hold after the last, so a job that dies on the way
    leaves days that count as missing; the next run, whatever it asks for, mends what they had held. Files of unknown
    origin in a day that is touched go."""
    spark, c = df.sparkSession, F.col(ts_col)
    last = datetime.combine(as_time(end).date(), datetime.min.time())
    ledger = Ledger(spark, out_path)
    covered, owed = ledger.state()
    missing = Ranges([(as_time(start), last)]) - covered
    if not (missing or owed):
        return missing
    touched = (missing | owed).whole_days()
    held = (covered & touched) | missing | owed
    old = {d: set(file_names(spark, f"{out_path}/{day_col}={d}") or ()) for d in partition_values(spark, out_path, day_col)
           or [] if Ranges([(as_time(d), as_time(d) + DAY)]) & touched}
    run = ledger.intend(touched)
    # AQE cuts a heavy day into tasks of its advisory size and puts light days together
    df.where(held.holds(c)).withColumn(day_col, F.to_date(c)).hint("rebalance", day_col) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(out_path)
    for d, names in old.items():  # a day without rows keeps the files that were there
        if names and set(file_names(spark, f"{out_path}/{day_col}={d}") or ()) == names:
            delete(spark, f"{out_path}/{day_col}={d}")
    ledger.commit(run, held)
    return missing


def compact_files(spark: SparkSession, src: str, dst: str, num_files: int | None = None,
                  target_bytes: int = compaction.TARGET_BYTES) -> None:
    """Rewrite the Parquet files under ``src`` at ``dst``: by default as files of about ``target_bytes``, adding what is
    new since the last call (``compaction.compact``). With ``num_files`` all of them become that many files, each by
    one task, and ``dst`` is replaced."""
    if num_files is None:
        compaction.compact(spark, src, dst, target_bytes)
    else:
        spark.read.parquet(src).coalesce(num_files).write.mode("overwrite").parquet(dst)


#: Files that a task of a partitioned write has open at once.
OPEN_FILES = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      fmt: str = "parquet", dynamic: bool = True) -> None:
    """Hive-style ``col=value`` directories. Rows are clustered by the partition columns; AQE cuts a heavy partition
    into tasks of its advisory size and puts light ones together. With ``dynamic`` overwrite only the partitions present
    in ``df`` are replaced (re-running one day does not delete the others). A task keeps a file open for each of up to
    OPEN_FILES partitions and so needs not sort its rows, which take far more memory than the shuffled bytes that AQE
    cuts by; only what further partitions get is sorted."""
    conf = df.sparkSession.conf
    held = conf.get(_WRITERS, None)
    conf.set(_WRITERS, str(OPEN_FILES))
    try:
        df.hint("rebalance", *partition_cols).write.mode(mode) \
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static") \
            .partitionBy(*partition_cols).format(fmt).save(path)
    finally:
        conf.unset(_WRITERS) if held is None else conf.set(_WRITERS, held)
