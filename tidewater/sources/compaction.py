"""Rewriting many small files as few of a given size.

Spark's scan already packs files into tasks by size, the largest first, and cuts larger ones at row groups; with no cost
for opening a file, no minimum of tasks and the target as a task's bytes, every task reads one bin and writes one file.
Nothing is shuffled and the bins are as many as the sizes ask for.

A manifest beside the output names the source files that are in it, so a repeated run takes new files only. A run writes
to a staging folder, notes the names that its files will have, moves them, and then notes its sources: what a dead run
has moved is known by name and goes when the next one begins.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.sources.files import list_files
from tidewater.sources.partitions import delete, file_names, move, read_text, write_text

TARGET_BYTES = 256 << 20
FOLDER = "_compaction"


@contextmanager
def packed_by(spark: SparkSession, target_bytes: int):
    """While in it, scans that are planned read about ``target_bytes`` of files a task."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1"}
    held = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _log(spark: SparkSession, dst: str, kind: str) -> dict[str, dict]:
    names = file_names(spark, f"{dst}/{FOLDER}") or []
    return {n.split(".")[0]: json.loads(read_text(spark, f"{dst}/{FOLDER}/{n}")) for n in names if n.endswith(f".{kind}.json")}


def sweep(spark: SparkSession, dst: str) -> list[str]:
    """Remove what runs that didn't come to their end have left in ``dst``; returns the names of the files that went."""
    done, gone = _log(spark, dst, "done"), []
    for run, r in _log(spark, dst, "moving").items():
        if run not in done:
            here = set(file_names(spark, dst) or ())
            gone += [n for n in r["files"] if n in here]
            for n in r["files"]:
                delete(spark, f"{dst}/{n}")
            delete(spark, f"{dst}/{FOLDER}/{run}.moving.json")
    delete(spark, f"{dst}/{FOLDER}/staging")
    return gone


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Add the Parquet files under ``src`` that ``dst`` doesn't hold yet to ``dst``, as files of about ``target_bytes``
    (what a task reads; columns of partition folders become columns); returns the names of the new files. A source file
    is known by its path, size and time, so one that was written anew counts as new."""
    sweep(spark, dst)
    listed = list_files(spark, src, glob="*.parquet", recursive=True).withColumn(
        "mark", F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string")))
    known = f"{dst}/{FOLDER}/sources"
    runs = [f"{known}/run={r}" for r in _log(spark, dst, "done")]
    if runs:
        listed = listed.join(spark.read.schema("mark string").parquet(*runs), "mark", "left_anti")
    run = uuid.uuid4().hex
    listed.select("mark", "path").write.parquet(f"{known}/run={run}")
    fresh = spark.read.schema("mark string, path string").parquet(f"{known}/run={run}")
    paths = [r.path for r in fresh.select("path").collect()]  # names, which the scan lists on the driver anyway
    if not paths:
        delete(spark, f"{known}/run={run}")
        return []
    staging = f"{dst}/{FOLDER}/staging/{run}"
    with packed_by(spark, target_bytes):
        spark.read.option("basePath", src).parquet(*paths).write.parquet(staging)
    parts = sorted(n for n in file_names(spark, staging) if n.startswith("part-"))
    names = [f"compact-{run[:12]}-{i:05d}.parquet" for i in range(len(parts))]
    write_text(spark, f"{dst}/{FOLDER}/{run}.moving.json", json.dumps({"files": names}))
    for part, name in zip(parts, names):
        move(spark, f"{staging}/{part}", f"{dst}/{name}")
    write_text(spark, f"{dst}/{FOLDER}/{run}.done.json", json.dumps({"files": names}))
    delete(spark, f"{dst}/{FOLDER}/staging")
    return names
