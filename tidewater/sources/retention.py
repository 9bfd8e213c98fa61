"""Deletion on request, in two phases.

``plan`` decides nothing itself: it takes the files to delete and those that must stay, and writes both down as a
tombstone manifest with sizes and times; no file is touched. ``execute`` checks the manifest against what is there (every
file that must stay is there as it was, and at least one is), then deletes in tasks. A file that was written anew since
the plan, or that is gone already, is passed over and reported. The manifest is closed at the end; a run that dies on
the way leaves it open, and a second run comes to the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.files import list_files
from tidewater.sources.partitions import partition_values, read_text, write_text

FOLDER = "_retention"
MANIFEST = "path string, length long, modificationTime timestamp, stays boolean"


class NotIntact(RuntimeError):
    """What should stay isn't what the plan saw."""


def plan(spark: SparkSession, root: str, delete: DataFrame, glob: str = "*.parquet") -> str:
    """Phase one: note which files under ``root`` (those of ``list_files``) go, by the ``path`` column of ``delete``, and
    that all others stay. Returns the plan's id. A path that isn't listed is an error, as is a plan that keeps nothing."""
    listed = list_files(spark, root, glob)
    gone = delete.select("path").distinct().withColumn("gone", F.lit(True))
    both = listed.join(gone, "path", "full_outer").select(
        "path", "length", "modificationTime", F.coalesce(~F.col("gone"), F.lit(True)).alias("stays"))
    run = uuid.uuid4().hex
    target = f"{root}/{FOLDER}/plan={run}"
    both.write.parquet(target)
    counts = manifest(spark, root, run).agg(
        F.count_if("stays").alias("kept"), F.count_if(F.col("length").isNull()).alias("unknown")).first()
    if counts.unknown or not counts.kept:
        write_text(spark, f"{target}/_CLOSED", "void")
        raise ValueError(f"the plan names {counts.unknown} files that aren't there and keeps {counts.kept}")
    write_text(spark, f"{target}/_PLANNED", "")
    return run


def manifest(spark: SparkSession, root: str, run: str) -> DataFrame:
    """(path, length, modificationTime, stays) of a plan."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/{FOLDER}/plan={run}")


def open_plans(spark: SparkSession, root: str) -> list[str]:
    """Plans that were noted to the end and are not carried out yet."""
    found = partition_values(spark, f"{root}/{FOLDER}", "plan") or []
    place = f"{root}/{FOLDER}/plan="
    return sorted(r for r in found if read_text(spark, f"{place}{r}/_PLANNED") is not None
                  and read_text(spark, f"{place}{r}/_CLOSED") is None)


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for r in b.to_pylist():
            fs, path = pafs.FileSystem.from_uri(r["path"])
            info = fs.get_file_info(path)
            if info.type == pafs.FileType.NotFound:
                out.append("gone")
            elif info.size != r["length"] or int(info.mtime.timestamp() * 1000) != r["millis"]:
                out.append("changed")
            else:
                fs.delete_file(path)
                out.append("deleted")
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(out, pa.string())], names=["path", "outcome"])


def execute(spark: SparkSession, root: str, run: str, glob: str = "*.parquet") -> dict[str, int]:
    """Phase two: delete what the plan says, after the check that what should stay is intact. Returns the number of files
    by outcome: ``deleted``, ``gone`` (they weren't there any more) and ``changed`` (written anew, so they stay)."""
    place = f"{root}/{FOLDER}/plan={run}"
    if run not in open_plans(spark, root):
        raise ValueError(f"no open plan {run}")
    noted = manifest(spark, root, run)
    now = list_files(spark, root, glob).select("path", "length", "modificationTime")
    lost = noted.where("stays").select("path", "length", "modificationTime").exceptAll(now).count()
    if lost:
        raise NotIntact(f"{lost} files that should stay are not there as they were; nothing was deleted")
    millis = F.unix_millis("modificationTime").alias("millis")
    outcomes = noted.where("not stays").select("path", "length", millis).repartition("path") \
        .mapInArrow(_delete, "path string, outcome string")
    outcomes.write.mode("overwrite").parquet(f"{place}/_outcomes")
    counts = spark.read.schema("path string, outcome string").parquet(f"{place}/_outcomes").groupBy("outcome").count()
    found = {"deleted": 0, "gone": 0, "changed": 0} | dict(map(tuple, counts.collect()))
    write_text(spark, f"{place}/_CLOSED", "done")
    return found
