"""Keyed state tables without a lakehouse format.

Keys are hashed to buckets. A version of the state is a manifest, which names for each bucket the version that wrote its
files, and the files of the buckets that this version wrote: those with updates, and no others. Readers take the newest
version that has its success marker, which comes last, after the manifest; so a failed or retried write never touches
what readers use, and an upsert costs what its buckets hold, not what the state holds. Buckets double when they outgrow
``MAX_ROWS`` (that upsert rewrites all). Old versions stay until ``prune_versions``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources.partitions import delete, partition_values, read_text, write_text

VERSION, BUCKET = "version", "_tw_bucket"
MANIFEST, MARKER, UPDATES = "_manifest.json", "_SUCCESS", "_updates"
#: Rows that a bucket holds before buckets double.
MAX_ROWS = 1_000_000


def version_path(path: str, version: int) -> str:
    return f"{path}/{VERSION}={version}"


def latest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest committed version (of those under ``below``, if given), from the ``version=`` directory listing
    (no data file is read). A version whose writer died before its success marker doesn't count."""
    found = [int(v) for v in partition_values(spark, path, VERSION, committed=True) or []]
    return max((v for v in found if below is None or v < below), default=None)


def manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """``schema``, the number of buckets ``n``, the key columns, and for each bucket that has rows the version that wrote
    it and its rows. None for a version that is one table without buckets."""
    text = read_text(spark, f"{version_path(path, version)}/{MANIFEST}")
    return json.loads(text) if text else None


def _read(spark: SparkSession, path: str, version: int, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version; with ``buckets`` only of these."""
    m = manifest(spark, path, version)
    if m is None:
        return spark.read.parquet(version_path(path, version))
    schema = T.StructType.fromJson(m["schema"])
    files = [f"{version_path(path, v)}/{BUCKET}={b}" for b, (v, _) in m["buckets"].items()
             if buckets is None or int(b) in buckets]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)  # columns that older files lack are null


def read_state(spark: SparkSession, path: str, schema: str | None = None,
               below: int | None = None) -> DataFrame | None:
    """The newest version of the state table (of those under ``below``, if given), with the columns of that version;
    a missing table reads as empty (``None`` without a schema)."""
    v = latest_version(spark, path, below)
    if v is None:
        return spark.createDataFrame([], schema) if schema else None
    return _read(spark, path, v)


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _once(updates: DataFrame, keys: list[str]) -> DataFrame:
    """``updates``, failing at several rows of one key."""
    row = F.struct(F.lit(1).alias("_tw_one"), *[c for c in updates.columns if c not in keys])
    once = updates.groupBy(*keys).agg(F.first(row).alias("_tw_row"), F.count(F.lit(1)).alias("_tw_n"))
    checked = F.when(F.col("_tw_n") == 1, F.col("_tw_row")).otherwise(
        F.raise_error(F.lit("several updates of one key")))
    return once.select(*keys, checked.alias("_tw_row")).select(*keys, "_tw_row.*").select(*updates.columns)


def _write(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """One folder a bucket, each written by one task (a bucket's rows are bounded); no success marker yet."""
    df.repartition(BUCKET).write.mode(mode).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .partitionBy(BUCKET).parquet(target)


def upsert_by_key(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                  version: int | None = None, buckets: int | None = None, max_rows: int = MAX_ROWS) -> int:
    """Insert or replace ``updates`` by key and write the next version; returns the new version number. Columns that
    either side lacks become nulls. Several updates of one key fail the job: which one should win isn't defined.

    With ``version`` that version is written, from the newest one below it, whatever was there before: a replay of the
    same updates gives the same state. ``buckets`` is their number in a new state (else as many as shuffle
    partitions)."""
    v = latest_version(spark, path, version)
    nv = version if version is not None else 0 if v is None else v + 1
    here = version_path(path, nv)
    delete(spark, here)
    old = manifest(spark, path, v) if v is not None else None
    whole = v is not None and (old is None or old["keys"] != keys)  # another layout: all of it is dealt anew
    n = old["n"] if old else buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    held = sum(rows for _, rows in old["buckets"].values()) if old else 0
    while old and held > max_rows * n:
        n, whole = 2 * n, True

    # the updates are evaluated once; which buckets they touch is in the listing
    _write(_once(updates, keys).withColumn(BUCKET, _bucket(keys, n)), f"{here}/{UPDATES}")
    touched = {int(b) for b in partition_values(spark, f"{here}/{UPDATES}", BUCKET) or []}
    fresh = spark.read.schema(T.StructType([*updates.schema.fields, T.StructField(BUCKET, T.IntegerType())])) \
        .parquet(f"{here}/{UPDATES}")
    schema = updates.schema
    if v is not None:
        before = _read(spark, path, v)
        schema = before.unionByName(updates, allowMissingColumns=True).schema
        whole = whole or any(schema[f.name].dataType != f.dataType for f in before.schema.fields)
        if not whole:
            before = _read(spark, path, v, sorted(touched))
        replaced = F.lit(True)
        for k in keys:
            replaced = replaced & F.col(f"o.{k}").eqNullSafe(F.col(f"u.{k}"))
        kept = before.alias("o").join(fresh.select(*keys).alias("u"), replaced, "left_anti")
        fresh = kept.withColumn(BUCKET, _bucket(keys, n)).unionByName(fresh, allowMissingColumns=True)
    _write(fresh, here, "append")
    delete(spark, f"{here}/{UPDATES}")
    counts = {}
    if partition_values(spark, here, BUCKET):
        counts = dict(map(tuple, spark.read.parquet(here).groupBy(BUCKET).count().collect()))  # one row a bucket
    places = {} if whole or not old else dict(old["buckets"])
    places.update({str(b): [nv, rows] for b, rows in counts.items()})
    write_text(spark, f"{here}/{MANIFEST}", json.dumps(
        {"keys": keys, "n": n, "schema": schema.jsonValue(), "buckets": places}))
    write_text(spark, f"{here}/{MARKER}", "")
    return nv


def prune_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the ``keep`` newest versions (one at least stays) with the files that only they use; returns the
    versions deleted."""
    found = sorted(int(v) for v in partition_values(spark, path, VERSION, committed=True) or [])
    gone = found[:-max(keep, 1)]
    used = {(v, int(b)) for n in found[len(gone):] for b, (v, _) in (manifest(spark, path, n) or {"buckets": {}})["buckets"].items()}
    for v in partition_values(spark, path, VERSION) or []:
        if int(v) in gone or (int(v) not in found and found and int(v) < found[-1]):
            here = version_path(path, int(v))
            delete(spark, f"{here}/{MARKER}")  # first: no reader takes it from here on
            held = {int(b) for b in partition_values(spark, here, BUCKET) or []}
            if not any((int(v), b) in used for b in held):
                delete(spark, here)
                continue
            for name in (MANIFEST, *(f"{BUCKET}={b}" for b in held if (int(v), b) not in used)):
                delete(spark, f"{here}/{name}")
    return gone


def get_value(spark: SparkSession, path: str, key_col: str, key, value_col: str = "value"):
    """One key's value, or None when absent; reads the key's bucket only."""
    v = latest_version(spark, path)
    if v is None:
        return None
    m, buckets = manifest(spark, path, v), None
    if m and m["keys"] == [key_col]:
        kind = T.StructType.fromJson(m["schema"])[key_col].dataType
        own = spark.range(1).select(F.lit(key).cast(kind).alias(key_col)).select(_bucket([key_col], m["n"]))
        buckets = [own.first()[0]]
    row = _read(spark, path, v, buckets).where(F.col(key_col) == F.lit(key)).select(value_col).first()
    return None if row is None else row[0]
