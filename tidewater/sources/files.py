"""File and database sources. Explicit schemas on every read; inference only behind a named option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default port per database type.
DEFAULT_PORTS = {"mysql": 3306, "postgres": 5432, "postgresql": 5432}


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, header: bool = True,
             infer_schema: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """CSV files. A malformed line fails the read; ``mode="PERMISSIVE"`` turns its fields into nulls instead."""
    r = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                 merge_schema: bool = False) -> DataFrame:
    r = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


# microsecond text form of times in JSON lines (Spark's default JSON writer keeps milliseconds only)
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType,
                    mode: str = "FAILFAST") -> DataFrame:
    """Newline-delimited JSON, plain or gzip (by file suffix); one object per line. A malformed line fails the read;
    ``mode="PERMISSIVE"`` turns its fields into nulls instead."""
    return spark.read.schema(schema).option("mode", mode).option("timestampNTZFormat", JSON_TS_FORMAT) \
        .option("timestampFormat", JSON_TS_FORMAT).json(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """Newline-delimited JSON with microsecond times."""
    fmt = JSON_TS_FORMAT.replace("[", "").replace("]", "")
    df.write.mode(mode).option("compression", compression).option("timestampNTZFormat", fmt) \
        .option("timestampFormat", fmt).json(path)


def read_by_suffix(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    p = path.rstrip("/").lower()
    if p.endswith(".csv") or p.endswith(".csv.gz"):
        return read_csv(spark, path, schema)
    if p.endswith(".json") or p.endswith(".json.gz") or p.endswith(".jsonl"):
        if schema is None:
            raise ValueError("JSON reads need an explicit schema")
        return read_json_lines(spark, path, schema)
    if p.endswith(".parquet"):
        return read_parquet(spark, path, schema)
    raise ValueError(f"unsupported file type: {path}")


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """Object listing as a DataFrame (path, length, modificationTime) under one prefix or a list of prefixes;
    ``recursive=False`` lists one level (the delimiter form). Only metadata columns are selected, so the binary
    content is never read; the listing itself is distributed by Spark's file index."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def jdbc_url(db_type: str, host: str, database: str, port: int | None = None) -> str:
    kind = "postgresql" if db_type in ("postgres", "postgresql") else db_type
    return f"jdbc:{kind}://{host}:{port or DEFAULT_PORTS[db_type]}/{database}"


def jdbc_options(url: str, *, query: str | None = None, dbtable: str | None = None, user: str | None = None,
                 password: str | None = None, session_variables: dict | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10000, driver: str | None = None) -> dict:
    """Reader options for a JDBC scan. ``session_variables`` become a ``SET SESSION`` statement run once per
    connection; a partition column splits the read into parallel range queries (one per executor task)."""
    if (query is None) == (dbtable is None):
        raise ValueError("give exactly one of query / dbtable")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if query is not None:
        if partition_column:
            # partitioned reads need a table expression, so the query becomes a derived table
            opts["dbtable"] = f"({query}) AS q"
        else:
            opts["query"] = query
    else:
        opts["dbtable"] = dbtable
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if session_variables:
        assigns = ", ".join(f"{k}={v}" for k, v in session_variables.items())
        opts["sessionInitStatement"] = f"SET SESSION {assigns}"
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """A SQL query or table of a MySQL/Postgres database as a DataFrame (filters and columns are pushed down)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def timestamps_to_text(df: DataFrame) -> DataFrame:
    """Cast every timestamp column to text (JSON export keeps times as strings)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss")
            part = F.date_format(F.col(f.name), "SSSSSS")
            cols.append(F.when(part == "000000", whole).otherwise(F.concat_ws(".", whole, part)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
