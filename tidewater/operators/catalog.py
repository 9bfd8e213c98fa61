"""Table metadata and lake maintenance.

Metadata is handled as ordinary DataFrames (one row per column / key / file), so catalogs with millions of tables
or objects are processed by the same joins and aggregates as data. Lake rewrites go through Spark writers with
dynamic partition overwrite into fresh locations; nothing is listed or moved through the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import key_date

# Source type -> (catalog type, warehouse type).
TYPE_MAPPING = {
    "bigint": ("bigint", "BIGINT"),
    "decimal": ("decimal", "DECIMAL"),
    "double": ("double", "DOUBLE PRECISION"),
    "float": ("float", "FLOAT"),
    "int": ("int", "INT"),
    "mediumint": ("int", "INT"),
    "smallint": ("smallint", "SMALLINT"),
    "tinyint": ("tinyint", "TINYINT"),
    "date": ("date", "DATE"),
    "timestamp": ("timestamp", "TIMESTAMP"),
    "datetime": ("timestamp", "TIMESTAMP"),
    "precision_datetime": ("precision_timestamp", "TIMESTAMP"),
    "char": ("char", "CHAR"),
    "varchar": ("string", "VARCHAR"),
    "string": ("string", "VARCHAR"),
    "text": ("string", "VARCHAR"),
    "tinytext": ("string", "VARCHAR"),
    "longblob": ("string", "VARCHAR"),
    "mediumtext": ("string", "VARCHAR"),
    "longtext": ("string", "VARCHAR"),
    "enum": ("string", "VARCHAR"),
}

# File-schema type names renamed to catalog names when comparing.
FILE_TYPE_RENAMES = {"integer": "int", "long": "bigint", "byte": "tinyint"}


def type_mapping_df(spark: SparkSession) -> DataFrame:
    rows = [(k, g, v) for k, (g, v) in TYPE_MAPPING.items()]
    return spark.createDataFrame(rows, "source_type string, catalog_type string, warehouse_type string")


def map_types(columns: DataFrame, type_col: str = "data_type") -> DataFrame:
    """Attach catalog and warehouse types; unknown source types map to null. The mapping is a fixed 21-row table,
    so the broadcast has a proven size bound."""
    m = type_mapping_df(columns.sparkSession)
    return columns.join(F.broadcast(m), F.col(type_col) == m.source_type, "left").drop("source_type")


def schema_columns(table_name: Column, column_name: Column, data_type: Column, data_length: Column,
                   ordinal: Column, column_key: Column) -> Column:
    return F.struct(column_name.alias("name"), data_type.alias("data_type"), data_length.alias("data_length"),
                    ordinal.alias("ordinal_position"), column_key.alias("column_key"))


def table_defs_from_columns(columns: DataFrame, table: str = "table_name") -> DataFrame:
    """Column rows (table_name, name, data_type, data_length, ordinal_position, column_key) -> one definition per
    table: columns ordered by position, primary keys (``PRI``) and unique keys (``UNI``), with the mapped types.
    The per-table lists are bounded by the table's column count."""
    typed = map_types(columns)
    col = F.struct(F.col("ordinal_position"), F.col("name"), F.col("data_type"),
                   F.coalesce(F.col("data_length"), F.lit("")).alias("data_length"),
                   F.col("catalog_type"), F.col("column_key"))
    g = typed.groupBy(table).agg(F.array_sort(F.collect_list(col)).alias("columns"))
    key = lambda kind: F.transform(F.filter("columns", lambda c: c["column_key"] == kind),
                                   lambda c: F.struct(c["name"].alias("name"),
                                                      c["ordinal_position"].alias("ordinal_position")))
    return g.select(table, F.lit("EXTERNAL_TABLE").alias("table_type"), F.lit("mysql").alias("classification"),
                    "columns", key("PRI").alias("primary_keys"), key("UNI").alias("unique_keys"))


def render_column_types(columns: DataFrame) -> DataFrame:
    """Catalog type text per column: mapped type plus ``(length)`` unless the type is string or the length is empty.
    A length that already carries brackets (decimal ``(p,s)``) is not wrapped again."""
    typed = map_types(columns)
    ln = F.coalesce(F.col("data_length"), F.lit(""))
    wrapped = F.when(ln.startswith("("), ln).otherwise(F.concat(F.lit("("), ln, F.lit(")")))
    text = F.when((F.col("catalog_type") != "string") & (F.length(ln) > 0),
                  F.concat(F.col("catalog_type"), wrapped)).otherwise(F.col("catalog_type"))
    return typed.withColumn("type_text", text)


def evolve_schema(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append rows that carry new columns: target columns first (in order), new columns after; rows lacking a
    column get null."""
    return target.unionByName(incoming, allowMissingColumns=True)


def file_schema_rows(df: DataFrame) -> list[tuple[int, str, str]]:
    """(row_num, name, type) of a DataFrame's schema, with file type names renamed to catalog names."""
    rows = []
    for i, f in enumerate(df.schema.fields):
        tname = f.dataType.typeName()
        rows.append((i, f.name, FILE_TYPE_RENAMES.get(tname, f.dataType.simpleString())))
    return rows


def compare_file_schema(file_cols: DataFrame, catalog_cols: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Full outer join of two column lists on ``keys`` (default the column name; add a table key to compare many
    tables at once): status ``missing_in_catalog``, ``missing_in_file``, ``type_differs`` or ``same``. File type
    names are renamed to catalog names first."""
    keys = keys or ["name"]
    renamed = F.coalesce(F.create_map(*[x for k, v in FILE_TYPE_RENAMES.items() for x in (F.lit(k), F.lit(v))])
                         [F.col("type")], F.col("type"))
    f = file_cols.select(*keys, F.col("row_num").alias("file_pos"), renamed.alias("file_type"))
    c = catalog_cols.select(*keys, F.col("row_num").alias("catalog_pos"), F.col("type").alias("catalog_type"))
    j = f.join(c, keys, "full_outer")
    status = (F.when(F.col("catalog_type").isNull(), "missing_in_catalog")
              .when(F.col("file_type").isNull(), "missing_in_file")
              .when(F.col("file_type") != F.col("catalog_type"), "type_differs").otherwise("same"))
    return j.withColumn("status", status)


def partition_values(df: DataFrame, id_col: str, date: str, hours: range | list | None = None) -> DataFrame:
    """Partition value lists: every id times the date (times every hour when given), as an array column."""
    out = df.select(F.col(id_col)).distinct().withColumn("date_", F.lit(date))
    if hours is not None:
        out = out.withColumn("hour", F.explode(F.array(*[F.lit(h) for h in hours])))
        return out.select(id_col, "date_", "hour",
                          F.array(F.col(id_col).cast("string"), F.col("date_"), F.col("hour").cast("string"))
                          .alias("values"))
    return out.select(id_col, "date_", F.array(F.col(id_col).cast("string"), F.col("date_")).alias("values"))


def partition_rollup(spark: SparkSession, src_path: str, dst_path: str, day_col: str = "date_",
                     hour_col: str = "hour", target_hour: int = 23, partition_cols: list[str] | None = None) -> None:
    """Move all hourly partitions of each day into hour ``target_hour``: read, set the hour, cluster by the partition
    columns (AQE cuts a heavy day into several tasks) and write to a new location (never over the input). Only the
    days that are read are replaced there; those rolled up earlier stay."""
    cols = partition_cols or [day_col, hour_col]
    df = spark.read.parquet(src_path).withColumn(hour_col, F.lit(target_hour))
    df.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*cols).parquet(dst_path)


def retention_plan(keys: DataFrame, key_col: str, as_of: str | datetime, retention_days: int,
                   folder_marker: str = "$folder$") -> DataFrame:
    """Keys to delete: folder markers under dated keys, and keys whose date (see ``key_date``) is on or before
    ``as_of - retention_days``. Keys without a date are never deleted."""
    cutoff = F.to_date(F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days)))
    k = F.col(key_col)
    is_dated = k.contains("date")
    marker = is_dated & k.contains(folder_marker)
    d = key_date(key_col)
    return keys.where(marker | (is_dated & ~k.contains(folder_marker) & (d <= cutoff)))


def retention_by_mtime(listing: DataFrame, as_of: str | datetime, retention_days: int,
                       time_col: str = "modificationTime") -> DataFrame:
    """Variant of the retention plan for undated names: files (a ``list_files`` listing) last modified on or before
    ``as_of - retention_days``."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(retention_days))
    return listing.where(F.col(time_col).cast("timestamp") <= cutoff)


def retention_guard(all_prefixes: DataFrame, delete_prefixes: DataFrame, column: str = "prefix") -> DataFrame:
    """The deletion plan, released only if at least one prefix of the guarded table stays intact; otherwise empty.
    The gate is a left-semi join against a non-empty remainder (no driver round trip)."""
    remain = all_prefixes.select(column).subtract(delete_prefixes.select(column))
    gate = remain.limit(1).select(F.lit(1).alias("_tw_gate"))
    return delete_prefixes.withColumn("_tw_gate", F.lit(1)).join(gate, "_tw_gate", "left_semi").drop("_tw_gate")
