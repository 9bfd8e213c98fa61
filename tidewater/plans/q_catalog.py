"""Table metadata and lake maintenance on metadata derived from the driver tables.

Derived catalog: every order is a table ``order_<key>`` and every line item one of its columns; the column's
source type comes from (return flag, line status), its length from the quantity, its key role from the line number.
So the catalog grows with the data, and the metadata operators run as ordinary distributed jobs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import catalog as op
from tidewater.operators.sets import parent_prefix
from tidewater.plans.common import t
from tidewater.plans.registry import query
from tidewater.session import scratch_path

_TYPE_SQL = ("CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'bigint' WHEN 'AO' THEN 'int' WHEN 'NF' THEN 'decimal' "
             "WHEN 'NO' THEN 'varchar' WHEN 'RF' THEN 'datetime' ELSE 'text' END")
_LEN_SQL = ("CASE WHEN {t} = 'varchar' THEN CAST(CAST(l_quantity AS INT) * 10 AS {s}) WHEN {t} = 'decimal' THEN '(12,2)' "
            "WHEN {t} = 'text' THEN '4000' ELSE '' END")
_KEY_SQL = "CASE WHEN l_linenumber = 1 THEN 'PRI' WHEN l_linenumber = 2 THEN 'UNI' ELSE '' END"
_NAME_SQL = "'c' || CAST(l_linenumber AS {s}) || '_' || CAST(l_partkey AS {s})"

COLUMNS_SQL = f"""
SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS table_name, {_NAME_SQL.format(s='VARCHAR')} AS name,
       {_TYPE_SQL} AS data_type, {_LEN_SQL.format(t=_TYPE_SQL, s='VARCHAR')} AS data_length,
       l_linenumber AS ordinal_position, {_KEY_SQL} AS column_key
  FROM lineitem
"""
MAPPING_SQL = "(VALUES " + ", ".join(f"('{k}', '{g}', '{v}')" for k, (g, v) in op.TYPE_MAPPING.items()) + \
    ") m(source_type, catalog_type, warehouse_type)"


def catalog_columns(spark, sf):
    li = t(spark, sf, "lineitem")
    ty = F.expr(_TYPE_SQL)
    return li.select(
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.expr(_NAME_SQL.format(s="STRING")).alias("name"), ty.alias("data_type"),
        F.expr(_LEN_SQL.format(t=_TYPE_SQL, s="STRING")).alias("data_length"),
        F.col("l_linenumber").alias("ordinal_position"), F.expr(_KEY_SQL).alias("column_key"))


@query("map_types", f"""
SELECT c.table_name, c.name, c.data_type, m.catalog_type, m.warehouse_type
  FROM ({COLUMNS_SQL}) c LEFT JOIN {MAPPING_SQL} ON c.data_type = m.source_type
""")
def map_types(spark, sf):
    return op.map_types(catalog_columns(spark, sf)).select("table_name", "name", "data_type", "catalog_type",
                                                           "warehouse_type")


@query("table_defs_from_columns", f"""
WITH c AS ({COLUMNS_SQL})
SELECT table_name, COUNT(*) AS n_columns,
       string_agg(name, ',' ORDER BY ordinal_position, name) AS column_names,
       COALESCE(string_agg(name, ',' ORDER BY ordinal_position, name) FILTER (WHERE column_key = 'PRI'), '')
         AS primary_keys,
       COALESCE(string_agg(name, ',' ORDER BY ordinal_position, name) FILTER (WHERE column_key = 'UNI'), '')
         AS unique_keys
  FROM c GROUP BY table_name
""")
def table_defs_from_columns(spark, sf):
    d = op.table_defs_from_columns(catalog_columns(spark, sf))
    return d.select("table_name", F.size("columns").cast("bigint").alias("n_columns"),
                    F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("column_names"),
                    F.array_join(F.transform("primary_keys", lambda c: c["name"]), ",").alias("primary_keys"),
                    F.array_join(F.transform("unique_keys", lambda c: c["name"]), ",").alias("unique_keys"))


@query("render_column_types", f"""
SELECT c.table_name, c.name,
       CASE WHEN m.catalog_type <> 'string' AND length(c.data_length) > 0
            THEN m.catalog_type || CASE WHEN starts_with(c.data_length, '(') THEN c.data_length
                                        ELSE '(' || c.data_length || ')' END
            ELSE m.catalog_type END AS type_text
  FROM ({COLUMNS_SQL}) c LEFT JOIN {MAPPING_SQL} ON c.data_type = m.source_type
""")
def render_column_types(spark, sf):
    return op.render_column_types(catalog_columns(spark, sf)).select("table_name", "name", "type_text")


@query("metadata_join", f"""
WITH tables AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'archive' ELSE 'shop' END AS table_schema,
                       'order_' || CAST(o_orderkey AS VARCHAR) AS table_name,
                       CASE WHEN o_orderpriority = '5-LOW' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type FROM orders),
     cols AS (SELECT CASE WHEN o.o_orderstatus = 'P' THEN 'archive' ELSE 'shop' END AS table_schema, c.*
                FROM ({COLUMNS_SQL}) c JOIN orders o ON c.table_name = 'order_' || CAST(o.o_orderkey AS VARCHAR))
SELECT c.table_schema, c.table_name, c.name, c.data_type FROM tables t JOIN cols c
    ON c.table_schema = t.table_schema AND c.table_name = t.table_name AND t.table_type = 'BASE TABLE'
   AND t.table_schema = 'shop'
""")
def metadata_join(spark, sf):
    from tidewater.operators.joins import metadata_join as mj
    o = t(spark, sf, "orders")
    schema = F.when(F.col("o_orderstatus") == "P", "archive").otherwise("shop")
    tables = o.select(schema.alias("table_schema"),
                      F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("table_name"),
                      F.when(F.col("o_orderpriority") == "5-LOW", "VIEW").otherwise("BASE TABLE").alias("table_type"))
    cols = catalog_columns(spark, sf).join(tables.select("table_schema", "table_name"), "table_name")
    return mj(tables, cols, "shop").select("table_schema", "table_name", "name", "data_type")


@query("evolve_schema", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END
       AS o_orderpriority FROM orders
""")
def evolve_schema(spark, sf):
    o = t(spark, sf, "orders")
    old = o.where("o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'").select("o_orderkey", "o_orderstatus")
    new = o.where("o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00'").select("o_orderkey", "o_orderpriority",
                                                                             "o_orderstatus")
    return op.evolve_schema(old, new)


@query("compare_file_schema", f"""
WITH f AS (SELECT table_name, name, ordinal_position AS file_pos,
                  CASE data_type WHEN 'int' THEN 'int' ELSE data_type END AS file_type FROM ({COLUMNS_SQL})),
     c AS (SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS table_name,
                  {_NAME_SQL.format(s='VARCHAR')} AS name, l_linenumber AS catalog_pos,
                  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'bigint' ELSE {_TYPE_SQL} END AS catalog_type
             FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01')
SELECT COALESCE(f.table_name, c.table_name) AS table_name, COALESCE(f.name, c.name) AS name,
       CASE WHEN c.catalog_type IS NULL THEN 'missing_in_catalog' WHEN f.file_type IS NULL THEN 'missing_in_file'
            WHEN f.file_type <> c.catalog_type THEN 'type_differs' ELSE 'same' END AS status
  FROM f FULL OUTER JOIN c ON f.table_name = c.table_name AND f.name = c.name
""")
def compare_file_schema(spark, sf):
    """File columns (with file type names such as ``integer``) against catalog columns of lines shipped before 2000
    (where ``int`` columns were registered as ``bigint``)."""
    cols = catalog_columns(spark, sf)
    file_cols = cols.select("table_name", "name", F.col("ordinal_position").alias("row_num"),
                            F.when(F.col("data_type") == "int", "integer").otherwise(F.col("data_type")).alias("type"))
    li = t(spark, sf, "lineitem").where("l_shipdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    cat = li.select(F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("table_name"),
                    F.expr(_NAME_SQL.format(s="STRING")).alias("name"), F.col("l_linenumber").alias("row_num"),
                    F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "bigint")
                    .otherwise(F.expr(_TYPE_SQL)).alias("type"))
    return op.compare_file_schema(file_cols, cat, ["table_name", "name"]).select("table_name", "name", "status")


@query("partition_values", """
SELECT c_custkey, '2022-01-01' AS date_, hour
  FROM customer CROSS JOIN (SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS hour)
""")
def partition_values(spark, sf):
    return op.partition_values(t(spark, sf, "customer"), "c_custkey", "2022-01-01", range(0, 24)) \
        .select("c_custkey", "date_", "hour")


@query("partition_rollup", "SELECT event_id, CAST(ts AS DATE) AS date_, 23 AS hour FROM events")
def partition_rollup(spark, sf):
    """Events landed under date_/hour partitions, rolled up into hour=23 of each day, read back."""
    src, dst = scratch_path(spark, "rollup-src"), scratch_path(spark, "rollup-dst")
    e = t(spark, sf, "events").select("event_id", F.to_date("ts").alias("date_"), F.hour("ts").alias("hour"))
    e.write.mode("overwrite").partitionBy("date_", "hour").parquet(src)
    op.partition_rollup(spark, src, dst)
    return spark.read.parquet(dst).select("event_id", "date_", F.col("hour").cast("int").alias("hour"))


_KEYS = ("CASE WHEN o_orderkey % 7 = 0 THEN 'lake/orders/date_=' || {day} || '_$folder$' "
         "WHEN o_orderkey % 5 = 0 THEN 'lake/orders/undated/part-' || CAST(o_orderkey AS {s}) "
         "ELSE 'lake/orders/date_=' || {day} || CASE WHEN o_orderkey % 3 = 1 THEN 'T10:00:00' "
         "WHEN o_orderkey % 3 = 2 THEN '-10-30' ELSE '' END || '/part-' || CAST(o_orderkey AS {s}) || '.parquet' END")


@query("retention_plan", f"""
WITH k AS (SELECT {_KEYS.format(day="strftime(o_orderdate, '%Y-%m-%d')", s="VARCHAR")} AS key FROM orders),
     d AS (SELECT key, string_split(string_split(string_split(key, 'date_')[-1], '/')[1], '=')[-1] AS raw FROM k),
     p AS (SELECT key, CAST(try_strptime(CASE WHEN contains(raw, 'T') THEN string_split(raw, 'T')[1]
                                              ELSE array_to_string(string_split(raw, '-')[1:3], '-') END, '%Y-%m-%d')
                       AS DATE) AS key_date FROM d)
SELECT key FROM p
 WHERE contains(key, 'date') AND (contains(key, '$folder$')
       OR (contains(key, 'date_') AND key_date <= CAST(TIMESTAMP '2000-01-01' - INTERVAL 365 DAY AS DATE)))
""")
def retention_plan(spark, sf):
    keys = t(spark, sf, "orders").select(
        F.expr(_KEYS.format(day="date_format(o_orderdate, 'yyyy-MM-dd')", s="STRING")).alias("key"))
    return op.retention_plan(keys, "key", "2000-01-01 00:00:00", 365)


@query("retention_guard", r"""
WITH allp AS (SELECT DISTINCT regexp_extract(url, '^(.*)/[^/]*$', 1) AS prefix FROM pages),
     del AS (SELECT DISTINCT regexp_extract(url, '^(.*)/[^/]*$', 1) AS prefix FROM pages WHERE contains(url, 'blog'))
SELECT prefix FROM del WHERE EXISTS (SELECT prefix FROM allp EXCEPT SELECT prefix FROM del)
""")
def retention_guard(spark, sf):
    p = t(spark, sf, "pages")
    allp = p.select(parent_prefix(F.col("url")).alias("prefix")).distinct()
    dele = p.where(F.col("url").contains("blog")).select(parent_prefix(F.col("url")).alias("prefix")).distinct()
    return op.retention_guard(allp, dele)
