"""Projections, filters and predicates bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import to_json_compact
from tidewater.operators import filters as op
from tidewater.plans.common import t
from tidewater.plans.registry import query


@query("point_lookup", "SELECT * FROM customer WHERE c_custkey = 7")
def point_lookup(spark, sf):
    """SQL text with a bound named parameter; the literal reaches the Parquet scan as a pushed filter."""
    return op.point_lookup_sql(t(spark, sf, "customer"), "c_custkey", 7)


@query("date_range_filter", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
 WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
""")
def date_range_filter(spark, sf):
    o = t(spark, sf, "orders")
    return op.date_range_sql(o, "o_orderdate", "1996-01-01", "1997-01-01").select(
        "o_orderkey", "o_custkey", "o_orderdate")


@query("contains_any_filter", """
SELECT page_id, url FROM pages
 WHERE contains(lower(url), 'blog') OR contains(lower(url), 'page=') OR contains(lower(url), '.html')
""")
def contains_any_filter(spark, sf):
    return op.contains_any_filter(t(spark, sf, "pages"), "url", ["Blog", "page=", ".HTML"]).select("page_id", "url")


@query("not_null_filter", """
SELECT event_id, user_id, props FROM events WHERE user_id IS NOT NULL AND props IS NOT NULL
""")
def not_null_filter(spark, sf):
    return op.not_null_filter(t(spark, sf, "events"), ["user_id", "props"]).select("event_id", "user_id", "props")


@query("in_list_filter", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
 WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
""")
def in_list_filter(spark, sf):
    o = op.in_list_filter(t(spark, sf, "orders"), "o_orderstatus", ["F", "P"])
    o = op.in_list_filter(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], negate=True)
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("case_classify", """
SELECT event_id,
       CASE WHEN event_type = 'click' THEN 'checkout' WHEN event_type = 'view' THEN 'page_view'
            WHEN event_type = 'purchase' THEN 'booking' END AS category
  FROM events
""")
def case_classify(spark, sf):
    e = F.col("event_type")
    cat = op.case_classify([(e == "click", F.lit("checkout")), (e == "view", F.lit("page_view")),
                            (e == "purchase", F.lit("booking"))])
    return t(spark, sf, "events").select("event_id", cat.alias("category"))


# names: part names; exclusion list: names of parts larger than 45 (a Spark-derived list); temporary prefix 'tmp_'
# is given to parts of size 1 so that both rules act.
_PART_NAMES = "CASE WHEN p_size = 1 THEN 'tmp_' || p_name ELSE p_name END"


@query("exclude_tables_filter", f"""
WITH names AS (SELECT DISTINCT {_PART_NAMES} AS name FROM part),
     excl AS (SELECT DISTINCT p_name AS name FROM part WHERE p_size > 45)
SELECT name FROM names WHERE NOT starts_with(name, 'tmp_') AND name NOT IN (SELECT name FROM excl)
""")
def exclude_tables_filter(spark, sf):
    p = t(spark, sf, "part")
    names = p.select(F.expr(_PART_NAMES).alias("name")).distinct()
    excl = p.where("p_size > 45").select(F.col("p_name").alias("name"))
    return op.exclude_names(names, "name", excl)


_TMP_NAME = ("CASE WHEN o_orderkey % 2 = 0 THEN 'tmp_orders_' ELSE 'orders_' END || "
             "{fmt} || '_' || CAST(o_orderkey AS STRING)")


@query("dated_name_filter", f"""
SELECT name FROM (SELECT {_TMP_NAME.format(fmt="strftime(o_orderdate, '%Y%m%d')").replace('STRING', 'VARCHAR')} AS name
                    FROM orders)
 WHERE regexp_matches(name, '^tmp_.*[0-9]{{8}}')
   AND strptime(regexp_extract(name, '([0-9]{{8}})', 1), '%Y%m%d') < TIMESTAMP '1998-01-01' - INTERVAL 1 DAY
""")
def dated_name_filter(spark, sf):
    o = t(spark, sf, "orders").select(F.expr(_TMP_NAME.format(fmt="date_format(o_orderdate, 'yyyyMMdd')")).alias("name"))
    return op.dated_name_filter(o, "name", "1998-01-01 00:00:00", 1)


def _query_history(spark, sf):
    """Query-history records packed from ``orders``: id, state, scanned bytes, submission time, timings."""
    o = t(spark, sf, "orders")
    state = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "P", "FAILED") \
        .otherwise("RUNNING")
    return o.select(
        F.col("o_orderkey").cast("string").alias("QueryExecutionId"),
        F.struct(state.alias("State"), F.col("o_orderdate").alias("SubmissionDateTime")).alias("Status"),
        F.struct(F.round(F.col("o_totalprice") * 1000000).cast("bigint").alias("DataScannedInBytes"),
                 F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("EngineExecutionTimeInMillis"),
                 ).alias("Statistics"),
        F.struct(F.col("o_orderpriority").alias("Database")).alias("QueryExecutionContext"),
    )


_QH_SQL = """
WITH qh AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS QueryExecutionId,
         CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'RUNNING' END AS state,
         o_orderdate AS submitted, CAST(round(o_totalprice * 1000000) AS BIGINT) AS scanned,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS engine_ms, o_orderpriority AS db
    FROM orders)
"""
_QH_WHERE = """
 WHERE state IN ('SUCCEEDED', 'FAILED', 'CANCELLED') AND scanned / 1073741824.0 > 50
   AND submitted <= TIMESTAMP '1998-08-01' AND submitted >= TIMESTAMP '1998-08-01' - INTERVAL 525600 MINUTE
"""


@query("filter_query_log", _QH_SQL + "SELECT QueryExecutionId FROM qh" + _QH_WHERE)
def filter_query_log(spark, sf):
    q = _query_history(spark, sf)
    return op.filter_query_log(q, "Status.State", "Statistics.DataScannedInBytes", "Status.SubmissionDateTime",
                               "1998-08-01 00:00:00", 525600).select("QueryExecutionId")


@query("flatten_nested", _QH_SQL + """
SELECT QueryExecutionId AS id, state, scanned AS scanned_bytes, COALESCE(engine_ms, -1) AS engine_ms, db AS database
  FROM qh""")
def flatten_nested(spark, sf):
    return op.flatten_nested(_query_history(spark, sf), {
        "id": "QueryExecutionId", "state": "Status.State", "scanned_bytes": "Statistics.DataScannedInBytes",
        "engine_ms": "Statistics.EngineExecutionTimeInMillis", "database": "QueryExecutionContext.Database"})


@query("flatten_struct_column", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax * 2 AS l_tax FROM lineitem
""")
def flatten_struct_column(spark, sf):
    li = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax",
        F.struct("l_quantity", "l_extendedprice", (F.col("l_tax") * 2).alias("l_tax")).alias("props"))
    return op.flatten_struct_column(li, "props")


@query("sanitize_columns", "SELECT conv_id, turn, role, text AS message_text FROM conversations")
def sanitize_columns(spark, sf):
    c = t(spark, sf, "conversations").toDF("Conv Id", "TURN", "Role", "Message Text")
    return op.sanitize_columns(c)


@query("rename_case", """
SELECT c_custkey AS cCustkey, c_name AS cName, c_nationkey AS cNationkey, c_acctbal AS cAcctbal,
       c_mktsegment AS cMktsegment FROM customer
""")
def rename_case(spark, sf):
    snake = op.rename_case(t(spark, sf, "customer").toDF("cCustkey", "cName", "cNationkey", "cAcctbal",
                                                         "cMktsegment"), "snake")
    return op.rename_case(snake, "camel")


@query("project_nested_report", """
SELECT o.o_orderkey AS campaign_id, o.o_orderstatus AS campaign_status, CAST(o.o_orderdate AS DATE) AS segment_date,
       CAST(l.l_quantity AS BIGINT) AS impressions, CAST(l.l_linenumber AS BIGINT) AS clicks,
       CAST(round(l.l_extendedprice * 1000000) AS BIGINT) AS cost_micros
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 WHERE CAST(l.l_quantity AS BIGINT) > 1 AND o.o_orderstatus IN ('F', 'O')
""")
def project_nested_report(spark, sf):
    li, o = t(spark, sf, "lineitem"), t(spark, sf, "orders")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("campaign"),
        F.struct(F.to_date("o_orderdate").alias("date")).alias("segments"),
        F.struct(F.col("l_quantity").cast("bigint").alias("impressions"),
                 F.col("l_linenumber").cast("bigint").alias("clicks"),
                 F.round(F.col("l_extendedprice") * 1000000).cast("bigint").alias("cost_micros")).alias("metrics"))
    return op.project_report(rows, {"campaign_id": "campaign.id", "campaign_status": "campaign.status",
                                    "segment_date": "segments.date", "impressions": "metrics.impressions",
                                    "clicks": "metrics.clicks", "cost_micros": "metrics.cost_micros"},
                             where=(F.col("metrics.impressions") > 1) & F.col("campaign.status").isin("F", "O"))


@query("conditional_update", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_discount END AS l_discount
  FROM lineitem
""")
def conditional_update(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_discount")
    return op.conditional_update(li, "l_discount", float("nan"), F.col("l_returnflag") == "R") \
        .drop("l_returnflag")


@query("derive_ratio", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END
       AS cost_per_unit FROM lineitem
""")
def derive_ratio(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return op.derive_ratio(li, "l_extendedprice", "l_quantity", "cost_per_unit").select(
        "l_orderkey", "l_linenumber", "cost_per_unit")


@query("add_literal", "SELECT event_id, user_id, 2 AS model_version, 'baseline' AS model_type FROM events")
def add_literal(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id")
    return op.add_literal(e, model_version=2, model_type="baseline")


@query("any_null_filter", """
SELECT c_custkey, c_name, seg FROM (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)
 WHERE c_name IS NULL OR seg IS NULL
""")
def any_null_filter(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return op.any_null_filter(c, ["c_name", "seg"])


@query("remove_empty_elements", """
WITH r AS (SELECT l_orderkey, to_json(list({'n': l_linenumber, 'flag': l_returnflag} ORDER BY l_linenumber, l_returnflag))
                  AS lines FROM lineitem GROUP BY l_orderkey),
     p AS (SELECT o.o_orderkey, concat_ws(',',
             CASE WHEN o.o_orderpriority <> '5-LOW' THEN '"priority":"' || o.o_orderpriority || '"' END,
             CASE WHEN r.lines IS NOT NULL THEN '"lines":' || r.lines END,
             CASE WHEN o.o_orderstatus <> 'F' THEN '"meta":{"status":"' || o.o_orderstatus || '"}' END) AS parts
             FROM orders o LEFT JOIN r ON r.l_orderkey = o.o_orderkey)
SELECT o_orderkey, CASE WHEN parts = '' THEN '[]' ELSE '{' || parts || '}' END AS doc_json FROM p
""")
def remove_empty_elements(spark, sf):
    """Per order, a nested document with optional parts: null priority, empty line lists and all-empty structs
    are removed recursively before writing JSON."""
    o = t(spark, sf, "orders")
    li = t(spark, sf, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.array_sort(
        F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag")))).alias("lines"))
    doc = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey",
        F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
                 F.coalesce(F.col("lines"), F.array().cast("array<struct<n:int,flag:string>>")).alias("lines"),
                 F.struct(F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_orderstatus"))
                          .alias("status")).alias("meta")).alias("doc"))
    dtype = doc.schema["doc"].dataType
    return doc.select("o_orderkey", to_json_compact("doc", dtype).alias("doc_json"))


@query("extract_domain_parts", r"""
SELECT page_id,
       CASE WHEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1) = 'postgresql' THEN 'postgres'
            ELSE replace(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1), '-', '_') END AS scheme,
       nullif(regexp_extract(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1),
              '^[^@]*@', ''), '^([^:]*)', 1), '') AS host,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path,
       regexp_extract(url, '\?([^#]*)', 1) AS query
  FROM pages
""")
def extract_domain_parts(spark, sf):
    p = t(spark, sf, "pages").select("page_id", op.url_parts("url").alias("u"),
                                     F.regexp_extract("url", r"\?([^#]*)", 1).alias("query"))
    return p.select("page_id", "u.scheme", "u.host", "u.path", "query")
