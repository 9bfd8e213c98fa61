"""Composite workloads and the user-function surface (§2.10).

Raw page views are derived from ``events``: a view is ``/au/travel/offer/<k>/`` (6 path parts, offer second from
the end), a click ``/au/checkout/<k>``, a purchase ``/au/booking/<k>``, anything else ``/au/search/<k>``.
Users (identity bridge) are ``customer`` keyed by name; the customer dimension is ``customer`` outside nation 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import contains_any, parse_json_text, path_segment, to_zone
from tidewater.operators import aggregates as agg
from tidewater.operators import user as uf
from tidewater.operators.filters import case_classify, date_range_filter, filter_query_log, flatten_nested, in_list_filter
from tidewater.operators.joins import flatten_config
from tidewater.operators.sequence import lead_within
from tidewater.operators.windows import assign_ids
from tidewater.plans.common import t
from tidewater.plans.q_filters import _QH_SQL, _QH_WHERE, _query_history
from tidewater.plans.q_joins import EVENT_CONFIG
from tidewater.plans.q_workloads import END, START, SYDNEY
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import api, sinks

_PATH_SQL = ("CASE event_type WHEN 'view' THEN '/au/travel/offer/' || {k} || '/' "
             "WHEN 'click' THEN '/au/checkout/' || {k} WHEN 'purchase' THEN '/au/booking/' || {k} "
             "ELSE '/au/search/' || {k} END")
_KIND_SQL = "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'pageviews' ELSE event_type END"


def raw_pageviews(spark, sf) -> DataFrame:
    k = "get_json_object(props, '$.k')"
    return t(spark, sf, "events").select(
        F.col("ts").alias("time"), "user_id", F.to_date("ts").alias("session_id"), "event_id",
        F.expr(_PATH_SQL.format(k=k)).alias("path"), F.expr(_KIND_SQL).alias("event_view_name"))


def abandoned_from_paths(spark, sf, pv: DataFrame) -> DataFrame:
    """Abandoned views from raw page paths: classify by path, offer from the path, identity bridge to the
    customer dimension (left), latest Sydney view time per session / identity / offer, offers left-joined."""
    p = F.col("path")
    ev = case_classify([(p.contains("checkout"), F.lit("checkout")),
                        (p.contains("offer") | p.contains("partner"), F.lit("page_view")),
                        (p.contains("booking"), F.lit("booking"))])
    s = date_range_filter(pv, "time", START, END)
    s = s.where(contains_any("path", ["checkout", "offer", "partner", "booking"], case_insensitive=False)
                & F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
    s = s.select("time", "user_id", "session_id", "event_id", path_segment("path").alias("offer_bk"),
                 ev.alias("event_type"))
    cand = lead_within(s, ["user_id", "session_id"], ["time", "event_id"], "event_type", "next_event_type")
    av = cand.where((F.col("event_type") == "page_view") & F.col("next_event_type").isin("checkout", "booking")
                    & F.col("offer_bk").isNotNull())
    users = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("identity"))
    dim = t(spark, sf, "customer").where("c_nationkey <> 0").select(
        F.col("c_name").alias("identity"), F.col("c_mktsegment").alias("subscriber_key"))
    j = av.join(users, "user_id").join(dim, "identity", "left")
    g = j.groupBy("session_id", "identity", "offer_bk", "subscriber_key").agg(
        F.max(to_zone("time", SYDNEY)).alias("view_datetime_sydt"))
    offers = t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("offer_bk"),
                                         F.col("p_brand").alias("country_code"), F.col("p_type").alias("offer_type"))
    return g.join(offers, "offer_bk", "left").select(
        "view_datetime_sydt", F.col("session_id").alias("domain_sessionid"), F.col("identity").alias("customer_bk"),
        "offer_bk", "subscriber_key", "country_code", "offer_type")


def _paths_sql(kind_filter: str) -> str:
    k = "json_extract_string(props, '$.k')"
    return f"""
WITH raw AS (SELECT ts AS time, user_id, CAST(ts AS DATE) AS session_id, event_id,
                    {_PATH_SQL.format(k=k)} AS path, {_KIND_SQL} AS event_view_name FROM events),
sessions AS (
  SELECT time, user_id, session_id, event_id,
         CASE WHEN len(string_split(path, '/')) = 6 THEN string_split(path, '/')[-2]
              ELSE string_split(path, '/')[-1] END AS offer_bk,
         CASE WHEN contains(path, 'checkout') THEN 'checkout'
              WHEN contains(path, 'offer') OR contains(path, 'partner') THEN 'page_view'
              WHEN contains(path, 'booking') THEN 'booking' END AS event_type
    FROM raw
   WHERE {kind_filter} time >= TIMESTAMP '{START}' AND time < TIMESTAMP '{END}'
     AND (contains(path, 'checkout') OR contains(path, 'offer') OR contains(path, 'partner') OR contains(path, 'booking'))
     AND session_id IS NOT NULL AND user_id IS NOT NULL
), cand AS (
  SELECT *, LEAD(event_type) OVER (PARTITION BY user_id, session_id ORDER BY time, event_id) AS next_event_type
    FROM sessions
), av AS (
  SELECT MAX(timezone('{SYDNEY}', timezone('UTC', time))) AS view_datetime_sydt, session_id AS domain_sessionid,
         u.c_name AS customer_bk, offer_bk, d.c_mktsegment AS subscriber_key
    FROM cand JOIN customer u ON u.c_custkey = cand.user_id
    LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 0) d ON d.c_name = u.c_name
   WHERE event_type = 'page_view' AND next_event_type IN ('checkout', 'booking') AND offer_bk IS NOT NULL
   GROUP BY session_id, u.c_name, offer_bk, d.c_mktsegment
)
SELECT av.*, p.p_brand AS country_code, p.p_type AS offer_type
  FROM av LEFT JOIN part p ON av.offer_bk = CAST(p.p_partkey AS VARCHAR)
"""


@query("abandoned_views_paths", _paths_sql(""))
def abandoned_views_paths(spark, sf):
    return abandoned_from_paths(spark, sf, raw_pageviews(spark, sf))


@query("abandoned_views_events", _paths_sql("event_view_name = 'pageviews' AND"))
def abandoned_views_events(spark, sf):
    pv = in_list_filter(raw_pageviews(spark, sf), "event_view_name", ["pageviews"])
    return abandoned_from_paths(spark, sf, pv)


@query("context_views_export", """
SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS day FROM events
 WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-17'
""")
def context_views_export(spark, sf):
    """Daily range export of whole days (the last one, cut at noon, is left to a later run) in two runs, then all day
    files packed by size into one Parquet output."""
    daily, compact = scratch_path(spark, "ctx-daily"), scratch_path(spark, "ctx-compact")
    e = t(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    sinks.export_daily_incremental(e, "ts", "2024-01-03 00:00:00", "2024-01-10 00:00:00", daily)
    sinks.export_daily_incremental(e, "ts", "2024-01-03 00:00:00", "2024-01-17 12:00:00", daily)
    sinks.compact_files(spark, daily, compact)
    return spark.read.parquet(compact).select("event_id", "user_id", "event_type", "ts", F.col("day").cast("date"))


@query("offer_types_sample", """
SELECT event_id, CAST(json(props) AS VARCHAR) AS holiday_types FROM events WHERE props IS NOT NULL
 ORDER BY event_id LIMIT 3
""")
def offer_types_sample(spark, sf):
    e = t(spark, sf, "events").where(F.col("props").isNotNull())
    return e.orderBy("event_id").limit(3).select("event_id", parse_json_text("props").alias("holiday_types"))


_COQ = ("SELECT p.p_brand || ' ' || p.p_type AS country, l.l_partkey AS offer, "
        "CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS cost_per_night "
        "FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey")


def _qsql(expr: str) -> str:
    return ", ".join(f"round(quantile_cont({expr}, {q}), 6) AS {agg.qname(q)}" for q in agg.QUANTILES)


@query("country_offer_quantiles", f"""
WITH d AS ({_COQ}),
     c AS (SELECT country, COUNT(DISTINCT offer) AS offers FROM d WHERE offer IS NOT NULL GROUP BY country),
     own AS (SELECT country, {_qsql('cost_per_night')} FROM d GROUP BY country),
     g AS (SELECT {_qsql('cost_per_night')} FROM d)
SELECT c.country, c.offers,
       {", ".join(f"CASE WHEN c.offers > 10 THEN own.{agg.qname(q)} ELSE g.{agg.qname(q)} END AS {agg.qname(q)}"
                  for q in agg.QUANTILES)}
  FROM c LEFT JOIN own ON c.country = own.country, g
""")
def country_offer_quantiles(spark, sf):
    """Cost per night quantiles per country (brand and type): own quantiles for countries with more than 10
    distinct offers, the global ones otherwise."""
    li, p = t(spark, sf, "lineitem"), t(spark, sf, "part")
    d = li.join(p, p.p_partkey == li.l_partkey).select(
        F.concat_ws(" ", "p_brand", "p_type").alias("country"), F.col("l_partkey").alias("offer"),
        F.try_divide("l_extendedprice", "l_quantity").alias("cost_per_night"))
    r = agg.group_quantiles_fallback(d, "country", "cost_per_night", "offer", 10)
    names = {agg.qname(q) for q in agg.QUANTILES}
    return r.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in r.columns])


@query("mariadb_schema_dump", """
WITH cols AS (
  SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS table_name, 'c' || CAST(l_linenumber AS VARCHAR) || '_' ||
         CAST(l_partkey AS VARCHAR) AS name,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 25 THEN 'precision_datetime'
              WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'datetime'
              WHEN l_returnflag = 'N' THEN 'varchar' WHEN l_returnflag = 'A' THEN 'decimal' ELSE 'text' END AS data_type,
         l_linenumber AS ordinal_position, CASE WHEN l_linenumber = 1 THEN 'PRI' ELSE '' END AS column_key,
         l_quantity
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
   WHERE o.o_orderpriority <> '5-LOW')
SELECT table_name,
       CAST(to_json(list({'name': name, 'data_type': data_type,
                     'data_length': CASE WHEN data_type = 'varchar' THEN CAST(CAST(l_quantity AS INT) * 10 AS VARCHAR)
                                         WHEN data_type = 'text' THEN '4000' WHEN data_type = 'decimal' THEN '(12,2)'
                                         ELSE '' END,
                     'ordinal_position': ordinal_position, 'column_key': column_key}
                    ORDER BY ordinal_position, name, data_type, l_quantity)) AS VARCHAR) AS columns
  FROM cols GROUP BY table_name
""")
def mariadb_schema_dump(spark, sf):
    """information_schema (base tables = orders not of priority 5-LOW) joined to columns, precision datetimes
    classified, lengths derived per type, and one JSON column list per table ordered by position."""
    from tidewater.operators.joins import metadata_join
    li, o = t(spark, sf, "lineitem"), t(spark, sf, "orders")
    tables = o.select(F.lit("shop").alias("table_schema"),
                      F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("table_name"),
                      F.when(F.col("o_orderpriority") == "5-LOW", "VIEW").otherwise("BASE TABLE").alias("table_type"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    dtype = case_classify([((rf == "R") & (ls == "F") & (F.col("l_quantity") > 25), F.lit("precision_datetime")),
                           ((rf == "R") & (ls == "F"), F.lit("datetime")), (rf == "N", F.lit("varchar")),
                           (rf == "A", F.lit("decimal"))], F.lit("text"))
    cols = li.select(F.lit("shop").alias("table_schema"),
                     F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("table_name"),
                     F.concat(F.lit("c"), F.col("l_linenumber").cast("string"), F.lit("_"),
                              F.col("l_partkey").cast("string")).alias("name"),
                     dtype.alias("data_type"), F.col("l_linenumber").alias("ordinal_position"),
                     F.when(F.col("l_linenumber") == 1, "PRI").otherwise("").alias("column_key"), "l_quantity")
    j = metadata_join(tables, cols, "shop")
    dt = F.col("data_type")
    j = j.withColumn("data_length", F.when(dt == "varchar", (F.col("l_quantity").cast("int") * 10).cast("string"))
                     .when(dt == "text", "4000").when(dt == "decimal", "(12,2)").otherwise(""))
    return agg.json_group_concat(j, ["table_name"], ["name", "data_type", "data_length", "ordinal_position",
                                                     "column_key"], "ordinal_position")


@query("heavy_query_report", _QH_SQL + """
SELECT CAST(row_number() OVER (ORDER BY submitted, QueryExecutionId) - 1 AS BIGINT) AS id,
       QueryExecutionId AS query_id, state, scanned AS scanned_bytes, COALESCE(engine_ms, -1) AS engine_ms,
       submitted
  FROM qh""" + _QH_WHERE)
def heavy_query_report(spark, sf):
    """Heavy finished queries of the last year: filtered, flattened with defaults, numbered in submission order,
    written to Parquet and read back."""
    q = filter_query_log(_query_history(spark, sf), "Status.State", "Statistics.DataScannedInBytes",
                         "Status.SubmissionDateTime", "1998-08-01 00:00:00", 525600)
    flat = flatten_nested(q, {"query_id": "QueryExecutionId", "state": "Status.State",
                              "scanned_bytes": "Statistics.DataScannedInBytes",
                              "engine_ms": "Statistics.EngineExecutionTimeInMillis",
                              "submitted": "Status.SubmissionDateTime"})
    ided = assign_ids(flat, ["submitted", "query_id"], "id")
    out = scratch_path(spark, "query-stats")
    ided.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).select("id", "query_id", "state", "scanned_bytes", "engine_ms", "submitted")


@query("query_stats_export", _QH_SQL + """
SELECT CAST(row_number() OVER (ORDER BY QueryExecutionId) - 1 AS BIGINT) AS id, QueryExecutionId AS query_id, state,
       scanned AS scanned_bytes, COALESCE(engine_ms, -1) AS engine_ms, db AS database
  FROM qh
""")
def query_stats_export(spark, sf):
    """The whole query history flattened (missing numbers as -1), numbered in id order and exported to Parquet."""
    flat = flatten_nested(_query_history(spark, sf), {
        "query_id": "QueryExecutionId", "state": "Status.State", "scanned_bytes": "Statistics.DataScannedInBytes",
        "engine_ms": "Statistics.EngineExecutionTimeInMillis", "database": "QueryExecutionContext.Database"})
    out = scratch_path(spark, "query-stats-all")
    sinks.export_table(assign_ids(flat, ["query_id"], "id"), out, "parquet")
    return spark.read.parquet(out).select("id", "query_id", "state", "scanned_bytes", "engine_ms", "database")


_CFG_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{v}')" for a, b, c, v in flatten_config(EVENT_CONFIG))


@query("conversion_replay", f"""
WITH dates AS (SELECT CAST(d AS DATE) AS run_date FROM (SELECT unnest(generate_series(DATE '1997-03-01',
                                                        DATE '1997-03-10', INTERVAL 1 DAY)) AS d)),
     conv AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS product, o_orderpriority AS sub_type,
                     CASE WHEN o_totalprice > 100000 THEN 'premium' ELSE 'standard' END AS rate_plan FROM orders),
     runs AS (SELECT d.run_date, c.*, TRUE AS report_click FROM dates d JOIN conv c ON c.day = d.run_date
              UNION ALL
              SELECT d.run_date, c.*, FALSE FROM dates d JOIN conv c ON c.day = d.run_date - 17),
     j AS (SELECT r.*, cfg.event_id FROM runs r
             LEFT JOIN (VALUES {_CFG_VALUES}) cfg(product, sub_type, rate_plan, event_id)
               ON r.product = cfg.product AND r.sub_type = cfg.sub_type AND r.rate_plan = cfg.rate_plan)
SELECT run_date, o_orderkey, 1 AS step, 'click' AS kind, CAST(NULL AS VARCHAR) AS event_id FROM j WHERE report_click
UNION ALL
SELECT run_date, o_orderkey, 2, 'event', event_id FROM j
""")
def conversion_replay(spark, sf):
    """For each run date, that day's conversions with click requests and the conversions of 17 days earlier without;
    the request table of every run (the date series is a small generated table joined on the day)."""
    dates = spark.range(1).select(F.explode(F.sequence(F.lit("1997-03-01").cast("date"),
                                                       F.lit("1997-03-10").cast("date"))).alias("run_date"))
    conv = t(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("product"),
        F.col("o_orderpriority").alias("sub_type"),
        F.when(F.col("o_totalprice") > 100000, "premium").otherwise("standard").alias("rate_plan"))
    same = dates.join(conv, conv.day == dates.run_date).withColumn("report_click", F.lit(True))
    back = dates.join(conv, conv.day == F.date_sub(dates.run_date, 17)).withColumn("report_click", F.lit(False))
    runs = same.unionByName(back).withColumn("rec", F.struct("run_date", "o_orderkey"))
    cfg = F.broadcast(spark.createDataFrame(flatten_config(EVENT_CONFIG), "product string, sub_type string, "
                                                                          "rate_plan string, event_id string"))
    req = api.request_table(runs, cfg, ["product", "sub_type", "rate_plan"], "report_click", "rec")
    return req.select("rec.run_date", "rec.o_orderkey", "step", "kind", "event_id")


# §2.10 user-function surface

def _priority_rank(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.copy()
    pdf["priority_rank"] = pdf["o_orderpriority"].str.slice(0, 1).astype("int32")
    return pdf[["o_orderkey", "priority_rank"]]


@query("udf_record_transform", """
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank FROM orders
""")
def udf_record_transform(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return uf.map_frames(o, _priority_rank, "o_orderkey BIGINT, priority_rank INT")


@query("udf_filter", "SELECT p_partkey, p_name FROM part WHERE p_size > 30")
def udf_filter(spark, sf):
    p = t(spark, sf, "part")
    return uf.apply_filter(uf.apply_filter(p), lambda d: d.where("p_size > 30")).select("p_partkey", "p_name")


class ModelV0(uf.Model):
    version, model_type = 0, None


class ModelV1(uf.Model):
    version, model_type = 1, "random_forest"


class ModelV2(uf.Model):
    version, model_type = 2, "lightgbm"


for _m in (ModelV0(), ModelV1(), ModelV2()):
    uf.register(_m)


@query("model_interface", """
SELECT c_custkey AS user_id, c_nationkey AS platform, m.model_type, m.model_version
  FROM customer, (VALUES (NULL, 0), ('random_forest', 1), ('lightgbm', 2)) m(model_type, model_version)
""")
def model_interface(spark, sf):
    """The inference frame (customers) scored by every registered model version, tagged with type and version."""
    df = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("platform"))
    out = None
    for v in sorted(uf.REGISTRY):
        r = uf.recommend(df, v)
        out = r if out is None else out.unionByName(r)
    return out
