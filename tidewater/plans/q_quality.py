"""Data quality and monitoring bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import quality as op
from tidewater.plans.common import t
from tidewater.plans.registry import query

AS_OF = "2024-01-31 12:00:00"


def _checks(spark, sf):
    o = t(spark, sf, "orders")
    e = t(spark, sf, "events")
    return [
        op.Check("orders_recent_not_empty", o, F.count(F.when(F.col("o_orderdate") >= F.lit("2001-01-01")
                                                              .cast("timestamp_ntz"), 1)), op.GREATER_THAN, 0),
        op.Check("orders_no_null_fields", o, op.any_null_count(o, ["o_custkey", "o_orderpriority", "o_totalprice"]),
                 op.LESS_THAN, 0),
        op.Check("orders_finished_share", o, F.avg(F.when(F.col("o_orderstatus") == "F", 100.0).otherwise(0.0)),
                 op.GREATER_THAN_OR_EQUAL, 65),
        op.Check("events_click_to_view_ratio", e,
                 F.try_divide(F.count(F.when(F.col("event_type") == "click", 1)) * 100.0,
                              F.count(F.when(F.col("event_type") == "view", 1))), op.GREATER_THAN_OR_EQUAL, 50),
    ]


_CHECKS_SQL = """
SELECT 'orders_recent_not_empty' AS task_id, CAST(COUNT(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-01-01') AS DOUBLE)
       AS value, CAST(0.0 AS DOUBLE) AS threshold,
       COALESCE(COUNT(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-01-01') > 0, FALSE) AS passed FROM orders
UNION ALL
SELECT 'orders_no_null_fields', CAST(v AS DOUBLE), 0.0, COALESCE(v < 0, FALSE)
  FROM (SELECT CASE WHEN COUNT(*) FILTER (WHERE o_custkey IS NULL OR o_orderpriority IS NULL OR o_totalprice IS NULL) = 0
                    THEN -1 ELSE COUNT(*) FILTER (WHERE o_custkey IS NULL OR o_orderpriority IS NULL
                                                  OR o_totalprice IS NULL) END AS v FROM orders)
UNION ALL
SELECT 'orders_finished_share', round(v, 6), 65.0, COALESCE(v >= 65, FALSE)
  FROM (SELECT AVG(CASE WHEN o_orderstatus = 'F' THEN 100.0 ELSE 0.0 END) AS v FROM orders)
UNION ALL
SELECT 'events_click_to_view_ratio', round(v, 6), 50.0, COALESCE(v >= 50, FALSE)
  FROM (SELECT CASE WHEN COUNT(*) FILTER (WHERE event_type = 'view') = 0 THEN NULL
                    ELSE COUNT(*) FILTER (WHERE event_type = 'click') * 100.0 / COUNT(*) FILTER (WHERE event_type = 'view')
               END AS v FROM events)
"""


def _round(df, cols=("value",)):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("threshold_checks", _CHECKS_SQL)
def threshold_checks(spark, sf):
    return _round(op.threshold_checks(_checks(spark, sf)))


@query("health_checks", """
SELECT 'orders_all_finished' AS task_id, CAST(COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) AS value,
       CAST(0.0 AS DOUBLE) AS threshold, COUNT(*) FILTER (WHERE o_orderstatus <> 'F') = 0 AS passed,
       'exact' AS check_type FROM orders
UNION ALL
SELECT 'max_lines_per_order', CAST(MAX(n) AS DOUBLE), 7.0, MAX(n) <= 7 AND MAX(n) >= 0, 'range'
  FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
UNION ALL
SELECT 'max_returned_quantity', CAST(COALESCE(MAX(q), 0) AS DOUBLE), 2000.0,
       COALESCE(MAX(q), 0) <= 2000 AND COALESCE(MAX(q), 0) >= 0, 'range'
  FROM (SELECT SUM(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey)
""")
def health_checks(spark, sf):
    o = t(spark, sf, "orders")
    li = t(spark, sf, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    returned = li.where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    return op.health_checks([
        ("orders_all_finished", o, F.count(F.when(F.col("o_orderstatus") != "F", 1)), "exact", 0),
        ("max_lines_per_order", per_order, F.max("n"), "range", 7),
        ("max_returned_quantity", returned, F.coalesce(F.max("q"), F.lit(0.0)), "range", 2000),
    ])


@query("freshness_monitor", f"""
WITH m AS (
  SELECT 'orders' AS "table", MAX(o_orderdate) AS latest, 72 AS target_hours FROM orders
  UNION ALL SELECT 'lineitem_returns', MAX(l_shipdate), 72 FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'events', MAX(ts), 26 FROM events
  UNION ALL SELECT 'events_errors_future', MAX(ts), 3 FROM events WHERE event_type = 'error' AND ts > TIMESTAMP '2030-01-01')
SELECT "table", latest,
       CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(latest)) / 3600000000.0) AS BIGINT) AS lag_hours,
       target_hours,
       COALESCE(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(latest)) / 3600000000.0) > target_hours, TRUE) AS late
  FROM m
""")
def freshness_monitor(spark, sf):
    return op.freshness_monitor([
        ("orders", t(spark, sf, "orders"), "o_orderdate", None, 72),
        ("lineitem_returns", t(spark, sf, "lineitem"), "l_shipdate", F.col("l_returnflag") == "R", 72),
        ("events", t(spark, sf, "events"), "ts", None, 26),
        ("events_errors_future", t(spark, sf, "events"), "ts",
         (F.col("event_type") == "error") & (F.col("ts") > F.lit("2030-01-01").cast("timestamp_ntz")), 3),
    ], AS_OF)


@query("funnel_ratio_check", """
SELECT c.c_mktsegment AS client_type, e.event_type = 'purchase' AS paywall_b,
       COUNT(*) FILTER (WHERE e.event_type IN ('view', 'purchase')) AS shown,
       COUNT(*) FILTER (WHERE e.event_type = 'click') AS clicked,
       round(CASE WHEN COUNT(*) FILTER (WHERE e.event_type IN ('view', 'purchase')) = 0 THEN NULL
             ELSE COUNT(*) FILTER (WHERE e.event_type = 'click') * 100.0
                  / COUNT(*) FILTER (WHERE e.event_type IN ('view', 'purchase')) END, 6) AS ratio,
       COALESCE(COUNT(*) FILTER (WHERE e.event_type = 'click') * 100.0
                / nullif(COUNT(*) FILTER (WHERE e.event_type IN ('view', 'purchase')), 0) >= 50, FALSE) AS passed
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
 WHERE e.event_type IN ('view', 'click', 'purchase')
 GROUP BY 1, 2
""")
def funnel_ratio_check(spark, sf):
    """Click / shown ratio by client type (market segment) and paywall group, against 50."""
    e = t(spark, sf, "events").where(F.col("event_type").isin("view", "click", "purchase"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("client_type"))
    j = e.join(c, "user_id").withColumn("paywall_b", F.col("event_type") == "purchase") \
        .withColumn("kind", F.when(F.col("event_type").isin("view", "purchase"), "shown").otherwise("clicked"))
    r = op.funnel_ratio(j, ["client_type", "paywall_b"], "kind", "shown", "clicked", 50.0)
    return r.withColumn("ratio", F.round("ratio", 6))


@query("notify_messages", """
SELECT task_id, ':no_entry: ' || task_id || ' failed (value ' || CAST(value AS VARCHAR) || ')! Environment: *prod*, '
       || 'Execution Date: 2024-01-31' AS message
  FROM (SELECT 'orders_all_finished' AS task_id, CAST(COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) AS value,
               COUNT(*) FILTER (WHERE o_orderstatus <> 'F') = 0 AS passed FROM orders)
 WHERE NOT passed
""")
def notify_messages(spark, sf):
    o = t(spark, sf, "orders")
    res = op.health_checks([("orders_all_finished", o, F.count(F.when(F.col("o_orderstatus") != "F", 1)), "exact", 0)])
    return op.notify_messages(res, ":no_entry: {task_id} failed (value {value})! Environment: *{env}*, "
                                   "Execution Date: {ds}", env="prod", ds="2024-01-31")
