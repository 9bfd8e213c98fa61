"""Joins bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import joins as op
from tidewater.operators.windows import assign_chunk
from tidewater.plans.common import t
from tidewater.plans.registry import query


@query("hash_join", """
SELECT c.c_custkey, c.c_name, c.nk AS c_nationkey, n.nk AS n_nationkey, n.n_name
  FROM (SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS nk FROM customer) c
  JOIN (SELECT nullif(n_nationkey, 3) AS nk, n_name FROM nation) n ON c.nk IS NOT DISTINCT FROM n.nk
""")
def hash_join(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"))
    n = t(spark, sf, "nation").select(F.nullif("n_nationkey", F.lit(3)).alias("n_nationkey"), "n_name")
    j = op.hash_join(c, "c_nationkey", n, "n_nationkey")
    return j.select("left.c_custkey", "left.c_name", "left.c_nationkey", "right.n_nationkey", "right.n_name")


@query("multi_key_join", """
WITH cand AS (SELECT event_id, ts, user_id, CAST(ts AS DATE) AS session_date FROM events)
SELECT ce.event_id, e.value, e.props
  FROM cand ce JOIN events e
    ON ce.user_id = e.user_id AND ce.ts = e.ts AND ce.session_date = CAST(e.ts AS DATE) AND ce.event_id = e.event_id
""")
def multi_key_join(spark, sf):
    ce = t(spark, sf, "events").select("event_id", "ts", "user_id", F.to_date("ts").alias("session_date"))
    e = t(spark, sf, "events").withColumn("e_date", F.to_date("ts"))
    j = op.multi_key_join(ce, e, [("user_id", "user_id"), ("ts", "ts"), ("session_date", "e_date"),
                                  ("event_id", "event_id")])
    return j.select(ce.event_id, e.value, e.props)


@query("using_join", """
SELECT o.o_orderkey, c.c_name, c.c_mktsegment
  FROM (SELECT o_orderkey, o_custkey AS custkey FROM orders) o
  JOIN (SELECT c_custkey AS custkey, c_name, c_mktsegment FROM customer) c USING (custkey)
""")
def using_join(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return op.using_join(o, c, "custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query("left_join_enrich", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
  FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
""")
def left_join_enrich(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = t(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    return op.left_join_enrich(o, c, "o_custkey", "c_custkey")


@query("identity_bridge_join", """
SELECT e.event_id, u.c_name AS identity, d.c_mktsegment AS segment
  FROM events e
  JOIN customer u ON u.c_custkey = e.user_id
  LEFT JOIN (SELECT c_name, c_mktsegment FROM customer WHERE c_nationkey <> 0) d ON d.c_name = u.c_name
""")
def identity_bridge_join(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id")
    users = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("identity"))
    dim = t(spark, sf, "customer").where("c_nationkey <> 0").select(F.col("c_name").alias("identity"),
                                                                   F.col("c_mktsegment").alias("segment"))
    return op.using_join(op.using_join(e, users, "user_id"), dim, "identity", "left").select(
        "event_id", "identity", "segment")


@query("lateral_unnest", """
SELECT lang, word, COUNT(*) AS n
  FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
 GROUP BY lang, word
""")
def lateral_unnest(spark, sf):
    d = t(spark, sf, "documents").select("lang", F.explode(F.split("text", " ", -1)).alias("word"))
    return d.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query("cross_product", """
SELECT n_nationkey, hour, flag
  FROM nation
  CROSS JOIN (SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS hour)
  CROSS JOIN (SELECT unnest([0, 1]) AS flag)
""")
def cross_product(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey")
    return op.cross_product(n, hour=list(range(0, 24)), flag=[0, 1])


@query("anti_join_missing", """
SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)
""")
def anti_join_missing(spark, sf):
    """Catalog entries (customers) that have no data files (events)."""
    return op.anti_join_missing(t(spark, sf, "customer").select("c_custkey"), t(spark, sf, "events"),
                                "c_custkey", "user_id")


@query("insert_if_absent", """
WITH target AS (SELECT DISTINCT user_id, 'signup' AS source FROM events WHERE event_type = 'signup'),
     fresh AS (SELECT DISTINCT user_id, 'purchase' AS source FROM events WHERE event_type = 'purchase')
SELECT * FROM target
UNION ALL
SELECT * FROM fresh WHERE user_id NOT IN (SELECT user_id FROM target)
""")
def insert_if_absent(spark, sf):
    e = t(spark, sf, "events")
    target = e.where("event_type = 'signup'").select("user_id", F.lit("signup").alias("source")).distinct()
    fresh = e.where("event_type = 'purchase'").select("user_id", F.lit("purchase").alias("source"))
    return op.insert_if_absent(target, fresh, ["user_id"])


@query("skip_materialized", """
SELECT o_orderkey FROM orders
 WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def skip_materialized(spark, sf):
    wanted = t(spark, sf, "orders").select("o_orderkey")
    done = t(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return op.skip_materialized(wanted, done, "o_orderkey")


# saved definitions: per order, the sorted part keys of its lines; current: lines with quantity > 5 only, for
# orders placed before 2000 (later orders are "new" tables).
@query("schema_diff", """
WITH saved AS (SELECT l_orderkey AS name, list_sort(list(l_partkey)) AS cols FROM lineitem GROUP BY l_orderkey),
     cur AS (SELECT l.l_orderkey AS name, list_sort(list(l.l_partkey) FILTER (WHERE l.l_quantity > 5)) AS cols
               FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
              WHERE o.o_orderdate < TIMESTAMP '2000-01-01' GROUP BY l.l_orderkey)
SELECT COALESCE(s.name, c.name) AS name,
       CASE WHEN c.name IS NULL THEN 'create' WHEN s.name IS NULL THEN 'drop'
            WHEN s.cols IS NOT DISTINCT FROM c.cols THEN 'skip' ELSE 'update' END AS action
  FROM saved s FULL OUTER JOIN cur c ON s.name = c.name
""")
def schema_diff(spark, sf):
    li = t(spark, sf, "lineitem")
    o = t(spark, sf, "orders")
    saved = li.groupBy(F.col("l_orderkey").alias("name")).agg(F.collect_list("l_partkey").alias("cols"))
    cur = li.join(o.where("o_orderdate < TIMESTAMP'2000-01-01'"), li.l_orderkey == o.o_orderkey) \
        .groupBy(F.col("l_orderkey").alias("name")) \
        .agg(F.collect_list(F.when(F.col("l_quantity") > 5, F.col("l_partkey"))).alias("cols"))
    return op.schema_diff(saved, cur, "name")


# config: product (order status) -> subscription type (priority) -> rate plan (price band) -> event id
EVENT_CONFIG = {
    "F": {"1-URGENT": {"premium": "101", "standard": "102"}, "2-HIGH": {"premium": "103"}},
    "O": {"1-URGENT": {"standard": "201"}, "3-MEDIUM": {"premium": "202", "standard": "203"}},
    "P": {"5-LOW": {"standard": "301"}},
}
_CONFIG_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{v}')" for a, b, c, v in op.flatten_config(EVENT_CONFIG))


@query("lookup_nested_config", f"""
SELECT o.o_orderkey, cfg.event_id
  FROM (SELECT o_orderkey, o_orderstatus AS product, o_orderpriority AS sub_type,
               CASE WHEN o_totalprice > 100000 THEN 'premium' ELSE 'standard' END AS rate_plan FROM orders) o
  LEFT JOIN (VALUES {_CONFIG_VALUES}) cfg(product, sub_type, rate_plan, event_id)
    ON o.product = cfg.product AND o.sub_type = cfg.sub_type AND o.rate_plan = cfg.rate_plan
""")
def lookup_nested_config(spark, sf):
    o = t(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("product"), F.col("o_orderpriority").alias("sub_type"),
        F.when(F.col("o_totalprice") > 100000, "premium").otherwise("standard").alias("rate_plan"))
    # a fixed literal config of a few rows: a proven size bound, so it is broadcast
    cfg = F.broadcast(spark.createDataFrame(op.flatten_config(EVENT_CONFIG), "product string, sub_type string, "
                                                                              "rate_plan string, event_id string"))
    return op.lookup_nested_config(o, cfg, ["product", "sub_type", "rate_plan"], "event_id", "event_id") \
        .select("o_orderkey", "event_id")


@query("adjacent_chunk_edges", """
WITH tasks AS (SELECT s_name AS task, (row_number() OVER (ORDER BY s_suppkey) - 1) // 13 AS chunk FROM supplier)
SELECT 'root' AS src, task AS dst FROM tasks WHERE chunk = 0
UNION ALL
SELECT a.task AS src, b.task AS dst FROM tasks a JOIN tasks b ON b.chunk = a.chunk + 1
""")
def adjacent_chunk_edges(spark, sf):
    s = assign_chunk(t(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], 13)
    return op.adjacent_chunk_edges(s, "s_name", "chunk", "root")


@query("override_config", """
WITH base AS (SELECT c_custkey AS key, c_nationkey AS value FROM customer),
     ov AS (SELECT c_custkey AS key, -c_nationkey - 1 AS new_value FROM customer WHERE c_acctbal > 5000
            UNION ALL SELECT s_suppkey + 1000000000 AS key, 1 AS new_value FROM supplier)
SELECT b.key, CASE WHEN b.value IS NOT NULL AND b.value <> 0 AND ov.new_value IS NOT NULL THEN ov.new_value
                   ELSE b.value END AS value
  FROM base b LEFT JOIN ov ON b.key = ov.key
""")
def override_config(spark, sf):
    base = t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("value"))
    ov = t(spark, sf, "customer").where("c_acctbal > 5000").select(
        F.col("c_custkey").alias("key"), (-F.col("c_nationkey") - 1).alias("value")).unionByName(
        t(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000000).alias("key"), F.lit(1).alias("value")))
    return op.override_config(base, ov, "key", "value")


ALERT_RULES = [("view", "task_1", 8, 20), ("click", "task_2", None, None), ("error", "task_3", 0, 6),
               ("purchase", "task_1", 12, 12)]
_RULE_VALUES = ", ".join(
    f"('{d}', '{k}', {('NULL' if a is None else a)}, {('NULL' if b is None else b)})" for d, k, a, b in ALERT_RULES)


@query("alert_routing", f"""
WITH alerts AS (SELECT event_id, event_type AS dag_id, 'task_' || CAST(user_id % 4 AS VARCHAR) AS task_id,
                       CAST(hour(ts) AS INTEGER) AS hour FROM events),
     rules(dag_id, task_id, hour_from, hour_to) AS (VALUES {_RULE_VALUES})
SELECT a.event_id, a.dag_id, a.task_id, a.hour FROM alerts a
 WHERE EXISTS (SELECT 1 FROM rules r WHERE r.dag_id = a.dag_id AND r.task_id = a.task_id
                  AND a.hour BETWEEN COALESCE(r.hour_from, a.hour) AND COALESCE(r.hour_to, a.hour))
    OR (a.task_id IN ('task_0') AND EXISTS (SELECT 1 FROM rules r WHERE r.dag_id = a.dag_id)
        AND NOT EXISTS (SELECT 1 FROM rules r WHERE r.dag_id = a.dag_id AND r.task_id = a.task_id))
""")
def alert_routing(spark, sf):
    alerts = t(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("dag_id"),
        F.concat(F.lit("task_"), (F.col("user_id") % 4).cast("string")).alias("task_id"), F.hour("ts").alias("hour"))
    rules = F.broadcast(spark.createDataFrame(ALERT_RULES, "dag_id string, task_id string, hour_from int, "
                                                           "hour_to int"))
    return op.alert_routing(alerts, rules, ["task_0"])
