"""Window-style operators and sorts / set operations (§2.6, §2.7) bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import sets as so
from tidewater.operators import windows as op
from tidewater.plans.common import t
from tidewater.plans.registry import query
from tidewater.session import scratch_path


@query("lead_event", """
SELECT event_id, LEAD(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS next_type
  FROM events
""")
def lead_event(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("session_date"))
    return op.lead_event(e, ["user_id", "session_date"], ["ts", "event_id"], "event_type", "next_type") \
        .select("event_id", "next_type")


@query("forward_fill", """
SELECT event_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM events
""")
def forward_fill(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts",
                                      F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return op.forward_fill(e, ["user_id"], ["ts", "event_id"], "value").select("event_id", "value")


@query("retain_last_n", """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rk FROM orders)
 WHERE rk > 5
""")
def retain_last_n(spark, sf):
    """Versions (orders) of each table (customer) beyond the newest 5: the drop plan."""
    o = t(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return op.retain_last_n(o, ["o_custkey"], "o_orderkey", n=5).select("o_custkey", "o_orderkey")


@query("assign_chunk", """
SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS BIGINT) AS chunk FROM customer
""")
def assign_chunk(spark, sf):
    return op.assign_chunk(t(spark, sf, "customer").select("c_custkey"), ["c_custkey"], 100)


@query("assign_ids", """
SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS id FROM events
""")
def assign_ids(spark, sf):
    return op.assign_ids(t(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "id")


# §2.6 sorts and limits

@query("order_by", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey")
def order_by(spark, sf):
    return so.order_by(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query("priority_sort", """
SELECT s.s_name, CASE WHEN p.name IS NOT NULL THEN 10 ELSE 1 END AS weight
  FROM supplier s LEFT JOIN (SELECT DISTINCT s_name AS name FROM supplier WHERE s_nationkey IN (1, 2)) p
    ON s.s_name = p.name
 ORDER BY weight DESC, s.s_suppkey
""")
def priority_sort(spark, sf):
    s = t(spark, sf, "supplier")
    prio = s.where("s_nationkey IN (1, 2)").select("s_name")
    return so.priority_sort(s.select("s_suppkey", "s_name"), "s_name", prio, "s_name", "s_suppkey") \
        .select("s_name", "weight")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def limit_n(spark, sf):
    return so.limit_n(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 3,
                      F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("last_by_key", """
SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS last_status FROM orders GROUP BY o_custkey
""")
def last_by_key(spark, sf):
    return so.last_by_key(t(spark, sf, "orders"), "o_orderstatus", "o_orderkey", ["o_custkey"], "last_status")


@query("offset_page", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def offset_page(spark, sf):
    return so.offset_page(t(spark, sf, "orders").select("o_orderkey"), 100, 50, "o_orderkey")


@query("offset_page_directory", """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
                ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 40 OFFSET 50000)
UNION ALL
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
                ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 40 OFFSET 12345)
""")
def offset_page_directory(spark, sf):
    """Two pages of the line items from one rank directory, each reading the ranges that hold its ranks."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    directory = so.RankDirectory(li, scratch_path(spark, "ranks"), *li.columns, ranges=32)
    return directory.page(50_000, 40).unionByName(directory.page(12_345, 40))


# §2.7 set operations

@query("union_all", """
SELECT c_custkey AS id, c_nationkey AS nationkey, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, 'supplier' FROM supplier
""")
def union_all(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
                                        F.lit("customer").alias("kind"))
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nationkey"),
                                        F.lit("supplier").alias("kind"))
    return so.union_all(c, s)


@query("set_union", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
""")
def set_union(spark, sf):
    return so.set_union(t(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")),
                        t(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey")))


@query("set_except", r"""
SELECT regexp_extract(url, '^(.*)/[^/]*$', 1) AS prefix FROM pages
EXCEPT SELECT regexp_extract(url, '^(.*)/[^/]*$', 1) FROM pages WHERE contains(url, 'blog')
""")
def set_except(spark, sf):
    p = t(spark, sf, "pages")
    keep = p.select(so.parent_prefix(F.col("url")).alias("prefix"))
    gone = p.where(F.col("url").contains("blog")).select(so.parent_prefix(F.col("url")).alias("prefix"))
    return so.set_except(keep, gone)


@query("distinct_prefixes", r"SELECT DISTINCT regexp_extract(url, '^(.*)/[^/]*$', 1) AS prefix FROM pages")
def distinct_prefixes(spark, sf):
    return so.distinct_prefixes(t(spark, sf, "pages"), "url")


_OPS = ("SELECT user_id AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS member, "
        "CASE WHEN event_type IN ('view', 'click') THEN 'add' WHEN event_type = 'purchase' THEN 'remove' "
        "ELSE 'look' END AS op, ts, event_id FROM events")


@query("keyed_set_ops", f"""
SELECT key, member FROM (
  SELECT key, member, op, row_number() OVER (PARTITION BY key, member ORDER BY ts DESC, event_id DESC) AS rk
    FROM ({_OPS}) WHERE op <> 'look')
 WHERE rk = 1 AND op = 'add'
""")
def keyed_set_ops(spark, sf):
    """Viewed/clicked offers add to a user's set, a purchase removes it, other events look; current members per user."""
    e = t(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.get_json_object("props", "$.k").cast("bigint").alias("member"),
        F.when(F.col("event_type").isin("view", "click"), "add").when(F.col("event_type") == "purchase", "remove")
        .otherwise("look").alias("op"), "ts", "event_id")
    return so.keyed_set_state(e, "key", "member", "op", "ts", "event_id")
