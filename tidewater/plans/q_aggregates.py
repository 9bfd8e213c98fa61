"""Aggregations bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import aggregates as op
from tidewater.operators import sketches as sk
from tidewater.operators.sets import parent_prefix
from tidewater.plans.common import t
from tidewater.plans.registry import query

Q = op.QUANTILES


def _qsql(expr: str) -> str:
    return ", ".join(f"round(quantile_cont({expr}, {q}), 6) AS {op.qname(q)}" for q in Q)


def _round_q(df, probs=Q):
    return df.select(*[F.round(c, 6).alias(c) if c in {op.qname(q) for q in probs} else F.col(c) for c in df.columns])


@query("group_count_distinct", """
SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS n_distinct FROM orders
 WHERE o_orderpriority IS NOT NULL AND o_custkey IS NOT NULL GROUP BY o_orderpriority
""")
def group_count_distinct(spark, sf):
    return op.group_count_distinct(t(spark, sf, "orders"), ["o_orderpriority"], "o_custkey")


@query("global_quantiles", f"SELECT {_qsql('l_extendedprice / l_quantity')} FROM lineitem WHERE l_quantity <> 0")
def global_quantiles(spark, sf):
    li = t(spark, sf, "lineitem").select(F.try_divide("l_extendedprice", "l_quantity").alias("cost"))
    return _round_q(op.exact_quantiles(li, [], "cost"))


# per customer: own quantiles of event values when the customer met more than 10 distinct offers,
# the global quantiles otherwise
_VALUES = "SELECT user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS offer FROM events"


@query("group_quantiles_fallback", f"""
WITH p AS ({_VALUES}),
     c AS (SELECT user_id, COUNT(DISTINCT offer) AS offers FROM p WHERE offer IS NOT NULL GROUP BY user_id),
     own AS (SELECT user_id, {_qsql('value')} FROM p GROUP BY user_id),
     g AS (SELECT {_qsql('value')} FROM p)
SELECT c.user_id, c.offers,
       {", ".join(f"CASE WHEN c.offers > 10 THEN own.{op.qname(q)} ELSE g.{op.qname(q)} END AS {op.qname(q)}" for q in Q)}
  FROM c LEFT JOIN own ON c.user_id = own.user_id, g
""")
def group_quantiles_fallback(spark, sf):
    p = t(spark, sf, "events").select(
        "user_id", "value", F.get_json_object("props", "$.k").cast("bigint").alias("offer"))
    return _round_q(op.group_quantiles_fallback(p, "user_id", "value", "offer", 10))


@query("quantile_sketches", """
SELECT event_type, prob, COUNT(value) AS n, TRUE AS merged_within, TRUE AS one_pass_within
  FROM events, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS prob) GROUP BY event_type, prob
""")
def quantile_sketches(spark, sf):
    """Quantiles of values per event type from sketches per day, merged over all days, and from one pass over all: whether
    the exact rank of each answer is within the stated error (0.01) of the probability."""
    e = t(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    by_day = sk.quantile_sketches(e, ["event_type", "day"], "value", 0.01)
    found = {"merged": sk.merge_sketches(by_day, ["event_type"]), "one_pass": sk.quantile_sketches(e, ["event_type"], "value", 0.01)}
    within = [sk.rank_errors(e, sk.quantiles_of(s, ["event_type"]), ["event_type"], "value")
              .select("event_type", "prob", "n", (F.col("error") <= 0.01).alias(f"{name}_within")) for name, s in found.items()]
    return within[0].join(within[1].drop("n"), ["event_type", "prob"])


@query("session_group_max", """
SELECT user_id, CAST(ts AS DATE) AS session_date, event_type, MAX(ts) AS last_ts FROM events
 GROUP BY user_id, CAST(ts AS DATE), event_type
""")
def session_group_max(spark, sf):
    e = t(spark, sf, "events").withColumn("session_date", F.to_date("ts"))
    return op.session_group_max(e, ["user_id", "session_date", "event_type"], "ts", "last_ts")


@query("case_count", """
SELECT CAST(CASE WHEN COUNT(*) = 0 THEN -1 ELSE COUNT(*) END AS BIGINT) AS value FROM orders
 WHERE o_orderpriority IS NULL OR o_custkey IS NULL
""")
def case_count(spark, sf):
    o = t(spark, sf, "orders")
    return op.case_count(o, F.col("o_orderpriority").isNull() | F.col("o_custkey").isNull())


@query("count_rows_where", "SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def count_rows_where(spark, sf):
    return op.count_rows_where(t(spark, sf, "orders"), F.col("o_orderstatus") == "F")


@query("max_of_group_sums", """
SELECT COALESCE(MAX(s), 0) AS max_sum FROM (SELECT SUM(l_quantity) AS s FROM lineitem GROUP BY l_suppkey)
""")
def max_of_group_sums(spark, sf):
    return op.max_of_group_sums(t(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity")


@query("top_sum_group", """
SELECT user_id, total FROM (
  SELECT user_id, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total, MIN(event_id) AS first_pos
    FROM events GROUP BY user_id)
 ORDER BY total DESC, first_pos DESC LIMIT 1
""")
def top_sum_group(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id",
                                      F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return op.top_sum_group(e, "user_id", "cents", "event_id").withColumnRenamed("cents", "total")


@query("missing_number", """
SELECT CAST(CASE WHEN MIN(v) <> 1 THEN 1 WHEN MAX(v) <> COUNT(v) + 1 THEN COUNT(v) + 1
            ELSE (COUNT(v) + 1) * (COUNT(v) + 2) / 2 - SUM(v) END AS BIGINT) AS missing
  FROM (SELECT o_orderkey + 1 AS v FROM orders WHERE o_orderkey <> 41)
""")
def missing_number(spark, sf):
    """Order numbers 1..n+1 with order key 41 (number 42) absent: the one missing number."""
    o = t(spark, sf, "orders").where("o_orderkey <> 41").select((F.col("o_orderkey") + 1).alias("v"))
    return op.missing_number_sorted(o, "v")


@query("missing_values", """
SELECT g AS missing FROM (SELECT unnest(range(MIN(l_partkey), MAX(l_partkey) + 1)) AS g FROM lineitem)
 WHERE g NOT IN (SELECT l_partkey FROM lineitem)
""")
def missing_values(spark, sf):
    return op.missing_values(t(spark, sf, "lineitem").select("l_partkey"), "l_partkey")


@query("missing_ranges", """
WITH ids AS (SELECT DISTINCT l_orderkey * 7 + l_partkey % 5 - 1000 AS v FROM lineitem),
     steps AS (SELECT v, lead(v) OVER (ORDER BY v) AS nxt FROM ids)
SELECT v + 1 AS first_missing, nxt - 1 AS last_missing, nxt - v - 1 AS n_missing FROM steps WHERE nxt > v + 1
""")
def missing_ranges(spark, sf):
    """The gaps in numbers made of order and part keys, as intervals."""
    v = t(spark, sf, "lineitem").select((F.col("l_orderkey") * 7 + F.col("l_partkey") % 5 - 1000).alias("v"))
    return op.missing_ranges(v, "v")


@query("length_histogram", """
SELECT CAST(length(text) AS INTEGER) AS key_length, COUNT(*) AS n_keys FROM documents GROUP BY length(text)
""")
def length_histogram(spark, sf):
    return op.length_histogram(t(spark, sf, "documents"), "text")


@query("large_keys", "SELECT doc_id, CAST(length(text) AS INTEGER) AS key_length FROM documents "
                     "WHERE length(text) > 5000")
def large_keys(spark, sf):
    return op.large_keys(t(spark, sf, "documents"), "text").select("doc_id", F.length("text").alias("key_length"))


@query("json_group_concat", """
SELECT l_orderkey, CAST(to_json(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_returnflag': l_returnflag}
                                ORDER BY l_linenumber, l_partkey, l_returnflag)) AS VARCHAR) AS columns
  FROM lineitem GROUP BY l_orderkey
""")
def json_group_concat(spark, sf):
    return op.json_group_concat(t(spark, sf, "lineitem"), ["l_orderkey"],
                                ["l_linenumber", "l_partkey", "l_returnflag"], "l_linenumber")


@query("prefix_sizes", r"""
SELECT regexp_extract(url, '^(.*)/[^/]*$', 1) AS prefix, round(SUM(length(html)) / 1048576.0, 9) AS size_mb
  FROM pages GROUP BY 1
""")
def prefix_sizes(spark, sf):
    p = t(spark, sf, "pages").withColumn("size", F.length("html"))
    r = op.prefix_sizes(p, parent_prefix(F.col("url")), "size")
    return r.withColumn("size_mb", F.round("size_mb", 9))


@query("string_occurrences", """
SELECT doc_id, CAST(length(text) - length(replace(text, 'e', '')) AS BIGINT) AS n_e FROM documents
""")
def string_occurrences(spark, sf):
    from tidewater.functions import count_char
    return t(spark, sf, "documents").select("doc_id", count_char("text", "e").alias("n_e"))


@query("product_all_nonzero", """
SELECT l_orderkey, COALESCE(product(CASE WHEN l_linenumber - 1 <> 0 THEN l_linenumber - 1 END), 1.0) AS product
  FROM lineitem GROUP BY l_orderkey
""")
def product_all_nonzero(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("v"))
    return op.product_nonzero_agg(li, ["l_orderkey"], "v")


@query("failure_summary", """
SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS failed,
       COUNT(DISTINCT user_id) AS total,
       CAST(COUNT(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS VARCHAR) || ' of ' ||
       CAST(COUNT(DISTINCT user_id) AS VARCHAR) AS summary
  FROM events GROUP BY 1
""")
def failure_summary(spark, sf):
    """Per day the users whose events include an error, out of all users active that day."""
    e = t(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return op.failure_summary(e, "user_id", F.col("event_type") == "error", ["day"])
