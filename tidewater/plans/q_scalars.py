"""Scalar functions applied to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidewater.functions as tf
from tidewater.operators.windows import throttle
from tidewater.plans.common import t
from tidewater.plans.registry import query

NY, SYD = "America/New_York", "Australia/Sydney"
SLOTS = [2, 7, 11, 12, 16, 20]


@query("fn_camel_to_snake", """
SELECT conv_id, turn, lower(substr(text, 1, 1) || regexp_replace(substr(text, 2), '([A-Z])', '_\\1', 'g')) AS snake
  FROM conversations
""")
def fn_camel_to_snake(spark, sf):
    return t(spark, sf, "conversations").select("conv_id", "turn", tf.camel_to_snake("text").alias("snake"))


@query("fn_snake_to_camel", """
SELECT p_partkey, replace(p_name, ' ', '_') AS snake,
       array_to_string(list_transform(string_split(replace(p_name, ' ', '_'), '_'),
                       lambda x, i: CASE WHEN i = 1 THEN x ELSE upper(substr(x, 1, 1)) || lower(substr(x, 2)) END), '')
       AS camel
  FROM part
""")
def fn_snake_to_camel(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.regexp_replace("p_name", " ", "_").alias("snake"))
    return p.select("p_partkey", "snake", tf.snake_to_camel("snake").alias("camel"))


@query("fn_preplace", "SELECT doc_id, replace(text, 'the', '_the') AS text FROM documents")
def fn_preplace(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tf.preplace("text", "the", "_").alias("text"))


@query("fn_path_segment", """
SELECT page_id, CASE WHEN len(string_split(url, '/')) = 6 THEN string_split(url, '/')[-2]
                     ELSE string_split(url, '/')[-1] END AS offer_bk FROM pages
""")
def fn_path_segment(spark, sf):
    return t(spark, sf, "pages").select("page_id", tf.path_segment("url").alias("offer_bk"))


_KEY = ("CASE WHEN o_orderkey % 5 = 0 THEN 'lake/orders/undated/part-' "
        "ELSE 'lake/orders/date_=' || {day} || CASE WHEN o_orderkey % 3 = 1 THEN 'T10:00:00' "
        "WHEN o_orderkey % 3 = 2 THEN '-10-30' ELSE '' END || '/part-' END || CAST(o_orderkey AS {str}) || '.parquet'")


@query("fn_key_date", f"""
WITH k AS (SELECT o_orderkey, {_KEY.format(day="strftime(o_orderdate, '%Y-%m-%d')", str="VARCHAR")} AS key FROM orders),
     d AS (SELECT o_orderkey, key, string_split(string_split(string_split(key, 'date_')[-1], '/')[1], '=')[-1] AS raw
             FROM k)
SELECT o_orderkey, CASE WHEN contains(key, 'date_') THEN
         CAST(try_strptime(CASE WHEN contains(raw, 'T') THEN string_split(raw, 'T')[1]
                                ELSE array_to_string(string_split(raw, '-')[1:3], '-') END, '%Y-%m-%d') AS DATE)
       END AS key_date
  FROM d
""")
def fn_key_date(spark, sf):
    o = t(spark, sf, "orders").select(
        "o_orderkey", F.expr(_KEY.format(day="date_format(o_orderdate, 'yyyy-MM-dd')", str="STRING")).alias("key"))
    return o.select("o_orderkey", tf.key_date("key").alias("key_date"))


@query("fn_hash_filename", r"""
SELECT page_id, 'archive/' || md5(regexp_extract(url, '^(.*)/[^/]*$', 1)) || '-' || regexp_extract(url, '([^/]*)$', 1)
       AS new_key FROM pages
""")
def fn_hash_filename(spark, sf):
    return t(spark, sf, "pages").select("page_id", tf.hash_filename("url", "archive").alias("new_key"))


@query("fn_hash_bucket_key", """
SELECT o_orderkey,
       CASE WHEN length(CAST(o_orderkey AS VARCHAR)) > 2
            THEN 'object:' || substr(CAST(o_orderkey AS VARCHAR), 1, length(CAST(o_orderkey AS VARCHAR)) - 2)
            ELSE 'object:' END AS bucket_key,
       CASE WHEN length(CAST(o_orderkey AS VARCHAR)) > 2 THEN right(CAST(o_orderkey AS VARCHAR), 2)
            ELSE CAST(o_orderkey AS VARCHAR) END AS field
  FROM orders
""")
def fn_hash_bucket_key(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", tf.hash_bucket(
        F.concat(F.lit("object:"), F.col("o_orderkey").cast("string"))).alias("b"))
    return o.select("o_orderkey", F.col("b.key").alias("bucket_key"), F.col("b.field").alias("field"))


@query("fn_concat_nonempty", """
SELECT c_custkey, concat_ws(';',
         CASE WHEN c_custkey <> 0 THEN 'id:' || CAST(c_custkey AS VARCHAR) END,
         CASE WHEN c_name <> '' THEN 'name:' || c_name END,
         CASE WHEN nullif(c_mktsegment, 'BUILDING') <> '' THEN 'segment:' || c_mktsegment END) AS repr
  FROM customer
""")
def fn_concat_nonempty(spark, sf):
    c = t(spark, sf, "customer").withColumn("seg", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return c.select("c_custkey", tf.concat_nonempty({"id": "c_custkey", "name": "c_name", "segment": "seg"})
                    .alias("repr"))


@query("fn_join_path", """
SELECT o_orderkey, concat_ws('/', nullif(trim('/my-bucket/', '/'), ''), nullif(trim(o_orderpriority, '/'), ''),
                             nullif(trim('', '/'), ''), nullif(trim('orders_' || CAST(o_orderkey AS VARCHAR), '/'), ''))
                   || '.json.gz' AS path
  FROM orders
""")
def fn_join_path(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.lit("/my-bucket/").alias("bucket"), "o_orderpriority",
                                      F.lit("").alias("post_path"),
                                      F.concat(F.lit("orders_"), F.col("o_orderkey").cast("string")).alias("file"))
    return o.select("o_orderkey", tf.join_path(["bucket", "o_orderpriority", "post_path", "file"], ".json.gz")
                    .alias("path"))


@query("fn_strip_env_prefix", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'test_' WHEN doc_id % 3 = 1 THEN 'poc_' ELSE '' END || source ||
                  CASE WHEN doc_id % 2 = 0 THEN '/' || lang ELSE '' END AS template FROM documents),
     s AS (SELECT doc_id, template, split_part(template, '/', 1) AS db,
                  substr(template, length(split_part(template, '/', 1)) + 2) AS rest FROM d),
     x AS (SELECT *, len(string_split(db, '_')) > 1 AND db NOT IN ('poc_src1', 'test_src2') AS strip,
                  array_to_string(string_split(db, '_')[2:], '_') AS stripped FROM s),
     y AS (SELECT doc_id, template,
                  CASE WHEN template = '' THEN ''
                       WHEN strip THEN CASE WHEN stripped <> template AND contains(template, '/')
                                             AND split_part(template, '/', 2) <> '' THEN stripped || '/' || rest
                                            ELSE stripped END
                       ELSE template END AS path FROM x)
SELECT doc_id, template, CASE WHEN ends_with(path, '/') THEN path ELSE path || '/' END AS path FROM y
""")
def fn_strip_env_prefix(spark, sf):
    """Template paths derived from document sources: prefixed, plain, known and nested forms."""
    d = t(spark, sf, "documents").select("doc_id", F.concat(
        F.when(F.col("doc_id") % 3 == 0, F.lit("test_")).when(F.col("doc_id") % 3 == 1, F.lit("poc_"))
        .otherwise(F.lit("")), F.col("source"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/"), F.col("lang"))).otherwise(F.lit(""))).alias("template"))
    return d.select("doc_id", "template", tf.strip_env_prefix("template", ["poc_src1", "test_src2"]).alias("path"))


@query("fn_capacity_percent", """
WITH r AS (SELECT s_suppkey, 'Raw data size: ' || CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 10 AS VARCHAR) ||
                  '.5TB +/- 0.1TB' || chr(10) || 'License size: 12.5TB' AS report, s_nationkey * 10 AS ext FROM supplier),
     p AS (SELECT s_suppkey, report, ext,
                  CAST(trunc(CAST(replace(string_split(string_split(report, chr(10))[1], ' ')[4], 'TB', '') AS DOUBLE)
                             * 1024) AS BIGINT) AS used,
                  CAST(trunc(CAST(replace(string_split(string_split(report, chr(10))[2], ' ')[-1], 'TB', '') AS DOUBLE)
                             * 1024) AS BIGINT) AS total FROM r)
SELECT s_suppkey, report, CAST(trunc((used - ext) / total * 100) AS BIGINT) AS percent FROM p
""")
def fn_capacity_percent(spark, sf):
    """Two-line licence reports built from supplier balances: used TB on line 1, licence TB on line 2."""
    s = t(spark, sf, "supplier").select("s_suppkey", F.concat(
        F.lit("Raw data size: "), (F.floor(F.abs(F.col("s_acctbal"))).cast("bigint") % 10).cast("string"),
        F.lit(".5TB +/- 0.1TB\n"), F.lit("License size: 12.5TB")).alias("report"),
        (F.col("s_nationkey") * 10).alias("external_gb"))
    return s.select("s_suppkey", "report", tf.capacity_percent("report", "external_gb").alias("percent"))


@query("fn_trim_fields", "SELECT c_custkey, trim('  ' || c_name || ' ') AS name FROM customer")
def fn_trim_fields(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("padded"))
    return c.select("c_custkey", tf.trim_all("padded").alias("name"))


@query("fn_suffix_match", "SELECT page_id, contains(url, '.html') AS is_html FROM pages")
def fn_suffix_match(spark, sf):
    return t(spark, sf, "pages").select("page_id", tf.suffix_match("url", ".html").alias("is_html"))


@query("fn_to_zone", f"""
SELECT event_id, timezone('{NY}', timezone('UTC', ts)) AS ny,
       timezone('{SYD}', timezone('UTC', ts - INTERVAL 2 HOUR)) - INTERVAL 1 DAY AS syd_shifted
  FROM events
""")
def fn_to_zone(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", tf.to_zone("ts", NY).alias("ny"),
                    tf.to_zone("ts", SYD, days=1, hours=2, minutes=5).alias("syd_shifted"))


@query("fn_format_zone_date", f"""
SELECT event_id, strftime(timezone('{NY}', timezone('UTC', ts)), '%Y-%m-%d') AS ds_ny FROM events
""")
def fn_format_zone_date(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.format_zone_date("ts", NY).alias("ds_ny"))


@query("fn_previous_daily_run", """
SELECT event_id, CASE WHEN hour(ts) < 5 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 2 DAY + INTERVAL 325 MINUTE
                      ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 1 DAY + INTERVAL 325 MINUTE END AS run_ts
  FROM events
""")
def fn_previous_daily_run(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.previous_daily_run("ts").alias("run_ts"))


@query("fn_previous_slot", f"""
WITH s AS (SELECT event_id, date_trunc('hour', ts) + INTERVAL 25 MINUTE AS sensor,
                  list_max(list_filter({SLOTS}, lambda x: x <= hour(ts))) AS below FROM events)
SELECT event_id, CASE WHEN below IS NOT NULL
                      THEN CAST(CAST(sensor AS DATE) AS TIMESTAMP) + to_hours(below) + INTERVAL 25 MINUTE
                      ELSE sensor - to_hours({min(SLOTS)}) END AS slot_ts
  FROM s
""")
def fn_previous_slot(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.previous_slot("ts", SLOTS).alias("slot_ts"))


@query("fn_shift_dates", """
SELECT event_id, ts + INTERVAL 1 DAY AS next_day, ts + INTERVAL 23 HOUR AS next_23h FROM events
""")
def fn_shift_dates(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.shift_days_hours("ts", days=1).alias("next_day"),
                                         tf.shift_days_hours("ts", hours=23).alias("next_23h"))


@query("fn_clamp_past", """
WITH d AS (SELECT o_orderkey, o_orderdate,
                  (epoch_us(TIMESTAMP '1998-06-01') - epoch_us(o_orderdate)) // 86400000000 AS days FROM orders)
SELECT o_orderkey, CASE WHEN days > 30 THEN o_orderdate + to_days(CAST(days - 30 AS INTEGER)) ELSE o_orderdate END
       AS sensor_date
  FROM d
""")
def fn_clamp_past(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey",
                                         tf.clamp_past("o_orderdate", "1998-06-01 00:00:00").alias("sensor_date"))


@query("fn_throttle", """
SELECT event_id, COALESCE(ts - INTERVAL 15 MINUTE >= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TRUE)
       AS should_act
  FROM events
""")
def fn_throttle(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    return throttle(e, ["user_id"], "ts", 15, tiebreak="event_id").select("event_id", "should_act")


@query("fn_iso_to_epoch", """
SELECT event_id, CAST(epoch(strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT) AS epoch_s
  FROM events
""")
def fn_iso_to_epoch(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
    return e.select("event_id", tf.iso_to_epoch("iso").alias("epoch_s"))


@query("fn_five_minute_interval", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, COUNT(*) AS n FROM events GROUP BY 1
""")
def fn_five_minute_interval(spark, sf):
    e = t(spark, sf, "events")
    return e.groupBy(tf.five_minute_window("ts").alias("window_start")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_date_series", """
SELECT o_orderkey, CAST(d AS DATE) AS day
  FROM (SELECT o_orderkey, unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 3,
                                                  INTERVAL 1 DAY)) AS d FROM orders)
""")
def fn_date_series(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d0"),
                                      F.date_add(F.to_date("o_orderdate"), 3).alias("d1"))
    return o.select("o_orderkey", F.explode(tf.date_series("d0", "d1")).alias("day"))


@query("fn_factorial", """
SELECT p_partkey, CASE WHEN p_size % 21 <= 1 THEN CAST(p_size % 21 AS BIGINT) ELSE CAST(factorial(p_size % 21) AS BIGINT)
       END AS fact FROM part
""")
def fn_factorial(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", (F.col("p_size") % 21).alias("n"))
    return p.select("p_partkey", tf.factorial_parity("n").alias("fact"))


@query("fn_bytes_to_gb", "SELECT doc_id, round(n_chars * 1000000 / 1073741824.0, 9) AS gb FROM documents")
def fn_bytes_to_gb(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 1000000).alias("bytes"))
    return d.select("doc_id", F.round(tf.bytes_to_gb("bytes"), 9).alias("gb"))


def _order_lines(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("l_linenumber")).alias("nums"),
        F.array_sort(F.collect_list("l_returnflag")).alias("flags"))


@query("fn_product_except_self", """
SELECT l_orderkey, CASE WHEN len(nums) <= 1 THEN nums
                        ELSE list_transform(nums, lambda x, i: CAST(list_product(list_filter(nums, lambda y, j: j <> i))
                                                                AS BIGINT)) END AS products
  FROM (SELECT l_orderkey, list_sort(list(CAST(l_linenumber AS BIGINT))) AS nums FROM lineitem GROUP BY l_orderkey)
""")
def fn_product_except_self(spark, sf):
    o = _order_lines(spark, sf)
    return o.select("l_orderkey", tf.product_except_self("nums").alias("products"))


@query("fn_divide_trunc", """
SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS BIGINT) // l_linenumber AS q FROM lineitem
""")
def fn_divide_trunc(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                         F.round("l_extendedprice").cast("bigint").alias("price"))
    return li.select("l_orderkey", "l_linenumber", tf.divide_trunc("price", "l_linenumber").alias("q"))


@query("fn_double_elements", """
SELECT l_orderkey, list_transform(list_sort(list(l_linenumber)), lambda x: x * 2) AS nums2,
       list_transform(list_sort(list(l_returnflag)), lambda x: repeat(x, 2)) AS flags2
  FROM lineitem GROUP BY l_orderkey
""")
def fn_double_elements(spark, sf):
    o = _order_lines(spark, sf)
    return o.select("l_orderkey", tf.double_elements("nums", T.IntegerType()).alias("nums2"),
                    tf.double_elements("flags", T.StringType()).alias("flags2"))


@query("fn_flat_map", """
SELECT l_orderkey, flatten(list_transform(list_sort(list(l_linenumber)), lambda x: [x, x * 10])) AS flat
  FROM lineitem GROUP BY l_orderkey
""")
def fn_flat_map(spark, sf):
    o = _order_lines(spark, sf)
    return o.select("l_orderkey", tf.flat_map("nums", lambda x: F.array(x, x * 10)).alias("flat"))


@query("fn_map_merge", """
SELECT c_custkey, list_sort(list_transform(map_entries(map_concat(
         MAP {'nation': CAST(c_nationkey AS VARCHAR), 'segment': c_mktsegment},
         MAP {'segment': lower(c_mktsegment), 'tier': CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'std' END})),
         lambda e: e.key || '=' || e.value)) AS merged
  FROM customer
""")
def fn_map_merge(spark, sf):
    c = t(spark, sf, "customer").select(
        "c_custkey",
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"))
        .alias("a"),
        F.create_map(F.lit("segment"), F.lower("c_mktsegment"), F.lit("tier"),
                     F.when(F.col("c_acctbal") > 5000, "gold").otherwise("std")).alias("b"))
    m = tf.map_merge("a", "b")
    return c.select("c_custkey", F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), e["value"]))).alias("merged"))


@query("fn_json_value", "SELECT event_id, json_extract_string(props, '$.k') AS offer FROM events")
def fn_json_value(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.json_value("props", "$.k").alias("offer"))


@query("fn_parse_json", "SELECT event_id, CAST(json(props) AS VARCHAR) AS props_json FROM events")
def fn_parse_json(spark, sf):
    return t(spark, sf, "events").select("event_id", tf.parse_json_text("props").alias("props_json"))


@query("fn_to_json_compact", """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' AND NOT c_acctbal > 0 THEN '[]'
            WHEN c_mktsegment = 'BUILDING' THEN '{"nations":[' || CAST(c_nationkey AS VARCHAR) || ']}'
            WHEN NOT c_acctbal > 0 THEN '{"segment":"' || c_mktsegment || '"}'
            ELSE '{"segment":"' || c_mktsegment || '","nations":[' || CAST(c_nationkey AS VARCHAR) || ']}' END AS json
  FROM customer
""")
def fn_to_json_compact(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.struct(
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.array("c_nationkey")).otherwise(F.array().cast("array<int>"))
        .alias("nations")).alias("doc"))
    return c.select("c_custkey", tf.to_json_compact("doc", c.schema["doc"].dataType).alias("json"))


@query("fn_json_round_trip", """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS total, o_orderdate AS ordered FROM orders
""")
def fn_json_round_trip(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("ordered")).alias("doc"))
    back = o.select("o_orderkey", tf.json_round_trip("doc", o.schema["doc"].dataType).alias("doc"))
    return back.select("o_orderkey", "doc.status", "doc.total", "doc.ordered")


@query("fn_polygon_wkt", """
WITH p AS (SELECT l_orderkey, list([CAST(l_linenumber AS DOUBLE), l_quantity] ORDER BY l_linenumber, l_quantity) AS ring
             FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey,
       'POLYGON((' || array_to_string(list_transform(list_concat(ring, [ring[1]]),
                        lambda x: CAST(x[2] AS VARCHAR) || ' ' || CAST(x[1] AS VARCHAR)), ',') || '))' AS wkt,
       len(ring) + 1 >= 4 AS valid
  FROM p
""")
def fn_polygon_wkt(spark, sf):
    """Per order, a ring of (line number, quantity) points closed on its first point, as JSON text; orders with an
    even key nest the ring one level deeper (both input forms of the source)."""
    li = t(spark, sf, "lineitem")
    pts = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.array(F.col("l_linenumber").cast("double"), F.col("l_quantity")))).alias("ring"))
    closed = pts.select("l_orderkey", F.concat("ring", F.slice("ring", 1, 1)).alias("ring"))
    js = closed.select("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, F.to_json(F.array("ring")))
                       .otherwise(F.to_json("ring")).alias("coordinates"))
    ring = tf.polygon_ring("coordinates")
    return js.select("l_orderkey", tf.polygon_wkt(ring).alias("wkt"), tf.polygon_valid(ring).alias("valid"))
