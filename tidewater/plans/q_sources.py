"""Scans, sources and sinks bound to the driver tables.

Write/read round trips go below the shared checkpoint folder (``spark.checkpoint.dir``), each run in a fresh
directory.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.joins import flatten_config
from tidewater.plans.common import t
from tidewater.plans.q_joins import EVENT_CONFIG
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import api, files, outbox, retention, sinks, state
from tidewater.sources.ledger import Ledger, Ranges
from tidewater.tables import SCHEMAS, table_path


@query("scan_csv", "SELECT * FROM part")
def scan_csv(spark, sf):
    path = scratch_path(spark, "part-csv")
    t(spark, sf, "part").write.mode("overwrite").option("header", True).csv(path)
    return files.read_csv(spark, path, SCHEMAS["part"])


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf):
    return files.read_parquet(spark, table_path(sf, "orders"), SCHEMAS["orders"])


@query("scan_json_lines", "SELECT * FROM events")
def scan_json_lines(spark, sf):
    path = scratch_path(spark, "events-json")
    files.write_json_lines(t(spark, sf, "events"), path)
    return files.read_json_lines(spark, path, SCHEMAS["events"])


@query("scan_listing")
def scan_listing(spark, sf):
    """The fixture directory's Parquet files with their sizes (metadata columns only; contents not read)."""
    ls = files.list_files(spark, sf, glob="*.parquet", recursive=False)
    return ls.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length")


@query("scan_listing_partitions", """
SELECT 'l_returnflag=' || l_returnflag AS folder, TRUE AS has_files, TRUE AS has_bytes, SUM(l_quantity) AS quantity
  FROM lineitem GROUP BY l_returnflag
""")
def scan_listing_partitions(spark, sf):
    """The listing of the line items written by return flag, with what the listed files of each folder hold."""
    out = scratch_path(spark, "listed")
    sinks.write_partitioned(t(spark, sf, "lineitem").select("l_returnflag", "l_quantity"), out, ["l_returnflag"])
    ls = files.list_files(spark, out, glob="*.parquet").select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), "length")
    held = spark.read.parquet(out).groupBy(F.concat(F.lit("l_returnflag="), "l_returnflag").alias("folder")) \
        .agg(F.sum("l_quantity").alias("quantity"))
    found = ls.groupBy("folder").agg((F.count(F.lit(1)) > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes"))
    return found.join(held, "folder")


@query("retention_delete", """
WITH d AS (SELECT *, CAST(ts AS DATE) AS day, MAX(CAST(ts AS DATE)) OVER () AS last FROM events)
SELECT event_id, day FROM d WHERE day > last - 10
""")
def retention_delete(spark, sf):
    """The events by day, of which the newest ten days stay: the files of the others are planned for deletion, and the
    plan is carried out; what is left."""
    root = scratch_path(spark, "retention")
    e = t(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    sinks.write_partitioned(e, root, ["day"])
    day = F.regexp_extract("path", r"day=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    listed = files.list_files(spark, root, "*.parquet").withColumn("day", day)
    newest = listed.agg(F.max("day")).scalar()
    run = retention.plan(spark, root, listed.where(F.col("day") <= F.date_sub(newest, 10)))
    retention.execute(spark, root, run)
    return spark.read.parquet(root).select("event_id", F.col("day").cast("date"))


@query("export_table", """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
  FROM orders
""")
def export_table(spark, sf):
    """All orders exported as gzip JSON lines under bucket/db/post-path/file (times as text), read back."""
    base = scratch_path(spark, "export")
    path = sinks.output_path([base, "shop", None, "orders"], "json")
    df = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    written = sinks.export_table(df, path, "json")
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate STRING"
    if not written:
        return spark.createDataFrame([], schema)
    return files.read_json_lines(spark, path, schema)


@query("load_overwrite", "SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem")
def load_overwrite(spark, sf):
    """Line items landed as CSV with the ship date as text; loaded with the date column cast, replacing the target."""
    src = scratch_path(spark, "li-csv") + ".csv"
    t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                    F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"),
                                    "l_returnflag").write.mode("overwrite").option("header", True).csv(src)
    target = scratch_path(spark, "li-table")
    return sinks.load_overwrite(spark, src, target, "l_orderkey BIGINT, l_linenumber INT, l_shipdate STRING, "
                                                    "l_returnflag STRING", date_columns=["l_shipdate"])


@query("export_daily_incremental", """
SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS day FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'
""")
def export_daily_incremental(spark, sf):
    """Two runs: January first, then January-June; the second run skips the days already written."""
    out = scratch_path(spark, "daily")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    sinks.export_daily_incremental(o, "o_orderdate", "1997-01-01", "1997-02-01", out)
    sinks.export_daily_incremental(o, "o_orderdate", "1997-01-01", "1997-07-01", out)
    return spark.read.parquet(out).select("o_orderkey", "o_orderdate", F.col("day").cast("date"))


_ASKED = [("2024-01-09 10:30:00", "2024-01-20"), ("2024-01-01", "2024-01-15 17:00:00"), ("2024-01-12", "2024-03-01")]


@query("export_overlapping_runs", f"""
WITH asked(b, e) AS (VALUES {', '.join(f"(TIMESTAMP '{b}', date_trunc('day', TIMESTAMP '{e}'))" for b, e in _ASKED)}),
     days AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, MIN(event_id) AS first_id, MAX(event_id) AS last_id
                FROM events WHERE EXISTS (SELECT 1 FROM asked WHERE ts >= b AND ts < e) GROUP BY 1),
     points AS (SELECT b, e, MAX(e) OVER (ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                  FROM asked),
     islands AS (SELECT b, e, SUM(CASE WHEN before >= b THEN 0 ELSE 1 END) OVER (ORDER BY b, e) AS i FROM points),
     held AS (SELECT i, MIN(b) AS b, MAX(e) AS e FROM islands GROUP BY i)
SELECT day, n, first_id, last_id, b AS covered_from, e AS covered_to
  FROM days JOIN held ON day >= CAST(b AS DATE) AND day < e
""")
def export_overlapping_runs(spark, sf):
    """Three overlapping exports of all events, one beginning and one ending within a day; per day what the output
    holds, and the covered stretch of the ledger that the day lies in."""
    out = scratch_path(spark, "overlapping")
    e = t(spark, sf, "events").select("event_id", "ts")
    for start, end in _ASKED:
        sinks.export_daily_incremental(e, "ts", start, end, out)
    stretch = F.lit(None)
    for begin, end in Ledger(spark, out).state()[0].parts:
        own = F.struct(F.lit(begin).cast("timestamp_ntz").alias("b"), F.lit(end).cast("timestamp_ntz").alias("e"))
        stretch = F.when(Ranges([(begin, end)]).holds(F.col("last_ts")), own).otherwise(stretch)
    days = spark.read.parquet(out).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
        F.max("ts").alias("last_ts"))
    return days.withColumn("s", stretch).select(F.col("day").cast("date"), "n", "first_id", "last_id",
                                                F.col("s.b").alias("covered_from"), F.col("s.e").alias("covered_to"))


@query("compact_files", "SELECT * FROM orders")
def compact_files(spark, sf):
    """Many small files packed by size in two runs, the second over what has come since."""
    src, dst = scratch_path(spark, "many"), scratch_path(spark, "compact")
    o = t(spark, sf, "orders")
    urgent = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    for part in (o.where(urgent), o.where(~urgent)):
        part.repartition(16).write.mode("append").parquet(src)
        sinks.compact_files(spark, src, dst, target_bytes=100_000)
    return spark.read.schema(SCHEMAS["orders"]).parquet(dst)


@query("write_partitioned", "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def write_partitioned(spark, sf):
    path = scratch_path(spark, "parts")
    sinks.write_partitioned(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                            "l_linestatus"), path, ["l_returnflag", "l_linestatus"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


_PAGE_ROW = "tstamp STRING, value DOUBLE, event_id BIGINT"


def landed_pages(spark, sf):
    """Event pages as an API would return them: per (campaign = user, message = event type) and page of 50,
    a JSON object keyed by row index plus status keys and one empty row."""
    e = t(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("campaignid"), F.col("event_type").alias("messageid"),
        (F.col("event_id") / 50).cast("bigint").alias("page"), "event_id",
        F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("tstamp"), "value", "event_id"))
        .alias("row"))
    pages = e.groupBy("campaignid", "messageid", "page").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("event_id").cast("string"), F.col("row")))).alias("m"))
    status = F.create_map(F.lit("result_code"), F.lit("1"), F.lit("result_message"), F.lit("Success"),
                          F.lit("result_output"), F.lit("json"), F.lit("empty"), F.lit("{}"))
    return pages.select("campaignid", "messageid", F.to_json(F.map_concat("m", status)).alias("page_json"))


@query("normalize_paged_result", """
SELECT CAST(user_id AS VARCHAR) AS campaignid, event_type AS messageid, CAST(event_id AS VARCHAR) AS row_key,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS tstamp, value, event_id
  FROM events
""")
def normalize_paged_result(spark, sf):
    return api.normalize_paged_result(landed_pages(spark, sf), "page_json", _PAGE_ROW, ["campaignid", "messageid"])


_CFG_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{v}')" for a, b, c, v in flatten_config(EVENT_CONFIG))


@query("reverse_etl_requests", f"""
WITH conv AS (SELECT o_orderkey, o_orderstatus AS product, o_orderpriority AS sub_type,
                     CASE WHEN o_totalprice > 100000 THEN 'premium' ELSE 'standard' END AS rate_plan,
                     o_orderpriority = '1-URGENT' AS report_click FROM orders),
     j AS (SELECT c.*, cfg.event_id FROM conv c LEFT JOIN (VALUES {_CFG_VALUES}) cfg(product, sub_type, rate_plan, event_id)
             ON c.product = cfg.product AND c.sub_type = cfg.sub_type AND c.rate_plan = cfg.rate_plan)
SELECT o_orderkey, 1 AS step, 'click' AS kind, CAST(NULL AS VARCHAR) AS event_id FROM j WHERE report_click
UNION ALL
SELECT o_orderkey, 2, 'event', event_id FROM j
""")
def reverse_etl_requests(spark, sf):
    """The callback request table for conversions (orders): click requests for urgent orders, event requests
    with the event id from the nested config."""
    return _requests(spark, sf)


def _requests(spark, sf):
    o = t(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("product"), F.col("o_orderpriority").alias("sub_type"),
        F.when(F.col("o_totalprice") > 100000, "premium").otherwise("standard").alias("rate_plan"),
        (F.col("o_orderpriority") == "1-URGENT").alias("report_click"))
    cfg = F.broadcast(spark.createDataFrame(flatten_config(EVENT_CONFIG), "product string, sub_type string, "
                                                                          "rate_plan string, event_id string"))
    return api.request_table(o, cfg, ["product", "sub_type", "rate_plan"], "report_click", "o_orderkey")


def _answer(request: dict) -> int:
    """Stands in for the other system: it refuses the events of some orders for good."""
    return 500 if request["kind"] == "event" and request["o_orderkey"] % 11 == 0 else 200


def _answer_on_a_bad_day(request: dict) -> int:
    return 503 if request["kind"] == "click" and request["o_orderkey"] % 7 == 0 else _answer(request)


@query("request_statuses", f"""
WITH conv AS (SELECT o_orderkey, o_orderstatus AS product, o_orderpriority AS sub_type,
                     CASE WHEN o_totalprice > 100000 THEN 'premium' ELSE 'standard' END AS rate_plan,
                     o_orderpriority = '1-URGENT' AS report_click FROM orders),
     j AS (SELECT c.*, cfg.event_id FROM conv c LEFT JOIN (VALUES {_CFG_VALUES}) cfg(product, sub_type, rate_plan, event_id)
             ON c.product = cfg.product AND c.sub_type = cfg.sub_type AND c.rate_plan = cfg.rate_plan)
SELECT o_orderkey, 1 AS step, 'click' AS kind, 200 AS status, TRUE AS ok, 1 AS attempts, FALSE AS in_doubt
  FROM j WHERE report_click
UNION ALL
SELECT o_orderkey, 2, 'event', CASE WHEN event_id IS NULL THEN NULL WHEN o_orderkey % 11 = 0 THEN 500 ELSE 200 END,
       event_id IS NOT NULL AND o_orderkey % 11 <> 0,
       CASE WHEN event_id IS NULL THEN 0 WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END, FALSE
  FROM j
""")
def request_statuses(spark, sf):
    """All requests sent through an outbox, on a day when some clicks fail (so their events wait), and the run repeated:
    it sends what failed or waited, and nothing else."""
    box, requests = scratch_path(spark, "outbox"), _requests(spark, sf)
    outbox.send(requests, "o_orderkey", _answer_on_a_bad_day, box, tries=2).write.format("noop").mode("overwrite").save()
    done = outbox.send(requests, "o_orderkey", _answer, box, tries=2, retry_failed=True)
    return done.select("o_orderkey", "step", "kind", "status", "ok", "attempts", "in_doubt")


@query("upsert_by_key", """
WITH v0 AS (SELECT c_custkey AS key, c_name AS value FROM customer),
     upd AS (SELECT c_custkey AS key, upper(c_name) || '*' AS value FROM customer WHERE c_acctbal > 5000
             UNION ALL SELECT s_suppkey + 1000000000 AS key, s_name AS value FROM supplier)
SELECT * FROM v0 WHERE key NOT IN (SELECT key FROM upd) UNION ALL SELECT * FROM upd
""")
def upsert_by_key(spark, sf):
    path = scratch_path(spark, "state")
    c = t(spark, sf, "customer")
    state.upsert_by_key(spark, path, c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value")), ["key"])
    upd = c.where("c_acctbal > 5000").select(F.col("c_custkey").alias("key"),
                                             F.concat(F.upper("c_name"), F.lit("*")).alias("value")).unionByName(
        t(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000000).alias("key"), F.col("s_name").alias("value")))
    state.upsert_by_key(spark, path, upd, ["key"])
    return state.read_state(spark, path)


@query("upsert_few_keys", """
WITH late AS (SELECT o_custkey AS key, MAX(o_orderkey) AS value FROM orders GROUP BY 1),
     v0 AS (SELECT o_orderkey AS key, o_custkey AS value, CAST(NULL AS VARCHAR) AS note FROM orders),
     one AS (SELECT o_orderkey AS key, -o_custkey AS value, o_orderstatus AS note FROM orders
              WHERE o_orderkey IN (SELECT value FROM late)),
     v1 AS (SELECT * FROM v0 WHERE key NOT IN (SELECT key FROM one) UNION ALL SELECT * FROM one)
SELECT * FROM v1
""")
def upsert_few_keys(spark, sf):
    """The orders as state, then each customer's last order replaced (with a column that the first version lacks) and the
    same update replayed as the same version."""
    path = scratch_path(spark, "few-keys")
    o = t(spark, sf, "orders")
    state.upsert_by_key(spark, path, o.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("value")), ["key"])
    late = o.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderstatus"), "o_orderkey").alias("x"))
    few = late.select(F.col("x.o_orderkey").alias("key"), (-F.col("o_custkey")).alias("value"),
                      F.col("x.o_orderstatus").alias("note"))
    for _ in range(2):
        state.upsert_by_key(spark, path, few, ["key"], version=1)
    return state.read_state(spark, path)


@query("incremental_watermark", """
WITH rows AS (SELECT CAST(user_id AS VARCHAR) AS campaignid, event_type AS api_action, event_id, ts FROM events),
     marks AS (SELECT CAST(user_id AS VARCHAR) AS campaignid, event_type AS api_action, MAX(ts) AS last_ts FROM events
                WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 2 = 0 GROUP BY 1, 2)
SELECT r.campaignid, r.api_action, r.event_id, r.ts FROM rows r LEFT JOIN marks m
    ON r.campaignid = m.campaignid AND r.api_action = m.api_action
 WHERE r.ts > COALESCE(m.last_ts, TIMESTAMP '2020-01-01')
""")
def incremental_watermark(spark, sf):
    """Second run of a delta pull: marks saved by a first run (even users, data up to 2024-01-20) filter the rows."""
    e = t(spark, sf, "events").select(F.col("user_id").cast("string").alias("campaignid"),
                                      F.col("event_type").alias("api_action"), "event_id", "ts", "user_id")
    first = e.where("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00' AND user_id % 2 = 0")
    _, marks = api.incremental_watermark(first.drop("user_id"), None, ["campaignid", "api_action"], "ts")
    fresh, _ = api.incremental_watermark(e.drop("user_id"), marks, ["campaignid", "api_action"], "ts")
    return fresh
