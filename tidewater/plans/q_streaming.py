"""Streaming operators run over the driver tables as file streams (``availableNow``), with their
sinks and checkpoints below the shared checkpoint folder; each query returns a batch read of its sink."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidewater.operators import ttl
from tidewater.plans.common import t
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources.partitions import file_names
from tidewater.streaming import streams as st
from tidewater.tables import SCHEMAS, table_path


def event_stream(spark, sf, max_files: int = 1):
    """The ``events`` table as a file stream source."""
    return spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", max_files) \
        .option("pathGlobFilter", "events.parquet").parquet(sf.rstrip("/"))


@query("stream_produce", """
SELECT 'event-producer' AS producer, event_id, user_id, event_type FROM events
""")
def stream_produce(spark, sf):
    sink, ck = scratch_path(spark, "produce-sink"), scratch_path(spark, "produce-ck")
    src = event_stream(spark, sf).select("event_id", "user_id", "event_type")
    q = st.produce(src, "event-producer", sink, ck)
    q.awaitTermination()
    msgs = spark.read.parquet(sink)
    return st.decode_messages(msgs, "event_id BIGINT, user_id BIGINT, event_type STRING")


@query("stream_consume", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_consume(spark, sf):
    out, ck = scratch_path(spark, "consume-out"), scratch_path(spark, "consume-ck")
    q = st.consume(event_stream(spark, sf), st.idempotent_batch_writer(out), ck)
    q.awaitTermination()
    return spark.read.schema(SCHEMAS["events"]).parquet(out).select(*SCHEMAS_EVENTS_COLS)


@query("stream_quarantine", """
SELECT event_id, CASE WHEN event_id % 53 = 0 THEN 'malformed, or a value of another type'
                      WHEN event_id % 59 = 0 THEN 'malformed, or a value of another type'
                      WHEN event_id % 61 = 0 THEN 'not an object' WHEN event_id % 67 = 0 THEN 'empty' END AS reason,
       CASE WHEN event_id % 53 <> 0 AND event_id % 59 <> 0 AND event_id % 61 <> 0 AND event_id % 67 <> 0 THEN user_id END
         AS user_id,
       CASE WHEN event_id % 53 <> 0 AND event_id % 59 <> 0 AND event_id % 61 <> 0 AND event_id % 67 <> 0 THEN event_type END
         AS event_type
  FROM events
""")
def stream_quarantine(spark, sf):
    """Event messages, some cut short, of a wrong type, not an object or empty, through a consumer with a sink for broken
    payloads; what each sink holds."""
    src, out, dead, ck = (scratch_path(spark, f"quarantine-{x}") for x in ("src", "out", "dead", "ck"))
    e = t(spark, sf, "events").select("event_id", "user_id", "event_type")
    msgs = st.to_messages(e, "event-producer", key_col="event_id")
    key, text = F.col("key").cast("string").cast("long"), F.col("value").cast("string")
    broken = (F.when(key % 53 == 0, F.substring(text, 1, 20)).when(key % 59 == 0, F.lit('{"user_id": "many"}'))
              .when(key % 61 == 0, F.lit("[1, 2]")).when(key % 67 == 0, F.lit(" ")).otherwise(text))
    msgs.withColumn("value", broken.cast("binary")).write.parquet(src)
    stream = spark.readStream.schema("headers MAP<STRING, STRING>, value BINARY, key BINARY").parquet(src)
    st.consume_with_quarantine(stream, "user_id BIGINT, event_type STRING", out, dead, ck, keep=("key",)).awaitTermination()
    number = F.col("key").cast("string").cast("long").alias("event_id")
    good = spark.read.parquet(out).select(number, F.lit(None).cast("string").alias("reason"), "user_id", "event_type")
    return good.unionByName(spark.read.parquet(dead).select(number, "reason"), allowMissingColumns=True)


SCHEMAS_EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("interval_ingest", """
SELECT event_id, CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS DATE) AS date_,
       strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%H%M') AS interval FROM events
""")
def interval_ingest(spark, sf):
    out, ck = scratch_path(spark, "interval-out"), scratch_path(spark, "interval-ck")
    q = st.interval_ingest(event_stream(spark, sf).select("event_id", "ts"), "ts", out, ck)
    q.awaitTermination()
    return spark.read.option("basePath", out) \
        .schema("event_id BIGINT, ts TIMESTAMP_NTZ, interval STRING, batch_id INT, date_ DATE") \
        .parquet(out).select("event_id", "date_", "interval")


@query("interval_ingest_late", """
WITH m AS (SELECT MAX(ts) - INTERVAL 1 DAY AS mark FROM events WHERE event_id % 3 <> 0)
SELECT event_id, CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS DATE) AS date_,
       strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%H%M') AS interval,
       event_id % 3 = 0 AND time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= mark AS late
  FROM events, m
""")
def interval_ingest_late(spark, sf):
    """Two batches, two thirds of the events and then the rest: what comes after the watermark is kept apart."""
    src, out, late, ck = (scratch_path(spark, f"late-{x}") for x in ("src", "out", "late", "ck"))
    e = t(spark, sf, "events").select("event_id", "ts")
    for part in (e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0")):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(e.schema).parquet(src)
        st.interval_ingest(stream, "ts", out, ck, late_path=late, delay=timedelta(days=1)).awaitTermination()
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, interval STRING, batch_id INT, date_ DATE"
    both = [spark.read.schema(schema).parquet(p).select("event_id", "date_", "interval", F.lit(p == late).alias("late"))
            for p in (out, late)]
    return both[0].unionByName(both[1])


@query("interval_counts", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, COUNT(*) AS n FROM events GROUP BY 1
HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE
""")
def interval_counts(spark, sf):
    """Messages per interval, of the intervals that the watermark (10 minutes) has passed at the end."""
    out, ck = scratch_path(spark, "counts-out"), scratch_path(spark, "counts-ck")
    counts = st.interval_counts(event_stream(spark, sf).select("event_id", "ts"), "ts", "10 minutes")
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append") \
        .trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("window_start TIMESTAMP_NTZ, n BIGINT").parquet(out)


# cache operations from all events: a view stores the offer (ttl 2 days), a click reads and renews it, a purchase
# stores an empty value (never stored), other events only look
def cache_ops(spark, sf):
    kind = F.col("event_type")
    return t(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(kind == "view", F.get_json_object("props", "$.k")).alias("value"),
        F.when(kind.isin("view", "purchase"), "set").when(kind == "click", "get").otherwise("look").alias("op"),
        "ts", F.lit(172800).alias("ttl"), "event_id")


_TTL_AS_OF = "2024-01-30 12:00:00"

#: One operation after the other, by recursion.
_TTL_RUN = """
WITH RECURSIVE ops AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS value,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'set' WHEN event_type = 'click' THEN 'get' ELSE 'look' END AS op,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
    FROM events WHERE ts <= TIMESTAMP '{till}'),
run AS (
  SELECT key, event_id, i, CASE WHEN op = 'set' THEN value END AS value,
         CASE WHEN op = 'set' AND value IS NOT NULL THEN ts + INTERVAL 172800 SECOND END AS expires,
         CAST(NULL AS VARCHAR) AS met FROM ops WHERE i = 1
  UNION ALL
  SELECT o.key, o.event_id, o.i,
         CASE WHEN o.op = 'set' AND o.value IS NOT NULL THEN o.value WHEN r.expires > o.ts THEN r.value END,
         CASE WHEN o.op = 'set' AND o.value IS NOT NULL THEN o.ts + INTERVAL 172800 SECOND
              WHEN r.expires > o.ts THEN CASE WHEN o.op = 'get' THEN o.ts + INTERVAL 172800 SECOND ELSE r.expires END END,
         CASE WHEN r.expires > o.ts THEN r.value END
    FROM run r JOIN ops o ON o.key IS NOT DISTINCT FROM r.key AND o.i = r.i + 1)
"""
_TTL_LOOKUP = _TTL_RUN.format(till=_TTL_AS_OF) + f"""
SELECT key, value, expires FROM run r
 WHERE i = (SELECT MAX(i) FROM run x WHERE x.key IS NOT DISTINCT FROM r.key) AND expires > TIMESTAMP '{_TTL_AS_OF}'
"""


@query("keyed_ttl_lookup", _TTL_LOOKUP)
def keyed_ttl_lookup(spark, sf):
    """Batch form: the cached offer per user still alive at the as-of time, with renew on read."""
    return st.ttl_lookup_batch(cache_ops(spark, sf), _TTL_AS_OF, auto_renew=True, ties=("event_id",))


@query("keyed_ttl_replay", _TTL_RUN.format(till="9999-01-01") + """
SELECT event_id, key, met AS met_value, value AS left_value, expires AS left_until FROM run
""")
def keyed_ttl_replay(spark, sf):
    """Every operation with what it met in the cache and what it left there."""
    done = ttl.replay(cache_ops(spark, sf), ties=("event_id",), auto_renew=True)
    return done.select("event_id", "key", "met_value", "left_value", "left_until")


@query("keyed_ttl_state", _TTL_LOOKUP)
def keyed_ttl_state(spark, sf):
    """Stream form of the same cache, fed by the files of four weeks or so, two a batch, with event-time timers: what it
    holds at the as-of time."""
    src_path, landed = scratch_path(spark, "cache-ops"), []
    ops = cache_ops(spark, sf).where(F.col("ts") <= F.lit(_TTL_AS_OF).cast("timestamp_ntz")).drop("event_id")
    weeks = ["2024-01-09", "2024-01-17", "2024-01-24", "9999-01-01"]
    for begin, end in zip(["0001-01-01", *weeks], weeks):  # files come in this order, rows within a file in any
        own = (F.col("ts") >= F.lit(begin).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        ops.where(own).write.mode("append").parquet(src_path)
        landed.append(sum(f.endswith(".parquet") for f in file_names(spark, src_path)) - sum(landed))
    # two weeks a batch, however many files a week was written in: the count of batches must not grow with the rows
    stream = spark.readStream.schema("key STRING, value STRING, op STRING, ts TIMESTAMP_NTZ, ttl INT") \
        .option("maxFilesPerTrigger", max(sum(landed[:2]), sum(landed[2:]), 1)).parquet(src_path)
    out, ck = scratch_path(spark, "ttl-out"), scratch_path(spark, "ttl-ck")
    q = st.consume(st.ttl_state(stream, auto_renew=True, delay="10 days"), st.idempotent_batch_writer(out), ck,
                   output_mode="update")
    q.awaitTermination()
    snap = spark.read.parquet(out)
    # the newest row per key is the state after the final batch
    latest = snap.groupBy("key").agg(F.max_by(F.struct("value", "expires"), F.col("batch_id")).alias("s"))
    return latest.select("key", "s.value", "s.expires") \
        .where(F.col("expires") > F.lit(_TTL_AS_OF).cast("timestamp_ntz"))
