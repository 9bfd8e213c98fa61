"""Structured Streaming operators.

- ``produce``: messages with a producer header (``headers`` map + binary ``value``, the Kafka sink's shape) written
  by a streaming query; any streaming source feeds it (``rate-micro-batch`` for a steady 5-per-tick producer).
- ``consume``: a consumer group is a streaming query with its own checkpoint: a batch is acknowledged when its
  offsets are committed there. Delivery to the handler is at least once; the batch id makes sinks idempotent.
- ``interval_ingest``: each message lands in the output of its 5-minute interval, late ones in one of their own;
  ``interval_counts`` is the watermarked windowed aggregate of the same stream.
- ``watermark_stream``: the per-key high-water-mark delta pull, run per micro-batch.
- ``ttl_state``: last value per key with a time-to-live and optional renew-on-read, as keyed state with timers.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.operators import ttl
from tidewater.sources import api, quarantine, state
from tidewater.sources.partitions import file_names, partition_values, read_text, write_text


def _trigger(w, trigger: dict | None):
    return w.trigger(**(trigger or {"availableNow": True}))


def to_messages(df: DataFrame, producer: str, key_col: str | None = None) -> DataFrame:
    """Rows -> messages: ``headers`` map with the producer name, ``value`` = the row as JSON bytes."""
    cols = [c for c in df.columns]
    out = df.select(
        F.create_map(F.lit("producer"), F.lit(producer)).alias("headers"),
        F.to_json(F.struct(*cols)).cast("binary").alias("value"),
        *( [F.col(key_col).cast("string").cast("binary").alias("key")] if key_col else []))
    return out


def produce(stream: DataFrame, producer: str, sink_path: str, checkpoint: str, fmt: str = "parquet",
            trigger: dict | None = None, options: dict | None = None):
    """Start a streaming producer writing messages to ``sink_path`` (file formats) or a Kafka topic
    (``fmt='kafka'`` with ``options``). Returns the started query."""
    msgs = to_messages(stream, producer)
    w = msgs.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt != "kafka":
        w = w.option("path", sink_path)
    return _trigger(w, trigger).start()


def rate_source(spark: SparkSession, rows_per_batch: int = 5) -> DataFrame:
    """A steady producer input: ``rows_per_batch`` rows per micro-batch (with ``processingTime='2 seconds'`` this is
    five messages every two seconds)."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()


def decode_messages(msgs: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Binary JSON payload + headers -> typed columns plus the producer header. A payload that doesn't parse fails the
    query; ``split_messages`` sets it apart instead."""
    return msgs.select(F.col("headers")["producer"].alias("producer"),
                       quarantine.strict(F.col("value").cast("string"), schema).alias("m")).select("producer", "m.*")


def split_messages(msgs: DataFrame, schema: T.StructType | str,
                   keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, broken): decoded messages, and those whose payload doesn't parse as text with the reason; both with the
    producer and the columns in ``keep``."""
    text = msgs.select(*keep, F.col("headers")["producer"].alias("producer"), F.col("value").cast("string").alias("_tw_text"))
    return quarantine.split(text, "_tw_text", schema, [*keep, "producer"])


def consume(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
            trigger: dict | None = None, output_mode: str = "append"):
    """Run ``handler(batch_df, batch_id)`` for every micro-batch; offsets are committed to ``checkpoint`` after the
    handler returns (the acknowledgement). Returns the started query."""
    w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).outputMode(output_mode)
    return _trigger(w, trigger).start()


def idempotent_batch_writer(out_path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler that writes batch ``n`` to ``out_path/batch_id=n`` with overwrite, so a replayed
    batch (after a failure before the commit) replaces its own output instead of duplicating it."""
    def handler(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{out_path}/batch_id={batch_id}")
    return handler


def consume_with_quarantine(stream: DataFrame, schema: T.StructType | str, out_path: str, dead_path: str, checkpoint: str,
                            keep: tuple[str, ...] = (), trigger: dict | None = None):
    """A consumer with two sinks: decoded messages go to ``out_path``, broken ones to ``dead_path``, each batch under
    its own id in both, so a batch that is replayed replaces what it had written to either."""
    def handler(df: DataFrame, batch_id: int) -> None:
        df.persist()  # read for both sinks
        good, broken = split_messages(df, schema, keep)
        broken.write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")
        good.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        df.unpersist()
    return consume(stream, handler, checkpoint, trigger)


def _event_time(spark: SparkSession, checkpoint: str, before: int):
    """The greatest event time of the batches before ``before``, as the last of them has noted it; None at the begin."""
    folder = f"{checkpoint}/_event_time"
    found = [int(n) for n in file_names(spark, folder) or [] if n.isdigit() and int(n) < before]
    text = read_text(spark, f"{folder}/{max(found)}") if found else None
    return datetime.fromisoformat(text) if text else None


def interval_ingest(stream: DataFrame, ts_col: str, out_path: str, checkpoint: str, minutes: int = 5,
                    late_path: str | None = None, delay: timedelta = timedelta(hours=1), trigger: dict | None = None):
    """Land every message in the output of its interval: below ``batch_id=<n>/date_=<day>`` with the interval's begin
    (HHmm) as a column, so a day is a folder and an interval a filter, and an interval without messages makes no output.

    With ``late_path`` the stream has a watermark: the greatest event time of the batches before, less ``delay``.
    Messages whose interval had ended by then go there instead, in the same form, so an interval that the watermark has
    passed doesn't change any more and yet nothing is lost. Messages without a time go there too (else: no date).

    The watermark is noted after a batch's output, which is under the batch's id: a batch that is replayed finds the
    watermark it had and replaces what it wrote. Heavy days are cut to tasks by what the batch holds (AQE); columns of
    any type are only carried."""
    length = minutes * 60_000_000
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(length))).cast("timestamp_ntz")  # no time, no interval

    def write(df: DataFrame, path: str) -> None:
        df.hint("rebalance", "date_").write.mode("overwrite").partitionBy("date_").parquet(path)

    def handler(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.persist()
        rows = df.withColumn("date_", F.to_date(start)).withColumn("interval", F.date_format(start, "HHmm"))
        seen = _event_time(spark, checkpoint, batch_id)
        if late_path is None:
            write(rows, f"{out_path}/batch_id={batch_id}")
        else:
            ended = F.lit(False) if seen is None else \
                start <= F.lit((seen - delay - timedelta(minutes=minutes)).isoformat(" ")).cast("timestamp_ntz")
            late = F.coalesce(ended, F.lit(True)) | start.isNull()
            write(rows.where(late), f"{late_path}/batch_id={batch_id}")
            write(rows.where(~late), f"{out_path}/batch_id={batch_id}")
            newest = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("t")).first().t
            newest = max((x for x in (seen, newest) if x), default=None)
            if newest:
                write_text(spark, f"{checkpoint}/_event_time/{batch_id}", newest.isoformat())
        df.unpersist()
    return consume(stream, handler, checkpoint, trigger)


def interval_counts(stream: DataFrame, ts_col: str, delay: str = "10 minutes", minutes: int = 5) -> DataFrame:
    """Messages per interval, emitted once the watermark passes the interval end (append mode). Zone-less times are
    read as UTC for the watermark (event-time columns must be TIMESTAMP)."""
    et = stream.withColumn("_tw_et", F.col(ts_col).cast("timestamp"))
    return et.withWatermark("_tw_et", delay).groupBy(F.window(F.col("_tw_et"), f"{minutes} minutes").alias("w")) \
        .agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n")


def watermark_stream(stream: DataFrame, keys: list[str], ts_col: str, out_path: str, marks_path: str,
                     checkpoint: str, trigger: dict | None = None):
    """The delta pull per micro-batch: rows newer than the stored per-key mark are written (idempotently per
    batch), then the raised marks are saved (data first, marks after). Marks of batch N are version ``base + N`` of the
    mark table and the batch reads the newest version below that, so a batch that is replayed after its marks were
    saved still finds the marks it began with and writes the same rows again. ``base`` is kept in the checkpoint: a
    new checkpoint goes on behind the versions and batches that are there."""
    spark = stream.sparkSession
    kept = f"{checkpoint}/marks_base"
    if not partition_values(spark, kept, "base", committed=True):
        newest = state.latest_version(spark, marks_path)
        first = 0 if newest is None else newest + 1
        spark.range(1).write.mode("overwrite").parquet(f"{kept}/base={first}")
    base = min(int(v) for v in partition_values(spark, kept, "base", committed=True))

    def handler(df: DataFrame, batch_id: int) -> None:
        spark, version = df.sparkSession, base + batch_id
        df.persist()  # read for the rows and for the marks
        marks = state.read_state(spark, marks_path, below=version)
        fresh, new_marks = api.incremental_watermark(df, marks, keys, ts_col)
        fresh.write.mode("overwrite").parquet(f"{out_path}/batch_id={version}")
        state.upsert_by_key(spark, marks_path, new_marks, keys, version=version)
        df.unpersist()
    return consume(stream, handler, checkpoint, trigger)


TTL_OUT = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                        T.StructField("expires", T.TimestampNTZType())])
#: Of each key of a bucket, as JSON: its value and expiry as of a time up to which all is settled, that time, the
#: operations after that and when its timer fires.
TTL_STATE = "keys string"


#: Stands for the time of an operation without one: it comes first, and what it stores doesn't expire.
_NO_TIME = -(1 << 62)


def _ttl_step(value, expires, ts, op, new, ttl, auto_renew: bool):
    """One operation on (value, expires); times are microseconds, no expiry is None."""
    if value is not None and expires is not None and expires <= ts != _NO_TIME:
        value, expires = None, None
    until = ts + ttl * 1_000_000 if ttl and ts != _NO_TIME else None
    if op == "set" and new is not None:
        return new, until
    if op == "get" and auto_renew and value is not None and ttl > 0:
        return value, until
    return value, expires


def _ttl_ops(pdfs: Iterator[pd.DataFrame]) -> dict:
    """(ts, op, value, ttl) of each row, by key."""
    found = {}
    for pdf in pdfs:
        at = pdf["ts"].to_numpy().astype("datetime64[us]")
        at = np.where(np.isnat(at), _NO_TIME, at.astype("int64"))
        own = (pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in ("key", "op", "value"))
        for t, ttl, key, op, value in zip(at.tolist(), pdf["ttl"].fillna(0).astype("int64").tolist(), *own):
            found.setdefault(key, []).append((t, op, value, ttl))
    return found


def _ttl_key(held: list, new: list, mark: int, auto_renew: bool) -> tuple[list | None, str | None, int | None]:
    """What a key keeps after some operations (value, expiry, time up to which all is settled, operations after that, when
    its timer fires; None: nothing), and the value and expiry it has now."""
    value, expires, done, ops, _ = held
    ops = sorted((x for x in [*map(tuple, ops), *new] if done is None or x[0] > done), key=lambda x: x[0])
    settled = [x for x in ops if x[0] <= mark]  # nothing older can come any more
    for x in settled:
        value, expires = _ttl_step(value, expires, *x, auto_renew)
    ops = ops[len(settled):]
    now, until = value, expires
    for x in ops:
        now, until = _ttl_step(now, until, *x, auto_renew)
    if now is not None and until is not None and until <= mark:
        now, until = None, None
    if now is None and not ops:
        return None, None, None
    if settled and settled[-1][0] != _NO_TIME:
        done = settled[-1][0]
    ends, timer = [x[0] for x in ops] + [t for t in (until, expires) if t is not None], None
    if now is None or until is not None:  # when the watermark is there, all is settled and the value has run out
        timer = max(max(ends) // 1000, mark // 1000) + 1
    return [value, expires, done, ops, timer], now, until


def _ttl_update(auto_renew: bool):
    def fn(_, pdfs: Iterator[pd.DataFrame], st: GroupState) -> Iterator[pd.DataFrame]:
        keys = {k: held for k, *held in json.loads(st.get[0])} if st.exists else {}
        new = {} if st.hasTimedOut else _ttl_ops(pdfs)
        mark, out = st.getCurrentWatermarkMs(), []
        for k in [k for k, held in keys.items() if k not in new and held[-1] is not None and held[-1] < mark]:
            del keys[k]
            out.append((k, None, None))
        for k, ops in new.items():
            held, value, until = _ttl_key(keys.pop(k, [None, None, None, [], None]), ops, mark * 1000, auto_renew)
            if held:
                keys[k] = held
            out.append((k, value, until))
        if keys:
            st.update((json.dumps([[k, *held] for k, held in keys.items()]),))
            timers = [held[-1] for held in keys.values() if held[-1] is not None]
            if timers:  # one that has just run out fires as soon as the watermark goes on
                st.setTimeoutTimestamp(max(min(timers), mark + 1))
        elif st.exists:
            st.remove()
        if out:
            names, values, ends = zip(*out)
            ends = np.array(["NaT" if t is None else t for t in ends], "datetime64[us]")
            yield pd.DataFrame({"key": pd.Series(names, dtype=object), "value": pd.Series(values, dtype=object), "expires": ends})
    return fn


def ttl_state(ops: DataFrame, auto_renew: bool = False, delay: str = "10 minutes",
              buckets: int = 8192) -> DataFrame:
    """Keyed cache state from an operation stream (key, value, op, ts, ttl as in ``operators.ttl``): per key the current
    value and its expiry, updated each micro-batch (output mode ``update``).

    Operations may come out of order by up to ``delay`` of event time: what is younger than the watermark is kept and
    run in order each time, older ones are settled, and one that comes later still is ignored. A value that runs out is
    reported as gone by an event-time timer, and its state goes.

    The state is kept for a hash bucket of keys together: a call for each key costs far more than its operations do. A
    bucket's timer is the earliest of its keys. ``buckets`` is fixed for a checkpoint, as is the form of the state."""
    timed = ops.withColumn("_tw_et", F.col("ts").cast("timestamp")).withWatermark("_tw_et", delay)
    timed = timed.withColumn("_tw_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return timed.groupBy("_tw_bucket").applyInPandasWithState(
        _ttl_update(auto_renew), TTL_OUT, TTL_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def ttl_lookup_batch(ops: DataFrame, as_of: str, auto_renew: bool = False, ties: tuple[str, ...] = ()) -> DataFrame:
    """Batch form: what each key holds at ``as_of`` (``operators.ttl.lookup``)."""
    return ttl.lookup(ops, as_of, ties=ties, auto_renew=auto_renew)
