"""Skew-proof ordered scans: lead, forward fill and row number within groups.

``Window.partitionBy(k)`` sends every row of one key to one task, so a key holding a third of the data becomes one
task over a third of the data. Here the rows are instead range-partitioned on ``(keys, order)``: the sampled range
bounds split a hot key over many partitions, and each partition is scanned in order by a function on Arrow batches,
which hands columns it doesn't use on as they are (no value changes on the way). What crosses a partition boundary (the next row for ``lead``, the last non-null for forward fill, the row
count so far for numbering) is read from a boundary table with one row per partition, so its size is bounded by the
partition count, never by the data; it is broadcast into the second scan. Both scans reuse one range exchange
(Spark's exchange reuse), so the data is shuffled once.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

PID = "_tw_pid"
#: Bytes of scanned files that one range of an ordered scan gets, about.
RANGE_BYTES = 64 << 20


def _order_cols(order: Sequence) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        elif isinstance(o, tuple):
            name, asc = o
            out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_first())
    return out


def _partitions(df: DataFrame, n: int | None, range_bytes: int = RANGE_BYTES) -> int:
    """As many as the session's shuffles have, and more where the scans below hold more than ``range_bytes`` for each."""
    if n:
        return n
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    size = 0
    while leaves.hasNext():
        own = int(str(leaves.next().stats().sizeInBytes()))
        size += own if own < 1 << 62 else 0  # a source of unknown size says the most there is
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // range_bytes))


def _row(batch: pa.RecordBatch, columns: list[str], i: int) -> list[pa.Array]:
    """Row ``i`` of some columns as arrays of one value."""
    return [batch.column(c).slice(i, 1) for c in columns]


def _starts(batch: pa.RecordBatch, keys: list[str], prev: list[pa.Array] | None) -> np.ndarray:
    """True where a row starts a new group (compared with the row before, the first with ``prev``). Nulls equal nulls
    and NaN equals NaN."""
    same = np.full(batch.num_rows, True)
    for i, k in enumerate(keys):
        col = batch.column(k)
        x = pa.concat_arrays([prev[i] if prev else col.slice(0, 1), col])
        before, now = x.slice(0, len(col)), x.slice(1)
        eq = pc.or_(pc.fill_null(pc.equal(before, now), False), pc.and_(pc.is_null(before), pc.is_null(now)))
        if pa.types.is_floating(col.type):
            eq = pc.or_(eq, pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(now)), False))
        same &= eq.to_numpy(zero_copy_only=False)
    if prev is None:
        same[:1] = False
    return ~same


def _group_begin(starts: np.ndarray) -> np.ndarray:
    """For each row the place of the last start up to it, -1 where the group goes on from before."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), -1))


def _boundary_schema(df: DataFrame, keys: list[str], value: str | None) -> T.StructType:
    fields = [T.StructField(PID, T.IntegerType())]
    for side in ("first", "last"):
        for k in keys:
            fields.append(T.StructField(f"{side}_{k}", df.schema[k].dataType))
    fields.append(T.StructField("n_rows", T.LongType()))
    fields.append(T.StructField("n_last_group", T.LongType()))
    if value is not None:
        vt = df.schema[value].dataType
        fields += [T.StructField("first_value", vt), T.StructField("last_group_last_value", vt),
                   T.StructField("last_group_has_value", T.BooleanType())]
    return T.StructType(fields)


def _boundaries(keys: list[str], value: str | None, weight: str | None = None):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = value_type = None
        n_rows = n_last = 0
        for b in batches:
            if not b.num_rows:
                continue
            if first is None:
                pid, first = _row(b, [PID], 0)[0], _row(b, keys, 0)
                if value is not None:
                    first_value, value_type = b.column(value).slice(0, 1), b.column(value).type
                    last_value, has_value = pa.nulls(1, value_type), False
            # the last group of this batch, and whether it continues the running last group
            begin = int(_group_begin(_starts(b, keys, last))[-1])
            if begin >= 0:
                n_last = 0
                if value is not None:
                    last_value, has_value = pa.nulls(1, value_type), False
            begin = max(begin, 0)
            n_last += pc.sum(b.column(weight).slice(begin)).as_py() if weight else b.num_rows - begin
            if value is not None:
                known = b.column(value).slice(begin).drop_null()
                if len(known):
                    last_value, has_value = known.slice(len(known) - 1), True
            last = _row(b, keys, b.num_rows - 1)
            n_rows += b.num_rows
        if first is None:
            return
        row = {PID: pid} | {f"first_{k}": x for k, x in zip(keys, first)} | {f"last_{k}": x for k, x in zip(keys, last)}
        row |= {"n_rows": pa.array([n_rows], pa.int64()), "n_last_group": pa.array([n_last], pa.int64())}
        if value is not None:
            row |= {"first_value": first_value, "last_group_last_value": last_value,
                    "last_group_has_value": pa.array([has_value])}
        yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    return fn


def _carries(bounds: DataFrame, keys: list[str], value: str | None, want: str) -> DataFrame:
    """Per partition, what flows in across its boundaries (tiny: one row per partition).

    Every partition contributes an "offer" row and an "ask" row from a single pass over the boundary table; a
    window over that tiny table hands each ask the matching offer of a neighbouring partition with the same key.
    """
    first = [F.col(f"first_{k}").alias(k) for k in keys]
    last = [F.col(f"last_{k}").alias(k) for k in keys]
    if want == "lead":
        # the next partition whose first key equals my last key hands its first value back to my last row
        payload = F.struct(F.col("first_value").alias("v"))
        offer_keys, ask_keys, offer_kind, ask_kind = first, last, 0, 1
    elif want == "ffill":
        # earlier partitions ending in my first key hand their last non-null value forward
        payload = F.when(F.col("last_group_has_value"), F.struct(F.col("last_group_last_value").alias("v")))
        offer_keys, ask_keys, offer_kind, ask_kind = last, first, 1, 0
    else:
        payload = F.struct(F.col("n_last_group").alias("v"))
        offer_keys, ask_keys, offer_kind, ask_kind = last, first, 1, 0
    ptype = bounds.select(payload.alias("p")).schema["p"].dataType
    # the ask row also carries the partition's row count, which the main pass checks against what it reads
    offer = F.struct(F.col(PID).alias(PID), *offer_keys, payload.alias("payload"), F.lit(offer_kind).alias("kind"),
                     F.lit(None).cast("bigint").alias("_tw_nrows"))
    ask = F.struct(F.col(PID).alias(PID), *ask_keys, F.lit(None).cast(ptype).alias("payload"),
                   F.lit(ask_kind).alias("kind"), F.col("n_rows").alias("_tw_nrows"))
    rows = bounds.select(F.explode(F.array(offer, ask)).alias("r")).select("r.*")
    order = Window.partitionBy(*keys).orderBy(F.col(PID), F.col("kind"))
    if want == "lead":
        carry = F.first("payload", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
        got = rows.withColumn("c", carry)
        return got.where(F.col("kind") == ask_kind).select(
            F.col(PID), F.col("c.v").alias("_tw_carry"), F.col("c").isNotNull().alias("_tw_has_carry"), "_tw_nrows")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    if want == "ffill":
        carry = F.last("payload", ignorenulls=True).over(before).getField("v")
    else:
        carry = F.sum(F.col("payload").getField("v")).over(before)
    got = rows.withColumn("c", carry)
    return got.where(F.col("kind") == ask_kind).select(
        F.col(PID), F.col("c").alias("_tw_carry"), F.col("c").isNotNull().alias("_tw_has_carry"), "_tw_nrows")


def _scan(df: DataFrame, keys: list[str], order: Sequence, value: str | None, out: str, want: str,
          num_partitions: int | None, out_type: T.DataType, weight: str | None = None) -> DataFrame:
    n = _partitions(df, num_partitions)
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        # both passes must read one range exchange; two exchanges would sample their bounds independently
        raise ValueError("ordered scans need spark.sql.exchange.reuse=true")
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + _order_cols(order)
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols) \
        .withColumn(PID, F.spark_partition_id())
    # The boundary pass must read the very same range exchange as the main pass (Spark reuses it, so the data is
    # shuffled once and both passes see identical partition bounds). Projecting columns away here would let
    # Catalyst push the projection below the exchange and plan a second, separately sampled one.
    bounds = ranged.mapInArrow(_boundaries(keys, value if want != "rownum" else None, weight),
                               _boundary_schema(df, keys, value if want != "rownum" else None))
    carry = _carries(bounds, keys, value, want)
    # one row per partition: a proven size bound, so the broadcast is safe at any data size
    joined = ranged.join(F.broadcast(carry), on=PID, how="left")
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(out, out_type)])
    data_cols = list(df.columns)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prev = None               # keys of the last row seen
        state = None              # running last non-null (ffill) / running count (rownum)
        held = None               # lead: last row of the previous batch, waiting for its successor
        carry = expected = None
        seen = 0

        def with_out(b: pa.RecordBatch, found: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, out])

        for b in batches:
            if not b.num_rows:
                continue
            if not seen:
                carry, expected = b.column("_tw_carry").slice(0, 1), b.column("_tw_nrows")[0].as_py()
                if want != "lead" and b.column("_tw_has_carry")[0].as_py():
                    prev, state = _row(b, keys, 0), carry
            seen += b.num_rows
            b = b.select(data_cols)
            n = b.num_rows
            if want == "lead":
                if held is not None:
                    b = pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(held.columns, b.columns)],
                                                   names=data_cols)
                last = b.num_rows - 1
                if last:
                    goes_on = pa.array(~_starts(b, keys, None)[1:])
                    following = b.column(value).slice(1)
                    yield with_out(b.slice(0, last), following.take(pc.if_else(
                        goes_on, pa.array(np.arange(last)), pa.scalar(None, pa.int64()))))
                held = b.slice(last)
                continue
            begin = _group_begin(_starts(b, keys, prev))
            if want == "ffill":
                v = b.column(value)
                # the value that flows in stands in front, at place 0; rows of the group that goes on may take it
                chain = pa.concat_arrays([state if state is not None else pa.nulls(1, v.type), v])
                at = np.arange(1, n + 1)
                known = np.maximum.accumulate(np.where(v.is_valid().to_numpy(zero_copy_only=False), at, 0))
                found = chain.take(pa.array(known, mask=known < begin + 1))
                state = found.slice(n - 1)
            else:
                w = b.column(weight).to_numpy(zero_copy_only=False).astype(np.int64) if weight else np.ones(n, np.int64)
                total = np.concatenate([[0], np.cumsum(w)])
                before = state[0].as_py() if state is not None else 0
                found = pa.array(total[1:] - np.where(begin < 0, -before, total[np.maximum(begin, 0)]), pa.int64())
                state = found.slice(n - 1)
            prev = _row(b, keys, n - 1)
            yield with_out(b, found)
        if seen and expected != seen:
            # the boundary pass saw a different partitioning: never emit results built on wrong carries
            raise RuntimeError(f"ordered scan: partition has {seen} rows, boundary pass recorded {expected}")
        if held is not None:
            yield with_out(held, carry)

    return joined.mapInArrow(fn, out_schema)


def lead_within(df: DataFrame, keys: list[str], order: Sequence, value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """``lead(value) OVER (PARTITION BY keys ORDER BY order)`` without a one-task-per-key window."""
    return _scan(df, keys, order, value, out, "lead", num_partitions, df.schema[value].dataType)


def ffill_within(df: DataFrame, keys: list[str], order: Sequence, value: str, out: str,
                 num_partitions: int | None = None) -> DataFrame:
    """``last(value, ignorenulls) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``."""
    return _scan(df, keys, order, value, out, "ffill", num_partitions, df.schema[value].dataType)


def row_number_within(df: DataFrame, keys: list[str], order: Sequence, out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``; with ``keys=[]`` a global 1-based row index in
    order, computed without a single-partition window."""
    if not keys:
        df = df.withColumn("_tw_all", F.lit(0))
        res = _scan(df, ["_tw_all"], order, None, out, "rownum", num_partitions, T.LongType())
        return res.drop("_tw_all")
    return _scan(df, keys, order, None, out, "rownum", num_partitions, T.LongType())


def running_sum_within(df: DataFrame, keys: list[str], order: Sequence, weight: str, out: str,
                       num_partitions: int | None = None) -> DataFrame:
    """``sum(weight) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)`` for a non-negative integer
    weight (e.g. the row count behind a pre-aggregated value); ``keys=[]`` runs over the whole frame."""
    if not keys:
        df = df.withColumn("_tw_all", F.lit(0))
        return _scan(df, ["_tw_all"], order, None, out, "rownum", num_partitions, T.LongType(), weight) \
            .drop("_tw_all")
    return _scan(df, keys, order, None, out, "rownum", num_partitions, T.LongType(), weight)
