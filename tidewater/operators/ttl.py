"""A keyed cache with expiry as a state-machine scan.

Each operation is a function from a key's state (nothing, or a value and when it expires) to the next. Functions in a
row compose to one of three: nothing happens; the outcome is known, as a set is among them; or a live value is renewed
(if it lives at the first renewal, and each renewal comes before the one before it has run out). So the operations are
range-partitioned on (key, time), which splits a hot key over many partitions; every partition folds its last key's
operations into one function, the functions are handed on from partition to partition (one row for each), and a second
pass over the same partitions gives every operation the state it meets and the state it leaves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.sequence import PID, _group_begin, _partitions, _row, _starts

#: What an operation does; anything but a set with a value and a renewing read leaves the state.
LOOK, SET, RENEW = 0, 1, 2
#: The expiry of a value without one, in microseconds.
NEVER = (1 << 63) - 1
#: Bytes of scanned files that a task sorts: an operation takes some fifty times as much in memory as in a Parquet file.
SORT_BYTES = 8 << 20
KIND, AT, END = "_tw_kind", "_tw_at", "_tw_end"


def _with_steps(ops: DataFrame, value: str, op: str, ts: str, ttl: str, auto_renew: bool) -> DataFrame:
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    seconds = F.coalesce(F.col(ttl).cast("long"), F.lit(0))
    kind = F.when((F.col(op) == "set") & F.col(value).isNotNull(), SET)
    if auto_renew:
        kind = kind.when((F.col(op) == "get") & (seconds > 0), RENEW)
    return ops.withColumns({KIND: kind.otherwise(LOOK), AT: at,
                            END: F.when(seconds == 0, NEVER).otherwise(at + seconds * 1_000_000)})


class Steps:
    """The operations of a batch in order, behind the state that flows in (``carry``: alive, expiry, value), which acts
    as a set at place 0 for the key that goes on."""

    def __init__(self, batch: pa.RecordBatch, value: str, starts: np.ndarray, carry: tuple[bool, int, pa.Array]):
        kind, at, end = (batch.column(c).to_numpy() for c in (KIND, AT, END))
        self.value = pa.concat_arrays([carry[2], batch.column(value)])
        self.end = np.concatenate([[carry[1]], end])
        kind = np.concatenate([[SET if carry[0] else LOOK], kind])
        self.at = at = np.concatenate([[0], at])
        place = np.arange(len(kind))
        begin = np.concatenate([[0], _group_begin(starts) + 1])
        touch, self.set = (np.maximum.accumulate(np.where(x, place, -1)) for x in (kind != LOOK, kind == SET))
        before = np.concatenate([[-1], touch[:-1]])
        # a renewal of what isn't there or has run out ends the key's value until the next set
        broke = (kind == RENEW) & ((before < begin) | (self.end[before] <= at))
        broke = np.maximum.accumulate(np.where(broke, place, -1))
        self.touch, self.alive = touch, (self.set >= begin) & (broke < self.set)
        met = np.concatenate([[False], self.alive[:-1]]) & (before >= begin)
        self.met = met & (self.end[before] > at)
        self.met_value = np.where(self.met, np.concatenate([[-1], self.set[:-1]]), -1)

    def left(self) -> tuple[bool, int, pa.Array]:
        """The state behind the last operation."""
        alive = bool(self.alive[-1])
        return alive, int(self.end[self.touch[-1]]) if alive else 0, self.value.slice(self.set[-1] if alive else 0, 1)


def _fold(key: str, value: str):
    """The function of a partition's last key, with what its neighbours need to place it."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for b in batches:
            if not b.num_rows:
                continue
            if first is None:
                pid, first, prev = _row(b, [PID], 0)[0], _row(b, [key], 0), None
                n_rows, single, none = 0, True, pa.nulls(1, b.column(value).type)
            starts = _starts(b, [key], prev)
            begin = int(_group_begin(starts)[-1])
            if begin >= 0:
                single = single and n_rows == 0 and begin == 0
                has_set, touched, ok, first_at, last_end, state = False, False, True, 0, 0, (False, 0, none)
            own = b.slice(max(begin, 0))
            steps = Steps(own, value, np.zeros(own.num_rows, bool), state if has_set else (False, 0, none))
            kind = own.column(KIND).to_numpy()
            if has_set or (kind == SET).any():
                has_set, state = True, steps.left()
            elif (kind == RENEW).any():
                at, end = (own.column(c).to_numpy()[kind == RENEW] for c in (AT, END))
                ok = ok and bool((end[:-1] > at[1:]).all()) and (not touched or last_end > at[0])
                first_at, touched, last_end = first_at if touched else int(at[0]), True, int(end[-1])
            n_rows += b.num_rows
            prev = _row(b, [key], b.num_rows - 1)
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pid, first[0], prev[0], *(pa.array([x]) for x in (single, has_set, touched, ok, first_at, state[0],
                                                                   state[1] if has_set else last_end, n_rows)), state[2]],
                names=[PID, "first", "last", "single", "has_set", "touched", "ok", "first_at", "alive", "end", "n_rows",
                       "value"])
    return fn


def _hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that flows into each partition, from the functions of those before it."""
    key, state = None, None
    for b in batches:
        for r in b.to_pylist():
            into = state if state and r["first"] == key else (False, 0, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[PID]], pa.int32()), pa.array([into[0]]), pa.array([into[1]], pa.int64()),
                 pa.array([into[2]], b.column("value").type), pa.array([r["n_rows"]], pa.int64())],
                names=[PID, "_tw_alive", "_tw_until", "_tw_value", "_tw_rows"])
            if not r["single"]:
                into = (False, 0, None)
            if r["has_set"]:
                state = (r["alive"], r["end"], r["value"])
            elif r["touched"]:
                lives = into[0] and into[1] > r["first_at"] and r["ok"]
                state = (True, r["end"], into[2]) if lives else (False, 0, None)
            else:
                state = into
            key = r["last"]


def replay(ops: DataFrame, key: str = "key", value: str = "value", op: str = "op", ts: str = "ts", ttl: str = "ttl",
           ties: Sequence[str] = (), auto_renew: bool = False, num_partitions: int | None = None) -> DataFrame:
    """``ops`` with what each operation met and left: ``met_value`` (null when the key held nothing alive), and
    ``left_value`` with its expiry ``left_until`` (null when it never expires).

    ``op`` is ``set`` (a null value stores nothing), ``get`` (with ``auto_renew`` and a ``ttl`` over 0 it renews a live
    value) or anything else, which only looks. ``ttl`` counts seconds; null or 0 sets no expiry. A value is gone from its
    expiry on and a read does not bring it back. Operations run in the order of ``ts``, then ``ties``. A null key is a
    key; rows without a time come first and meet nothing that expires."""
    n = _partitions(ops, num_partitions, SORT_BYTES)
    df = _with_steps(ops, value, op, ts, ttl, auto_renew)
    df = df.withColumns({AT: F.coalesce(AT, F.lit(-NEVER)), END: F.coalesce(END, F.lit(NEVER))})
    order = [F.col(c).asc_nulls_first() for c in (key, AT, *ties)]
    # both passes read one range exchange (see sequence.py)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(PID, F.spark_partition_id())
    kt, vt = ops.schema[key].dataType, ops.schema[value].dataType
    yes, long = T.BooleanType(), T.LongType()
    names = [(PID, T.IntegerType()), ("first", kt), ("last", kt), *((c, yes) for c in ("single", "has_set", "touched", "ok")),
             ("first_at", long), ("alive", yes), ("end", long), ("n_rows", long), ("value", vt)]
    functions = ranged.mapInArrow(_fold(key, value), T.StructType([T.StructField(*x) for x in names]))
    # an exchange, not coalesce(1): that would run the first pass over all partitions in one task
    carry = functions.repartition(1).sortWithinPartitions(PID).mapInArrow(_hand_on, T.StructType(
        [T.StructField(PID, T.IntegerType()), T.StructField("_tw_alive", yes), T.StructField("_tw_until", long),
         T.StructField("_tw_value", vt), T.StructField("_tw_rows", long)]))
    joined = ranged.join(F.broadcast(carry), PID, "left")  # one row per partition
    columns, value_type = list(ops.columns), [T.StructField("met_value", vt), T.StructField("left_value", vt)]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prev = state = None
        seen, expected = 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            if prev is None:
                prev, expected = _row(b, [key], 0), b.column("_tw_rows")[0].as_py()
                state = b.column("_tw_alive")[0].as_py(), b.column("_tw_until")[0].as_py(), b.column("_tw_value").slice(0, 1)
            seen += b.num_rows
            steps = Steps(b, value, _starts(b, [key], prev), state)
            prev, state = _row(b, [key], b.num_rows - 1), steps.left()
            alive = steps.alive[1:] & (steps.end[steps.touch][1:] > steps.at[1:])
            until = steps.end[steps.touch][1:]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns),
                 steps.value.take(pa.array(steps.met_value[1:], mask=~steps.met[1:])),
                 steps.value.take(pa.array(steps.set[1:], mask=~alive)),
                 pa.array(until, pa.int64(), mask=~alive | (until == NEVER))],
                names=[*columns, "met_value", "left_value", "left_until"])
        if seen != expected:
            raise RuntimeError(f"ttl scan: partition has {seen} rows, the first pass saw {expected}")

    out = joined.mapInArrow(fn, T.StructType([*ops.schema.fields, *value_type, T.StructField("left_until", long)]))
    return out.withColumn("left_until", F.timestamp_micros("left_until").cast("timestamp_ntz"))


def lookup(ops: DataFrame, as_of: str, key: str = "key", value: str = "value", op: str = "op", ts: str = "ts",
           ttl: str = "ttl", ties: Sequence[str] = (), auto_renew: bool = False) -> DataFrame:
    """(key, value, expires): what each key holds at ``as_of``, from the operations up to then; ``expires`` is null for
    a value that never does."""
    till = F.lit(as_of).cast("timestamp_ntz")
    done = replay(ops.where(F.col(ts) <= till), key, value, op, ts, ttl, ties, auto_renew)
    last = done.groupBy(key).agg(F.max_by(F.struct("left_value", "left_until"), F.struct(ts, *ties)).alias("s"))
    return last.select(F.col(key).alias("key"), F.col("s.left_value").alias("value"), F.col("s.left_until").alias("expires")) \
        .where(F.col("value").isNotNull() & (F.col("expires").isNull() | (F.col("expires") > till)))
