"""Window-style operators, built on the skew-proof ordered scans of ``sequence``.

None of them uses ``Window.partitionBy(key)`` on data, and none uses an unpartitioned window for global numbering.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sequence import ffill_within, lead_within, row_number_within


def lead_event(df: DataFrame, keys: list[str], order: Sequence, value: str, out: str = "next_value") -> DataFrame:
    """Next value in the same group by order (ties must be broken by the caller's order list, e.g. an event id)."""
    return lead_within(df, keys, order, value, out)


def forward_fill(df: DataFrame, keys: list[str], order: Sequence, value: str, out: str | None = None,
                 strict: bool = False, treat_zero_as_missing: bool = False) -> DataFrame:
    """Fill nulls with the last non-null value of the group in order. ``strict`` makes a missing first value of a
    group an error; ``treat_zero_as_missing`` reproduces the source rule's treatment of 0 as missing."""
    out = out or value
    src = value
    d = df
    if treat_zero_as_missing:
        d = d.withColumn("_tw_ff_src", F.when(F.col(value) != 0, F.col(value)))
        src = "_tw_ff_src"
    res = ffill_within(d, keys, order, src, "_tw_ff")
    if strict:
        res = res.withColumn("_tw_ff", F.when(F.col("_tw_ff").isNull(),
                                              F.raise_error(F.lit("forward fill: a group begins without a value")))
                             .otherwise(F.col("_tw_ff")))
    cols = [c for c in df.columns if c != out] + ["_tw_ff"]
    return res.select(*cols).withColumnRenamed("_tw_ff", out).select(*(df.columns if out in df.columns
                                                                      else df.columns + [out]))


def retain_last_n(df: DataFrame, keys: list[str], version: str, n: int = 100, as_int: bool = True,
                  return_dropped: bool = True) -> DataFrame:
    """Keep the newest ``n`` versions per key; versions sort as integers. Returns the versions to drop (default,
    a dry-run plan) or the versions kept. Groups with at most n versions lose nothing."""
    d = df.withColumn("_tw_v", F.col(version).cast("bigint") if as_int else F.col(version))
    ranked = row_number_within(d, keys, [("_tw_v", False)], "_tw_rank")
    cond = F.col("_tw_rank") > n if return_dropped else F.col("_tw_rank") <= n
    return ranked.where(cond).drop("_tw_v")


def assign_ids(df: DataFrame, order: Sequence, out: str = "id", start: int = 0) -> DataFrame:
    """Consecutive ids in order, starting at ``start`` (0-based by default), without a single-partition window."""
    res = row_number_within(df, [], order, "_tw_rn")
    return res.withColumn(out, F.col("_tw_rn") - 1 + start).drop("_tw_rn")


def assign_chunk(df: DataFrame, order: Sequence, size: int, out: str = "chunk") -> DataFrame:
    """Chunk number ``floor(position / size)`` of each row in order (chunks of ``size``, the last may be short)."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    res = row_number_within(df, [], order, "_tw_rn")
    return res.withColumn(out, F.floor((F.col("_tw_rn") - 1) / size).cast("bigint")).drop("_tw_rn")


def chunk_lists(chunked: DataFrame, chunk: str, value: str, order: str) -> DataFrame:
    """Members of each chunk as an ordered list (a chunk holds at most ``size`` rows, so the list is bounded)."""
    st = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    return chunked.groupBy(chunk).agg(F.transform(F.array_sort(F.collect_list(st)), lambda x: x["v"]).alias("items"))


def throttle(df: DataFrame, keys: list[str], ts: str, minutes: int = 15, out: str = "should_act",
             tiebreak: str | None = None) -> DataFrame:
    """True when at least ``minutes`` passed since the previous action of the same key (or there was none).
    The previous time is a ``lead`` over descending time, so it runs on the skew-proof scan as well."""
    order = [(ts, False)] + ([(tiebreak, False)] if tiebreak else [])
    d = lead_within(df, keys, order, ts, "_tw_prev")
    ok = F.coalesce(F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)) >= F.col("_tw_prev"),
                    F.lit(True))
    return d.withColumn(out, ok).drop("_tw_prev")
