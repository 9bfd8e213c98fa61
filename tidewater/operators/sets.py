"""Sorts, limits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.sources.partitions import partition_values


def order_by(df: DataFrame, *cols) -> DataFrame:
    return df.orderBy(*cols)


def priority_sort(df: DataFrame, name: str, priority: DataFrame, priority_name: str, position: str,
                  high: int = 10, low: int = 1, out: str = "weight") -> DataFrame:
    """Weight ``high`` for names on the priority list, ``low`` otherwise; sort by weight descending, keeping the
    original position order within a weight (a stable sort)."""
    p = priority.select(F.col(priority_name).alias("_tw_p")).distinct()
    j = df.join(p, F.col(name) == F.col("_tw_p"), "left")
    w = F.when(F.col("_tw_p").isNotNull(), F.lit(high)).otherwise(F.lit(low))
    return j.withColumn(out, w).drop("_tw_p").orderBy(F.col(out).desc(), F.col(position))


def limit_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First n rows after a total order (top-k: Spark plans a TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(n)


def last_by_key(df: DataFrame, value: str, order: str, group: list[str] | None = None, out: str | None = None
                ) -> DataFrame:
    """Value of the row with the largest ``order`` (per group): ``max_by`` aggregates map-side."""
    out = out or value
    agg = F.max_by(F.col(value), F.col(order)).alias(out)
    return df.groupBy(*group).agg(agg) if group else df.agg(agg)


def offset_page(df: DataFrame, offset: int, limit: int, *order) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


class RankDirectory:
    """A sorted copy of a frame in ranges, with the rows of each counted, so that a page at any offset reads only the
    ranges that hold its ranks. Range bounds are sampled; rows are in the order of all given columns, which should tell
    them apart. Built once for many pages; the counts are one number a range."""

    def __init__(self, df: DataFrame, path: str, *order, ranges: int | None = None):
        self.spark, self.path, self.order = df.sparkSession, path, order
        n = ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_tw_range", F.spark_partition_id()) \
            .write.partitionBy("_tw_range").parquet(path)
        self.schema = df.schema
        counts = self.spark.read.parquet(path).groupBy("_tw_range").count().collect() if \
            partition_values(self.spark, path, "_tw_range") else []
        self.counts = dict(sorted(map(tuple, counts)))

    def ranges_of(self, offset: int, limit: int) -> tuple[list[int], int]:
        """The ranges that hold ranks offset to offset + limit, and the rows before the first of them."""
        found, before, seen = [], 0, 0
        for r, n in self.counts.items():
            if seen + n > offset and seen < offset + limit:
                before = before if found else seen
                found.append(r)
            seen += n
        return found, before

    def page(self, offset: int, limit: int) -> DataFrame:
        found, before = self.ranges_of(offset, limit)
        if not found:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/_tw_range={r}" for r in found])
        return rows.orderBy(*self.order).offset(offset - before).limit(limit)


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def set_union(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def set_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right`` (SQL EXCEPT)."""
    return left.subtract(right)


def parent_prefix(c: Column) -> Column:
    """Parent path of a key: everything before the last `/` (keys without `/` have the empty parent)."""
    return F.regexp_extract(c, r"^(.*)/[^/]*$", 1)


def distinct_prefixes(df: DataFrame, key: str, out: str = "prefix") -> DataFrame:
    return df.select(parent_prefix(F.col(key)).alias(out)).distinct()


def keyed_set_state(ops: DataFrame, key: str = "key", member: str = "value", op: str = "op", ts: str = "ts",
                    seq: str | None = None) -> DataFrame:
    """Replay an add/remove operation log into current set members: the last operation per (key, member) wins
    (``max_by`` over time, ties by ``seq``), and members whose last operation is ``add`` remain; operations that are
    neither ``add`` nor ``remove`` change nothing. The result is one
    row per (key, member) — a set of any size stays distributed; ``collect_set`` is left to bounded callers."""
    order = F.struct(F.col(ts), F.col(seq)) if seq else F.col(ts)
    order = F.when(F.col(op).isin("add", "remove"), order)  # rows without an order don't count
    last = ops.groupBy(key, member).agg(F.max_by(F.col(op), order).alias("_tw_last"))
    return last.where(F.col("_tw_last") == "add").drop("_tw_last")


def set_lookup(state: DataFrame, key: str, member: str, probes: DataFrame) -> DataFrame:
    """For probe rows (key, member): whether the member is in the key's set."""
    hit = state.select(key, member, F.lit(True).alias("is_member"))
    return probes.join(hit, [key, member], "left").withColumn("is_member", F.coalesce("is_member", F.lit(False)))
