"""Aggregations.

All group aggregates are declarative ``groupBy().agg`` so Spark combines map-side before the shuffle (a hot key
sends one partial row per map task, not its rows). Exact quantiles are the exception Spark has no skew-proof
built-in for (``percentile`` merges every distinct value of a group in one task), so they are computed by rank:
a range-partitioned running count over pre-aggregated values (see ``sequence``) and the few target ranks per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sequence import lead_within, running_sum_within
from tidewater.session import scratch_path

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def qname(q: float) -> str:
    return "q" + f"{q:.2f}".split(".")[1]


def group_count_distinct(df: DataFrame, group: list[str], value: str, out: str = "n_distinct") -> DataFrame:
    """Distinct non-null values per group; rows with a null group key are dropped (pandas ``nunique``)."""
    keep = F.col(value).isNotNull()
    for g in group:
        keep = keep & F.col(g).isNotNull()
    return df.where(keep).groupBy(*group).agg(F.countDistinct(value).alias(out))


def exact_quantiles(df: DataFrame, group: list[str], value: str, probs=QUANTILES,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas/``quantile_cont``) per group, or globally with
    ``group=[]``; nulls are skipped, NaN is a value above all others. One output column per probability, named by
    ``qname``.

    Equal values collapse first into (group, value, multiplicity) rows (a map-side-combined aggregate), then
    ``_quantiles_by_rank`` picks the target ranks. The plan is the same at every size, runs no job while it is being
    built and never gathers a group in one task.
    """
    base = df.where(F.col(value).isNotNull())
    for g in group:
        base = base.where(F.col(g).isNotNull())
    key = list(group) if group else ["_tw_all"]
    if not group:
        base = base.withColumn("_tw_all", F.lit(0))
    vc = base.groupBy(*key, value).agg(F.count(F.lit(1)).alias("_tw_c"))
    out = _quantiles_by_rank(vc, key, value, probs, num_partitions)
    return out.drop("_tw_all") if not group else out


def _quantiles_by_rank(vc: DataFrame, group: list[str], value: str, probs, num_partitions: int | None) -> DataFrame:
    """Quantiles from (group, value, ``_tw_c`` multiplicity) rows without a per-group merge: a skew-proof running
    count in value order gives each distinct value its rank range ``[cum - c, cum)``; joined with one row of target
    ranks per group (``floor``/``ceil`` of ``(n-1)p``), each target rank picks exactly one value."""
    cum = running_sum_within(vc, group, [value], "_tw_c", "_tw_cum", num_partitions)
    counts = vc.groupBy(*group).agg(F.sum("_tw_c").alias("_tw_n")) if group else \
        vc.agg(F.sum("_tw_c").alias("_tw_n"))
    tcols = []
    for i, p in enumerate(probs):
        pos = (F.col("_tw_n") - 1).cast("double") * F.lit(float(p))
        tcols += [pos.alias(f"_tw_pos{i}"), F.floor(pos).cast("bigint").alias(f"_tw_lo{i}"),
                  F.ceil(pos).cast("bigint").alias(f"_tw_hi{i}")]
    targets = counts.select(*group, *tcols)
    if group == ["_tw_all"]:
        # the whole frame is one group: its targets are a single row, read as a scalar subquery (no join)
        names = [c for c in targets.columns if c != "_tw_all"]
        s = targets.select(F.struct(*names)).scalar()
        j = cum.withColumns({n: s.getField(n) for n in names})
    else:
        # one row per group; AQE broadcasts it when small and splits a hot group's partition otherwise
        theirs = targets.withColumnsRenamed({g: f"_tw_of_{g}" for g in group})
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_tw_of_{g}"))
        j = cum.join(theirs, same)
    start, end, v = F.col("_tw_cum") - F.col("_tw_c"), F.col("_tw_cum"), F.col(value)
    hit = lambda r: (start <= r) & (r < end)
    any_hit = None
    for i in range(len(probs)):
        h = hit(F.col(f"_tw_lo{i}")) | hit(F.col(f"_tw_hi{i}"))
        any_hit = h if any_hit is None else any_hit | h
    aggs = []
    for i in range(len(probs)):
        aggs += [F.max(F.when(hit(F.col(f"_tw_lo{i}")), v)).alias(f"_tw_vlo{i}"),
                 F.max(F.when(hit(F.col(f"_tw_hi{i}")), v)).alias(f"_tw_vhi{i}"),
                 F.max(f"_tw_pos{i}").alias(f"_tw_pos{i}"), F.max(f"_tw_lo{i}").alias(f"_tw_lo{i}")]
    picked = j.where(any_hit)
    g = picked.groupBy(*group).agg(*aggs) if group else picked.agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        lo_v, hi_v = F.col(f"_tw_vlo{i}"), F.col(f"_tw_vhi{i}")
        out.append((lo_v + (F.col(f"_tw_pos{i}") - F.col(f"_tw_lo{i}")) * (hi_v - lo_v)).alias(qname(p)))
    return g.select(*group, *out)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a copy in the shared folder, for results that several plans read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_quantiles_fallback(df: DataFrame, group: str, value: str, distinct_of: str, min_distinct: int = 10,
                             probs=QUANTILES, count_name: str = "offers") -> DataFrame:
    """Groups with more than ``min_distinct`` distinct ``distinct_of`` values get their own quantiles of ``value``;
    the others get the global quantiles. One row per group with its distinct count and the quantile columns.

    ``df`` is read once: its (group, value, ``distinct_of``) counts are written down, and the distinct counts and both
    kinds of quantiles come from them. The whole is one more group in the same ordered scan, whose result (a row per
    group) is written down too and read as the groups' rows and as the one row of the whole.
    """
    whole, c = "_tw_whole", "_tw_c"
    base = _written(df.groupBy(group, value, distinct_of).agg(F.count(F.lit(1)).alias(c)), "quantile-counts")
    counts = group_count_distinct(base, [group], distinct_of, count_name)
    known = base.where(F.col(value).isNotNull())
    each = known.where(F.col(group).isNotNull()).groupBy(group, value).agg(F.sum(c).alias(c)).withColumn(whole, F.lit(0))
    total = known.groupBy(value).agg(F.sum(c).alias(c)).withColumns(
        {whole: F.lit(1), group: F.lit(None).cast(df.schema[group].dataType)})
    found = _written(_quantiles_by_rank(each.unionByName(total), [whole, group], value, probs, None), "quantiles")
    own, glob = found.where(f"{whole} = 0").drop(whole), found.where(f"{whole} = 1")
    g = glob.select(F.struct(*[F.col(qname(p)) for p in probs])).scalar()
    j = counts.join(own, group, "left")
    cols = [F.when(F.col(count_name) > min_distinct, F.col(qname(p))).otherwise(g.getField(qname(p)))
            .alias(qname(p)) for p in probs]
    return j.select(group, count_name, *cols)


def session_group_max(df: DataFrame, group: list[str], value, out: str) -> DataFrame:
    return df.groupBy(*group).agg(F.max(value).alias(out))


def case_count(df: DataFrame, where: Column | None = None, out: str = "value") -> DataFrame:
    """Row count (under an optional predicate), reported as -1 when zero."""
    d = df if where is None else df.where(where)
    n = F.count(F.lit(1))
    return d.agg(F.when(n == 0, F.lit(-1)).otherwise(n).cast("bigint").alias(out))


def count_rows_where(df: DataFrame, where: Column, out: str = "n") -> DataFrame:
    return df.where(where).agg(F.count(F.lit(1)).alias(out))


def max_of_group_sums(df: DataFrame, group: list[str], value: str, out: str = "max_sum") -> DataFrame:
    """``coalesce(max(sum(value) per group), 0)``: two aggregation levels, the second over one row per group."""
    sums = df.groupBy(*group).agg(F.sum(value).alias("_tw_s"))
    return sums.agg(F.coalesce(F.max("_tw_s"), F.lit(0)).alias(out))


def top_sum_group(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """The group with the largest sum; ties go to the group whose first row (by ``pos``) is latest."""
    s = df.groupBy(key).agg(F.sum(value).alias("total"), F.min(pos).alias("_tw_first"))
    return s.orderBy(F.col("total").desc(), F.col("_tw_first").desc()).limit(1).drop("_tw_first")


def missing_number_sorted(df: DataFrame, value: str) -> DataFrame:
    """The one missing value of 1..n+1 (n = row count): 1 if absent, n+1 if the maximum is not n+1, else the
    arithmetic-series difference. One aggregate pass."""
    a = df.agg(F.min(value).alias("mn"), F.max(value).alias("mx"), F.count(value).alias("n"),
               F.sum(F.col(value).cast("decimal(19,0)")).alias("s"))
    n = F.col("n").cast("decimal(19,0)")  # the products pass 2^53 long before the ids pass 2^63
    return a.select(F.when(F.col("mn") != 1, F.lit(1).cast("bigint"))
                    .when(F.col("mx") != n + 1, (n + 1).cast("bigint"))
                    .otherwise(((n + 1) * (n + 2) / 2 - F.col("s")).cast("bigint")).alias("missing"))


def missing_ranges(df: DataFrame, value: str, num_partitions: int | None = None) -> DataFrame:
    """(first_missing, last_missing, n_missing): the gaps between the least and the greatest of the whole numbers in
    ``value``, one row for each.

    The numbers present become bitmaps, a word of 64 for each run of 64 numbers, which combine map-side: 64 neighbours
    cost one row, lone ones a row each, and repeated ones nothing. Gaps within a word are read from its bits; those
    between words from one word's last number to the next one's first, in an ordered scan. No number that is missing is
    ever made into a row, and nothing comes to the driver. Nulls don't count."""
    v = F.col(value).cast("bigint")
    words = df.select(v.alias("v")).where("v is not null").groupBy(F.expr("shiftright(v, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(v & 63 as int)))").alias("bits"))
    held = words.select(F.lit(0).alias("all"), "word", F.expr(
        "transform(filter(sequence(0, 63), i -> shiftright(bits, i) & 1 = 1), i -> shiftleft(word, 6) + i)").alias("held"))
    held = held.withColumn("first", F.element_at("held", 1))
    after = lead_within(held, ["all"], ["word"], "first", "next", num_partitions)
    whole = F.when(F.col("next").isNull(), F.col("held")).otherwise(F.concat("held", F.array("next")))
    gaps = after.select(whole.alias("h")).select(F.explode(F.expr(
        "filter(transform(sequence(1, size(h)), i -> struct(h[i - 1] + 1 as a, get(h, i) - 1 as b)), g -> g.b >= g.a)"))
        .alias("g"))
    return gaps.select(F.col("g.a").alias("first_missing"), F.col("g.b").alias("last_missing"),
                       (F.col("g.b") - F.col("g.a") + 1).alias("n_missing"))


def missing_values(df: DataFrame, value: str) -> DataFrame:
    """General form: every integer between min and max of ``value`` that does not occur, a row for each."""
    gaps = missing_ranges(df, value)
    return gaps.select(F.explode(F.sequence("first_missing", "last_missing")).alias("missing"))


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.length(column).alias("key_length")).agg(F.count(F.lit(1)).alias("n_keys"))


def large_keys(df: DataFrame, column: str, min_length: int = 5000) -> DataFrame:
    return df.where(F.length(column) > min_length)


def json_group_concat(df: DataFrame, group: list[str], fields: list[str], order_field: str,
                      out: str = "columns") -> DataFrame:
    """Per group, a JSON array of ``{field: value}`` objects ordered by ``order_field``."""
    st = F.struct(F.col(order_field).alias("_tw_o"), F.struct(*[F.col(f) for f in fields]).alias("obj"))
    arr = F.transform(F.array_sort(F.collect_list(st)), lambda x: x["obj"])
    return df.groupBy(*group).agg(F.to_json(arr).alias(out))


def prefix_sizes(df: DataFrame, prefix: Column, size: str, out: str = "size_mb") -> DataFrame:
    return df.groupBy(prefix.alias("prefix")).agg((F.sum(size) / F.lit(1048576.0)).alias(out))


def product_nonzero_agg(df: DataFrame, group: list[str], value: str, out: str = "product") -> DataFrame:
    """Product of the non-zero values per group (zeros and nulls skipped; an all-zero group gives 1)."""
    v = F.when(F.col(value) != 0, F.col(value))
    return df.groupBy(*group).agg(F.coalesce(F.product(v), F.lit(1.0)).alias(out))


def failure_summary(df: DataFrame, record: str, failed: Column, group: list[str] | None = None) -> DataFrame:
    """Distinct failed records, total records and the ``failed of total`` text, per group or of all."""
    a = df.groupBy(*group or []).agg(F.countDistinct(F.when(failed, F.col(record))).alias("failed"),
                                     F.countDistinct(record).alias("total"))
    return a.withColumn("summary", F.format_string("%d of %d", F.col("failed"), F.col("total")))
