"""Quantiles from mergeable sketches.

A sketch per day and group is built once (map-side combined, a few kB each) and merged for any range of days and any
coarser group, without going back to the values. Spark's KLL sketches bound the rank of an answer, not its value: the
value for probability p has a rank within ``error`` of p. ``k_for`` picks the sketch's size for an error that holds for
practically every answer (KLL states its own bound for 99 of 100; this asks for a quarter of the error there).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.aggregates import QUANTILES, qname

SKETCH = "sketch"


def k_for(error: float) -> int:
    """The size parameter at which KLL's stated rank error, 2.296 / k ** 0.9723, is a quarter of ``error``."""
    k = math.ceil((2.296 * 4 / error) ** (1 / 0.9723))
    if not 0 < error < 1 or k > 65535:
        raise ValueError("error must be between 0.0002 and 1")
    return max(k, 8)


def quantile_sketches(df: DataFrame, group: list[str], value: str, error: float = 0.01) -> DataFrame:
    """One row per group: its columns, ``n`` values and their sketch. Nulls and NaN don't count; a null group is a group."""
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.select(*group, v.alias("_tw_v")).where(F.col("_tw_v").isNotNull()).groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_tw_v", F.lit(k_for(error))).alias(SKETCH))


def merge_sketches(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of a coarser group, from those of its parts."""
    return sketches.groupBy(*group).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def quantiles_of(sketches: DataFrame, group: list[str], probs=QUANTILES) -> DataFrame:
    """Per group ``n`` and a value for each probability, in columns named by ``qname``."""
    return sketches.select(*group, "n", *[F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))).alias(qname(p))
                                          for p in probs])


def rank_errors(df: DataFrame, answers: DataFrame, group: list[str], value: str, probs=QUANTILES) -> DataFrame:
    """How far off each answer's rank is: (group, prob, n, error), the distance from p to the ranks that the value has
    among all of its group (a run of equal values has a range of ranks)."""
    v = F.col(f"v.{value}").cast("double")
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"v.{g}").eqNullSafe(F.col(f"a.{g}"))
    values = df.select(*group, value).where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = values.alias("v").join(answers.alias("a"), same).groupBy(*[F.col(f"a.{g}") for g in group]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((v < F.col(f"a.{qname(p)}")).cast("long")).alias(f"below_{i}") for i, p in enumerate(probs)],
        *[F.sum((v <= F.col(f"a.{qname(p)}")).cast("long")).alias(f"upto_{i}") for i, p in enumerate(probs)])
    each = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.greatest(
        F.lit(0.0), F.col(f"below_{i}") / F.col("n") - float(p), float(p) - F.col(f"upto_{i}") / F.col("n")).alias("error"))
        for i, p in enumerate(probs)])
    return counted.select(*group, "n", F.explode(each).alias("e")).select(*group, "n", "e.prob", "e.error")
