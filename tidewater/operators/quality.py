"""Data quality and monitoring.

A check is a named one-value aggregate over a DataFrame plus a pass condition. Checks that read the same
DataFrame are evaluated in ONE aggregation pass (one scan, map-side partial aggregates), then unpivoted into rows,
so adding checks on a table does not add scans of it.
"""

from __future__ import annotations

import re

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Comparison operator codes used by the check configuration.
EQUAL = 0
NOT_EQUAL = 1
LESS_THAN = 2
LESS_THAN_OR_EQUAL = 3
GREATER_THAN = 4
GREATER_THAN_OR_EQUAL = 5


@dataclass
class Check:
    task_id: str
    source: DataFrame
    value: Column                       # an aggregate expression yielding one value
    operator: int = GREATER_THAN_OR_EQUAL
    threshold: float = 0.0
    name: str = ""
    params: dict = field(default_factory=dict)


def compare(value: Column, operator: int, threshold: Column) -> Column:
    """The passing condition for an operator code."""
    ops = {
        EQUAL: lambda a, b: a == b, NOT_EQUAL: lambda a, b: a != b, LESS_THAN: lambda a, b: a < b,
        LESS_THAN_OR_EQUAL: lambda a, b: a <= b, GREATER_THAN: lambda a, b: a > b,
        GREATER_THAN_OR_EQUAL: lambda a, b: a >= b,
    }
    if operator not in ops:
        raise ValueError(f"unknown operator code {operator}")
    return F.coalesce(ops[operator](value, threshold), F.lit(False))


def _evaluate(groups: dict[int, tuple[DataFrame, list]]) -> DataFrame:
    parts = []
    for _, (src, items) in groups.items():
        aggs = [it[1].cast("double").alias(f"_tw_v{i}") for i, it in enumerate(items)]
        one = src.agg(*aggs)
        rows = F.array(*[F.struct(F.lit(it[0]).alias("task_id"), F.col(f"_tw_v{i}").alias("value"),
                                  F.lit(float(it[3])).alias("threshold"),
                                  compare(F.col(f"_tw_v{i}"), it[2], F.lit(float(it[3]))).alias("passed"))
                         for i, it in enumerate(items)])
        parts.append(one.select(F.explode(rows).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def threshold_checks(checks: list[Check]) -> DataFrame:
    """(task_id, value, threshold, passed) per check; checks on the same source share one scan."""
    groups: dict[int, tuple[DataFrame, list]] = {}
    for c in checks:
        key = id(c.source)
        groups.setdefault(key, (c.source, []))[1].append((c.task_id, c.value, c.operator, c.threshold))
    return _evaluate(groups)


def health_checks(checks: list[tuple[str, DataFrame, Column, str, float]]) -> DataFrame:
    """(task_id, source, value expr, check_type, target): ``exact`` passes when value = target, ``range`` when
    0 <= value <= target."""
    groups: dict[int, tuple[DataFrame, list]] = {}
    for task_id, src, value, kind, target in checks:
        op_code = EQUAL if kind == "exact" else LESS_THAN_OR_EQUAL
        groups.setdefault(id(src), (src, []))[1].append((task_id, value, op_code, target))
    res = _evaluate(groups)
    kinds = {c[0]: c[3] for c in checks}
    kind_col = F.create_map(*[x for k, v in kinds.items() for x in (F.lit(k), F.lit(v))])[F.col("task_id")]
    return res.withColumn("check_type", kind_col).withColumn(
        "passed", F.col("passed") & ((kind_col == "exact") | (F.col("value") >= 0)))


def freshness_monitor(tables: list[tuple[str, DataFrame, str, Column | None, int]], as_of: str | datetime,
                      ) -> DataFrame:
    """(table, source, time column, optional condition, allowed delay in hours) -> (table, latest, lag_hours,
    target_hours, late). One max-aggregate per table; a table with no qualifying rows is late."""
    parts = []
    now = F.lit(as_of).cast("timestamp_ntz")
    for name, src, column, cond, target in tables:
        d = src if cond is None else src.where(cond)
        latest = d.agg(F.max(F.col(column)).cast("timestamp_ntz").alias("latest"))
        micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))
        lag = F.floor(micros / F.lit(3_600_000_000)).cast("bigint")
        parts.append(latest.select(F.lit(name).alias("table"), "latest", lag.alias("lag_hours"),
                                   F.lit(int(target)).alias("target_hours"),
                                   F.coalesce(lag > int(target), F.lit(True)).alias("late")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def funnel_ratio(df: DataFrame, group: list[str], event: str, shown: str, clicked: str, threshold: float = 50.0,
                 operator: int = GREATER_THAN_OR_EQUAL) -> DataFrame:
    """Per group: 100 * clicks / shown (null when nothing was shown) and whether it passes the threshold."""
    a = df.groupBy(*group).agg(F.count(F.when(F.col(event) == shown, 1)).alias("shown"),
                               F.count(F.when(F.col(event) == clicked, 1)).alias("clicked"))
    ratio = F.try_divide(F.col("clicked") * 100.0, F.col("shown"))
    return a.withColumn("ratio", ratio).withColumn("passed", compare(F.col("ratio"), operator, F.lit(threshold)))


def notify_messages(results: DataFrame, template: str, names: dict | None = None, **context) -> DataFrame:
    """Message text for every failed check: ``template`` is a format string with ``{task_id}``, ``{value}``,
    ``{threshold}`` and any extra ``context`` keys (e.g. environment, execution date)."""
    columns = {key: F.col(key).cast("string") for key in ("task_id", "value", "threshold")}
    columns |= {key: F.lit(str(value)) for key, value in context.items()}
    pieces = re.split(r"\{(\w+)\}", template)  # text, name, text, name, ..., text
    unknown = sorted(set(pieces[1::2]) - set(columns))
    if unknown:
        raise ValueError(f"the template asks for unknown names: {', '.join(unknown)}")
    failed = results.where(~F.col("passed"))
    parts = [F.coalesce(columns[p], F.lit("null")) if i % 2 else F.lit(p) for i, p in enumerate(pieces)]
    return failed.select("task_id", F.concat(*parts).alias("message"))


def any_null_count(df: DataFrame, columns: list[str]) -> Column:
    """``CASE WHEN COUNT(*) = 0 THEN -1 ELSE COUNT(*) END`` over rows where any column is null (an aggregate)."""
    cond = None
    for c in columns:
        term = F.col(c).isNull()
        cond = term if cond is None else cond | term
    n = F.count(F.when(cond, 1))
    return F.when(n == 0, F.lit(-1)).otherwise(n)
