"""Query registry: id -> (callable(spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None).

Each plans module registers its fixture-bound queries with ``@query``; ``__spark_entry__`` only reads this table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(qid: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if qid in REGISTRY:
            raise ValueError(f"duplicate query id {qid}")
        REGISTRY[qid] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def _load_all() -> None:
    from tidewater.plans import (  # noqa: F401
        q_workloads, q_filters, q_joins, q_aggregates, q_windows, q_scalars, q_quality, q_catalog,
        q_sources, q_streaming, q_composites,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
