"""Joins.

Strategy is left to Catalyst + AQE (broadcast when statistics prove a side small, sort-merge otherwise, skew-join
splitting of hot partitions at runtime). We only add an explicit broadcast where the side's size is bounded by
construction (a one-row aggregate, a per-partition table, a fixed config) — never on a data-sized input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
              left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Inner equi-join emitting ``(left row, right row)`` as two struct columns. Null keys match each other
    (null-safe ``<=>``), like a hash table keyed on Python ``None``."""
    l = left.select(F.struct(*[F.col(c) for c in left.columns]).alias(left_name), F.col(left_key).alias("_tw_lk"))
    r = right.select(F.struct(*[F.col(c) for c in right.columns]).alias(right_name), F.col(right_key).alias("_tw_rk"))
    return l.join(r, F.col("_tw_lk").eqNullSafe(F.col("_tw_rk")), "inner").select(left_name, right_name)


def multi_key_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    cond = None
    for a, b in pairs:
        term = left[a] == right[b]
        cond = term if cond is None else cond & term
    return left.join(right, cond, how)


def using_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    return left.join(right, key, how)


def left_join_enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Optional attributes from a dimension; the dimension's key column is dropped from the output."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left").drop(dim[dim_key])


def anti_join_missing(items: DataFrame, present: DataFrame, item_key: str, present_key: str) -> DataFrame:
    """Items that have no matching row (left anti join; nulls never match)."""
    return items.join(present.select(F.col(present_key).alias("_tw_pk")),
                      F.col(item_key) == F.col("_tw_pk"), "left_anti")


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus those new rows whose key is not present yet (new rows deduplicated on the key first)."""
    fresh = new_rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def skip_materialized(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Ids whose output does not exist yet."""
    return wanted.join(done.select(key), key, "left_anti")


def lookup_nested_config(rows: DataFrame, config: DataFrame, keys: list[str], value_col: str,
                         out: str) -> DataFrame:
    """Value from a flattened nested config (one row per key path) by equi-join on the key path. ``config`` is a
    configuration table; Spark broadcasts it when its statistics are small. Rows without a path get null and can
    be reported by the caller (``out IS NULL``)."""
    return rows.join(config.select(*keys, F.col(value_col).alias(out)), keys, "left")


def flatten_config(config: dict) -> list[tuple]:
    """Nested dict config ``{a: {b: {c: v}}}`` -> rows ``(a, b, c, v)`` (driver-side helper for small configs)."""
    rows = []

    def walk(prefix, node):
        if isinstance(node, dict):
            for k, v in node.items():
                walk(prefix + (k,), v)
        else:
            rows.append(prefix + (node,))

    walk((), config)
    return rows


def adjacent_chunk_edges(tasks: DataFrame, task_col: str, chunk_col: str, root: str) -> DataFrame:
    """Dependency edges: every task of chunk 0 depends on ``root``; every task of chunk k on every task of chunk k-1.
    An equi-join on ``chunk = chunk - 1``; its output is the edge list itself."""
    prev = tasks.select(F.col(task_col).alias("src"), (F.col(chunk_col) + 1).alias("_tw_c"))
    cur = tasks.select(F.col(task_col).alias("dst"), F.col(chunk_col).alias("_tw_c"))
    inner = prev.join(cur, "_tw_c").select("src", "dst")
    first = tasks.where(F.col(chunk_col) == 0).select(F.lit(root).alias("src"), F.col(task_col).cast("string").alias("dst"))
    return first.unionByName(inner.select(F.col("src").cast("string"), F.col("dst").cast("string")))


def override_config(base: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Replace a value by its override only where the key exists in ``base`` and the current value is truthy
    (non-null, non-zero); keys only present in the overrides are ignored."""
    o = overrides.select(F.col(key), F.col(value).alias("_tw_new"))
    j = base.join(o, key, "left")
    cur = F.col(value)
    truthy = cur.isNotNull() & (cur != 0)
    return j.withColumn(value, F.when(truthy & F.col("_tw_new").isNotNull(), F.col("_tw_new")).otherwise(cur)) \
        .drop("_tw_new")


def alert_routing(alerts: DataFrame, rules: DataFrame, default_tasks: list[str] | None = None) -> DataFrame:
    """Alerts that are reported. The dag must have a rule row. A task with rules of its own in that dag is reported in
    the hours ``[hour_from, hour_to]`` of any of them (a missing bound sets no limit); a default task without a rule of
    its own at any hour.

    alerts: (dag_id, task_id, hour, ...); rules: (dag_id, task_id, hour_from, hour_to).
    """
    a, r = alerts.alias("a"), rules.alias("r")
    same_dag = F.col("a.dag_id") == F.col("r.dag_id")
    same_task = same_dag & (F.col("a.task_id") == F.col("r.task_id"))
    hours = F.col("a.hour").between(F.coalesce("r.hour_from", "a.hour"), F.coalesce("r.hour_to", "a.hour"))
    own = a.join(r, same_task & hours, "left_semi")
    if not default_tasks:
        return own
    default = a.where(F.col("a.task_id").isin(list(default_tasks)))
    default = default.join(r, same_dag, "left_semi").alias("a").join(r, same_task, "left_anti")
    return own.unionByName(default)


def metadata_join(tables: DataFrame, columns: DataFrame, schema: str) -> DataFrame:
    """Base tables of one schema joined to their columns (information_schema style: 4 join conditions)."""
    t = tables.alias("t")
    c = columns.alias("c")
    cond = ((F.col("t.table_schema") == F.col("c.table_schema")) & (F.col("t.table_name") == F.col("c.table_name"))
            & (F.col("t.table_type") == F.lit("BASE TABLE")) & (F.col("t.table_schema") == F.lit(schema)))
    return t.join(c, cond, "inner").select("c.*")


def cross_product(df: DataFrame, **lists) -> DataFrame:
    """Each row times every combination of the given value lists (``itertools.product``), as successive
    ``explode`` of literal arrays: a generator per row, so no cartesian join and no shuffle."""
    out = df
    for name, values in lists.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def schema_diff(saved: DataFrame, current: DataFrame, key: str = "name") -> DataFrame:
    """Compare saved table definitions with current ones: ``create`` (only saved), ``update`` (both, different),
    ``skip`` (equal), ``drop`` (only current). Equality is null-safe over every non-key column; array columns are
    compared order-insensitively (sorted)."""
    cols = [c for c in saved.columns if c != key]
    def norm(df, c):
        dt = df.schema[c].dataType.simpleString()
        return F.array_sort(F.col(c)) if dt.startswith("array") else F.col(c)
    s = saved.select(F.col(key), *[norm(saved, c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_s"))
    c_ = current.select(F.col(key), *[norm(current, c).alias(f"c_{c}") for c in cols], F.lit(True).alias("_c"))
    j = s.join(c_, key, "full_outer")
    same = None
    for c in cols:
        t = F.col(f"s_{c}").eqNullSafe(F.col(f"c_{c}"))
        same = t if same is None else same & t
    action = (F.when(F.col("_c").isNull(), "create").when(F.col("_s").isNull(), "drop")
              .when(same, "skip").otherwise("update"))
    return j.select(F.col(key), action.alias("action"))
