"""Projections, filters and predicates. Plain DataFrame -> DataFrame functions; every predicate is a
built-in expression, so Catalyst pushes it into the Parquet scan where the column allows it."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import name_date
from tidewater.functions._util import col
from tidewater.functions.strings import camel_name, snake_name


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The row(s) with ``key = value``; no match gives an empty frame. Bound as a literal, so it reaches the scan."""
    return df.where(F.col(key) == F.lit(value))


def point_lookup_sql(df: DataFrame, key: str, value) -> DataFrame:
    """The same lookup as SQL text with a bound named parameter (no string interpolation of the value)."""
    return df.sparkSession.sql(f"SELECT * FROM {{src}} WHERE `{key}` = :id", args={"id": value}, src=df)


def date_range_sql(df: DataFrame, column: str, start, end) -> DataFrame:
    """``[start, end)`` as SQL text with bound ``:start_date`` / ``:end_date`` parameters."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{src}} WHERE `{column}` >= CAST(:start_date AS TIMESTAMP_NTZ) "
        f"AND `{column}` < CAST(:end_date AS TIMESTAMP_NTZ)",
        args={"start_date": str(start), "end_date": str(end)}, src=df)


def date_range_filter(df: DataFrame, column: str, start, end) -> DataFrame:
    """Half-open ``[start, end)`` on a date/time column (partition pruning applies on partition columns)."""
    c = F.col(column)
    return df.where((c >= F.lit(start).cast(df.schema[column].dataType)) &
                    (c < F.lit(end).cast(df.schema[column].dataType)))


def contains_any_filter(df: DataFrame, column: str, needles, case_insensitive: bool = True) -> DataFrame:
    from tidewater.functions import contains_any
    return df.where(contains_any(column, needles, case_insensitive))


def not_null_filter(df: DataFrame, columns) -> DataFrame:
    return df.where(functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_list_filter(df: DataFrame, column: str, values, negate: bool = False) -> DataFrame:
    """``IN`` / ``NOT IN``. Like SQL, ``NOT IN`` drops rows whose value is null."""
    cond = F.col(column).isin(list(values))
    return df.where(~cond if negate else cond)


def case_classify(rules, default=None) -> Column:
    """Ordered CASE: ``rules`` is a list of (condition Column, value); first match wins, no match -> default."""
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return F.lit(default)
    return out.otherwise(default) if default is not None else out


def exclude_names(df: DataFrame, column: str, excluded: DataFrame | None, excluded_col: str | None = None,
                  temp_prefix: str = "tmp_") -> DataFrame:
    """Names not on the exclusion list (a null/empty list excludes nothing) and not starting with ``temp_prefix``.
    The exclusion list is a DataFrame, so it can be any size: a left-anti join, broadcast only when Spark's
    statistics show it small."""
    out = df.where(~F.col(column).startswith(temp_prefix) | F.col(column).isNull())
    if excluded is not None:
        ec = excluded_col or column
        out = out.join(excluded.select(F.col(ec).alias("_tw_ex")), F.col(column) == F.col("_tw_ex"), "left_anti")
    return out


def dated_name_filter(df: DataFrame, column: str, as_of: str | datetime, older_than_days: int = 1) -> DataFrame:
    """Temporary names (``^tmp_.*\\d{8}``) whose yyyyMMdd date is before ``as_of - older_than_days``. Names
    without a date (or with an invalid one) count as ``as_of`` and are therefore kept."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(older_than_days))
    d = F.coalesce(name_date(column).cast("timestamp_ntz"), F.lit(as_of).cast("timestamp_ntz"))
    return df.where(d < cutoff)


def bytes_to_gb_col(c) -> Column:
    return col(c) / F.lit(1024 ** 3)


def filter_query_log(df: DataFrame, state_col: str, bytes_col: str, submitted_col: str, as_of, window_minutes: int,
                     min_gb: float = 50.0, finished=("SUCCEEDED", "FAILED", "CANCELLED")) -> DataFrame:
    """Finished queries that scanned more than ``min_gb`` GiB and were submitted within the last window:
    ``0 <= as_of - submitted <= window`` on the full time difference."""
    t = F.lit(as_of).cast("timestamp_ntz")
    sub = F.col(submitted_col)
    return df.where(
        F.col(state_col).isin(list(finished))
        & (bytes_to_gb_col(bytes_col) > F.lit(min_gb))
        & (sub <= t) & (sub >= t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(window_minutes)))
    )


def flatten_nested(df: DataFrame, paths: dict, default=-1) -> DataFrame:
    """Select nested fields by dotted path into flat columns; missing values take ``default`` for numeric fields.
    Only the named leaves are read (nested schema pruning)."""
    cols = []
    for out, path in paths.items():
        c = F.col(path)
        try:
            dt = df.select(c).schema[0].dataType
        except Exception:  # pragma: no cover
            dt = None
        if default is not None and isinstance(dt, T.NumericType):
            c = F.coalesce(c, F.lit(default).cast(dt))
        cols.append(c.alias(out))
    return df.select(*cols)


def flatten_struct_column(df: DataFrame, column: str) -> DataFrame:
    """Lift all fields of one struct column to top level and drop the struct; on a name clash the nested field wins."""
    st = df.schema[column].dataType
    nested = [f.name for f in st.fields]
    keep = [F.col(c) for c in df.columns if c != column and c not in nested]
    return df.select(*keep, *[F.col(f"{column}.{n}").alias(n) for n in nested])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Column names lower-cased with spaces replaced by underscores; duplicates after cleaning are an error."""
    names = [c.replace(" ", "_").lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names after sanitising: {names}")
    return df.toDF(*names)


def rename_case(df: DataFrame, to: str = "snake") -> DataFrame:
    """Rename all columns camel -> snake or snake -> camel, by the rule of the column functions; no job runs."""
    return df.toDF(*[snake_name(c) if to == "snake" else camel_name(c) for c in df.columns])


def conditional_update(df: DataFrame, column: str, value, where: Column | None = None) -> DataFrame:
    """Set ``column`` to a constant where ``where`` holds (all rows without a condition); a NaN/null constant is
    written as 0, as intended by the source rule."""
    kind = df.schema[column].dataType
    v = F.lit(0 if value is None or value != value else value).cast(kind)
    return df.withColumn(column, v if where is None else F.when(where, v).otherwise(F.col(column)))


def derive_ratio(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """``num / den`` with a zero divisor giving null (ANSI division would raise)."""
    return df.withColumn(out, F.try_divide(F.col(num), F.col(den)))


def add_literal(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def any_null_filter(df: DataFrame, columns) -> DataFrame:
    """Rows where any listed column is null (the predicate is generated from the column list)."""
    return df.where(functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def project_report(df: DataFrame, fields: dict, where: Column | None = None) -> DataFrame:
    """Pick dotted fields of a nested report row into named columns, then filter (nested column pruning)."""
    out = df if where is None else df.where(where)
    return out.select(*[F.col(p).alias(n) for n, p in fields.items()])


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def url_parts(c) -> Column:
    """Connection/URL text -> struct(scheme, host, path, user, password, port, query map). The scheme is normalised
    (``postgresql`` -> ``postgres``, ``-`` -> ``_``). User, password, path and query values are decoded (``%40`` is
    ``@``; ``+`` is a blank in the query only); one that doesn't decode stays as it is."""
    u = col(c)
    scheme = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    scheme = F.regexp_replace(F.when(scheme == "postgresql", F.lit("postgres")).otherwise(scheme), "-", "_")
    authority = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    userinfo = F.regexp_extract(authority, r"^([^@]*)@", 1)
    hostport = F.regexp_replace(authority, r"^[^@]*@", "")
    host = F.regexp_extract(hostport, r"^([^:]*)", 1)
    port = F.regexp_extract(hostport, r":(\d+)$", 1)
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return F.struct(
        scheme.alias("scheme"), F.nullif(host, F.lit("")).alias("host"), _decoded(path).alias("path"),
        F.nullif(_decoded(F.regexp_extract(userinfo, r"^([^:]*)", 1)), F.lit("")).alias("user"),
        F.when(userinfo.contains(":"), _decoded(F.regexp_extract(userinfo, r"^[^:]*:(.*)$", 1))).alias("password"),
        F.nullif(port, F.lit("")).cast("int").alias("port"),
        F.when(query != "", F.transform_values(F.str_to_map(query, F.lit("&"), F.lit("=")),
                                               lambda _, v: F.coalesce(F.try_url_decode(v), v))).alias("query"),
    )
