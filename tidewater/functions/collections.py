"""Array, map and arithmetic helpers as higher-order Spark expressions (evaluated in the JVM, per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions._util import col


def product_nonzero(arr) -> Column:
    """Product of the elements, zeros skipped (empty or all-zero -> 1)."""
    return F.aggregate(F.filter(col(arr), lambda x: x != 0), F.lit(1).cast("bigint"), lambda acc, x: acc * x)


def product_except_self(arr) -> Column:
    """Per position, the product of all other elements (zeros and nulls count); a list of length <= 1 is returned as is.
    A product that 64 bits don't hold is null. One pass for the product of all (nulls and zeros apart, up to 38 digits),
    one for its quotients."""
    a = col(arr)
    zero = F.size(F.filter(a, lambda y: y == 0))
    null = F.size(F.filter(a, lambda y: y.isNull()))
    whole = F.aggregate(F.filter(a, lambda y: y != 0), F.lit(1).cast("decimal(38,0)"),
                        lambda acc, y: F.try_multiply(acc, y.cast("decimal(19,0)")).cast("decimal(38,0)"))

    def other(p: Column, x: Column) -> Column:
        own = F.when(x.isNull() | (x == 0), 1).otherwise(x).cast("decimal(19,0)")
        fits = F.abs(p.cast("double") / own.cast("double")) < 9.2e18
        return (F.when(null - x.isNull().cast("int") > 0, None)
                .when(zero - F.coalesce(x == 0, F.lit(False)).cast("int") > 0, F.lit(0).cast("bigint"))
                .when(fits, F.call_function("div", p, own)))

    others = F.flatten(F.transform(F.array(whole), lambda p: F.transform(a, lambda x: other(p, x))))
    return F.when(F.size(a) <= 1, a.cast("array<bigint>")).otherwise(others)


def double_elements(arr, element_type: T.DataType) -> Column:
    """Numbers doubled, strings repeated twice."""
    if isinstance(element_type, T.StringType):
        return F.transform(col(arr), lambda x: F.repeat(x, 2))
    return F.transform(col(arr), lambda x: x * 2)


def flat_map(arr, fn) -> Column:
    """Apply ``fn`` (element -> array) to every element and flatten one level."""
    return F.flatten(F.transform(col(arr), fn))


def map_merge(left, right) -> Column:
    """Merge two maps; on equal keys the right one wins (independent of session dedup policy)."""
    l, r = col(left), col(right)
    kept = F.map_filter(l, lambda k, v: ~F.array_contains(F.map_keys(r), k))
    return F.when(l.isNull(), r).when(r.isNull(), l).otherwise(F.map_concat(kept, r))


def divide_trunc(a: str, b: str, on_zero: str = "error") -> Column:
    """Integer quotient rounded toward zero (SQL ``div``). A zero divisor raises under ANSI mode or, with
    ``on_zero='null'``, gives null."""
    if on_zero == "null":
        return F.expr(f"CASE WHEN `{b}` = 0 THEN NULL ELSE `{a}` div `{b}` END")
    return F.expr(f"`{a}` div `{b}`")


def factorial_parity(n) -> Column:
    """n! for 2..20, n itself for n <= 1 (so 0 -> 0), null above 20."""
    return F.when(col(n) <= 1, col(n).cast("bigint")).otherwise(F.factorial(col(n)))


def bytes_to_gb(c) -> Column:
    return col(c) / F.lit(1024 ** 3)
