"""Broken input apart from good input, with the reason and the text as it came.

``split`` parses a JSON text column and gives two frames: rows that parsed whole, and rows that did not. Nothing is
dropped and nothing becomes nulls in silence; where a caller has no place for broken rows, ``strict`` fails instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT, PARSED = "_tw_corrupt", "_tw_parsed"
RAW, REASON = "raw", "reason"


def _schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _parse(raw: Column, schema: T.StructType | str, options: dict | None) -> Column:
    marked = T.StructType([*_schema(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(raw, marked, {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _reason(raw: Column, parsed: Column) -> Column:
    """Null for a text that parsed whole."""
    text = F.trim(F.regexp_replace(raw, r"\s+", " "))
    return (F.when(raw.isNull() | (text == ""), "empty").when(~text.startswith("{"), "not an object")
            .when(parsed.isNull() | parsed.getField(CORRUPT).isNotNull(), "malformed, or a value of another type"))


def split(df: DataFrame, raw: str, schema: T.StructType | str, keep: list[str],
          options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, broken): ``keep`` and the fields of the objects in column ``raw``; ``keep``, the text and the reason."""
    names = _schema(schema).names
    both = df.select(*keep, F.col(raw).alias("_tw_raw"), _parse(F.col(raw), schema, options).alias(PARSED)) \
        .withColumn("_tw_reason", _reason(F.col("_tw_raw"), F.col(PARSED)))
    good = both.where(F.col("_tw_reason").isNull()).select(*keep, *[F.col(PARSED).getField(n).alias(n) for n in names])
    broken = both.where(F.col("_tw_reason").isNotNull()).select(
        *keep, F.col("_tw_raw").alias(RAW), F.col("_tw_reason").alias(REASON))
    return good, broken


def strict(raw: Column, schema: T.StructType | str, options: dict | None = None) -> Column:
    """The object in ``raw`` as a struct; a text that doesn't parse whole fails the query and says what it was."""
    parsed = _parse(raw, schema, options)
    why = F.concat(_reason(raw, parsed), F.lit(": "), F.coalesce(F.substring(raw, 1, 200), F.lit("null")))
    names = _schema(schema).names
    return F.when(_reason(raw, parsed).isNull(), F.struct(*[parsed.getField(n).alias(n) for n in names])) \
        .otherwise(F.raise_error(why))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str,
                    options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, broken) lines of JSON files; blank lines are neither."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    return split(lines, "value", schema, [], options)
