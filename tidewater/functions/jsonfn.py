"""JSON and nested-value functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions._util import col


def json_value(c, path: str) -> Column:
    """Scalar at a JSON path as text (``JSON_VALUE``)."""
    return F.get_json_object(col(c), path)


def parse_json_text(c) -> Column:
    """Text -> Variant, returned as canonical JSON text so results stay hashable; invalid JSON -> null."""
    return F.to_json(F.try_parse_json(col(c)))


def remove_empty(c, dtype: T.DataType) -> Column:
    """Recursively drop null, empty struct (all fields empty) and empty array/map values, children first, so a parent
    emptied by the removal also goes. "" , 0 and false are kept. Driven by the column's schema, so it stays a
    JVM expression tree."""
    x = col(c)
    if isinstance(dtype, T.StructType):
        fields = [remove_empty(x.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        if not fields:
            return F.lit(None).cast(dtype)
        any_present = None
        for f in dtype.fields:
            term = remove_empty(x.getField(f.name), f.dataType).isNotNull()
            any_present = term if any_present is None else (any_present | term)
        return F.when(x.isNotNull() & any_present, F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        et = dtype.elementType
        cleaned = F.filter(F.transform(x, lambda e: remove_empty(e, et)), lambda e: e.isNotNull())
        return F.when(F.size(cleaned) > 0, cleaned)
    if isinstance(dtype, T.MapType):
        vt = dtype.valueType
        cleaned = F.map_filter(F.transform_values(x, lambda k, v: remove_empty(v, vt)), lambda k, v: v.isNotNull())
        return F.when(F.size(cleaned) > 0, cleaned)
    return x


def to_json_compact(c, dtype: T.DataType) -> Column:
    """JSON text without empty elements (``to_json`` drops null fields); an empty or missing value gives ``[]``."""
    cleaned = remove_empty(c, dtype)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.to_json(cleaned), F.lit("[]"))
    return F.coalesce(F.to_json(F.array(cleaned)), F.lit("[]"))


def json_round_trip(c, dtype: T.DataType) -> Column:
    """Value -> JSON text -> value with the same schema."""
    return F.from_json(F.to_json(col(c)), dtype)


RING = T.ArrayType(T.ArrayType(T.DoubleType()))


def polygon_ring(coords_json) -> Column:
    """JSON text of ``[[x, y], ...]`` or one level deeper ``[[[x, y], ...]]`` -> one ring (array of points)."""
    flat = F.from_json(col(coords_json), RING)
    deep = F.from_json(col(coords_json), T.ArrayType(RING))
    return F.coalesce(F.get(deep, F.lit(0)), flat)


def polygon_wkt(ring) -> Column:
    """Ring -> ``POLYGON((y x, ...))`` text; points are written latitude first, as in the source rule."""
    pts = F.transform(col(ring), lambda p: F.concat_ws(" ", p[1].cast("string"), p[0].cast("string")))
    return F.concat(F.lit("POLYGON(("), F.array_join(pts, ","), F.lit("))"))


def polygon_valid(ring) -> Column:
    """Closed ring with at least 4 points (first point equals last)."""
    r = col(ring)
    return (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1))
