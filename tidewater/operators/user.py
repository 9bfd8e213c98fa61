"""User-function surface: record/frame transforms, user filters and a model registry.

Every hook is a ``DataFrame -> DataFrame`` function usable with ``df.transform``. Python code that must see rows runs
in ``mapInPandas`` (Arrow batches, on the executors), never through the driver.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Frame-level hook before a write; ``None`` is the identity."""
    return df if fn is None else df.transform(fn)


def map_frames(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Apply a pandas frame function to every Arrow batch (vectorised user code)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def map_records(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType | str) -> DataFrame:
    """Apply a per-record function (dict -> dict) inside Arrow batches: the slow path, for user code that cannot be
    written as expressions."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([fn(r) for r in b.to_dict("records")])
    return df.mapInPandas(run, schema)


def apply_filter(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | Column | str | None = None) -> DataFrame:
    """User filter: a predicate Column / SQL text, or a DataFrame -> DataFrame function; identity by default."""
    if fn is None:
        return df
    if isinstance(fn, (Column, str)):
        return df.where(fn)
    return df.transform(fn)


class Model:
    """A versioned model applied to an inference frame: tags each row with its type and version and computes its
    features with Spark expressions (subclasses override ``features``)."""

    version: int = 0
    model_type: str | None = None

    def features(self, df: DataFrame) -> DataFrame:
        return df

    def recommend(self, df: DataFrame) -> DataFrame:
        out = self.features(df)
        return out.withColumn("model_type", F.lit(self.model_type).cast("string")) \
            .withColumn("model_version", F.lit(self.version))


REGISTRY: dict[int, Model] = {}


def register(model: Model) -> Model:
    REGISTRY[model.version] = model
    return model


def recommend(df: DataFrame, version: int) -> DataFrame:
    if version not in REGISTRY:
        raise KeyError(f"no model with version {version}")
    return REGISTRY[version].recommend(df)
