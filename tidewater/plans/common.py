from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import configure
from tidewater.tables import load


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return load(spark, sf_dir, name)
