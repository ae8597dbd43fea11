"""Access to the Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.storage import ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; only the columns and rows a plan needs are read."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
