"""Reading SQL over tables by short names."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.text import guarded_query


def register(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> list[str]:
    """Make each table a view; one that can't be loaded is passed over with a warning. The names that are there."""
    there = []
    for name, load in tables.items():
        try:
            load().createOrReplaceTempView(name)
            there.append(name)
        except Exception as e:  # noqa: BLE001 - the others stay usable
            logging.getLogger(__name__).warning("%s can't be loaded: %s", name, e)
    return there


def ask(spark: SparkSession, statement: str, args: Mapping[str, object] | None = None, most: int | None = None) -> DataFrame:
    """A single reading statement; anything that writes is refused. Values are bound, not pasted."""
    df = spark.sql(guarded_query(statement), args=dict(args or {}))
    return df if most is None else df.limit(most)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
