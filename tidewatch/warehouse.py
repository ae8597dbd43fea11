"""Models by the names ``layer.model``, each a versioned table: readers see the old or the new one, never half."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewatch.functions.text import guarded_name
from tidewatch.lake.table import Lake, Table, commit_together


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.lake = Lake(spark, f"{root.rstrip('/')}/warehouse")
        self.spark = spark

    def _at(self, name: str, schema: StructType | None = None) -> Table:
        layer, model = guarded_name(name).split(".")
        return self.lake.table(layer, model, schema or StructType(), None)

    def read(self, name: str) -> DataFrame | None:
        """The model as last built; None if it never was."""
        schema = self._at(name).stored_schema()
        return None if schema is None else self._at(name, schema).read()

    def exists(self, name: str) -> bool:
        return self._at(name).version() > 0

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Put a new version in place of the one before, and read it."""
        self._at(name, df.schema).replace(df)
        return self.read(name)

    def save_together(self, models: Mapping[str, DataFrame]) -> None:
        """New versions of several models, which readers see at once."""
        commit_together({self._at(n, df.schema): df for n, df in models.items()}, self.lake.root)

    def built_at(self, name: str) -> str | None:
        return self._at(name).stats()["last_commit"]

    def names(self) -> list[str]:
        return [f"{layer}.{m}" for layer in self.lake.namespaces() for m in self.lake.tables(layer)]
