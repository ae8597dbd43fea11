"""Data checks: each returns the rows that fail, so none means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import is_documentation_address

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """A named check; ``rows`` gives the failing rows, and an error blocks what depends on the model."""

    name: str
    rows: DataFrame
    severity: str = ERROR

    def failing(self) -> int:
        return self.rows.count()


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """The values that more than one row has; null is no value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with another value; null passes."""
    return df.where(~F.col(column).isin(list(values)))


def no_documentation_addresses(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_documentation_address(F.col(column)))


def same_total(left: DataFrame, right: DataFrame) -> DataFrame:
    """A row with both totals if two one-row, one-column tables differ."""
    a, b = left.toDF("left_total"), right.toDF("right_total")
    return a.crossJoin(b).where(~F.col("left_total").eqNullSafe(F.col("right_total")))


def has_rows(df: DataFrame) -> DataFrame:
    """A row if the table is empty."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0")


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """``(check_name, failing)`` of all checks, in one plan."""
    rows = [df.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check_name"), "failing") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def failing(checks: Sequence[Check]) -> dict[str, int]:
    """The failing rows of each check, by name, in one job."""
    if not checks:
        return {}
    return {r["check_name"]: r["failing"] for r in report({c.name: c.rows for c in checks}).collect()}


def freshness(age_hours: float | None, warn_after: float = 8, fail_after: float = 14) -> str:
    """``pass``, ``warn`` or ``fail`` by a table's age; a table that was never written fails."""
    return "fail" if age_hours is None or age_hours > fail_after else "warn" if age_hours > warn_after else "pass"
