"""Numbers over all rows in one order, without one task that sorts them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.storage import fresh, settle


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with ``name``: 1 for the first row by ``order`` up to the number of rows.

    Rows are cut into ranges of the order and sorted within them; a number is the place in the range plus the
    rows of all ranges before it. ``order`` should end in a full tie-break. An empty table stays empty.
    """
    at, part, base = (fresh([*df.columns, name], n) for n in ("_tw_at", "_tw_part", "_tw_base"))
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranges").withColumn(part, F.shiftright(at, 33))
    ranges = placed.groupBy(part).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    bases = ranges.select(part, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias(base))
    return placed.join(F.broadcast(bases), part).withColumn(name, F.col(at) + F.col(base)).drop(at, part, base)


def quantiles(df: DataFrame, groups: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``(groups..., values)``: exact quantiles of each group, interpolated between neighbours as ``percentile`` does.

    Values are counted first, so that equal ones are one row, and the counts added up within ranges of the values: no task holds a
    group's values. Nulls don't count; NaN comes after all numbers; a group without values has no row.
    """
    keys = list(groups)
    counted = settle(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")).repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v").withColumn("_part", F.spark_partition_id()), "quantiles")
    parts = counted.groupBy(*keys, "_part").agg(F.sum("_c").alias("_n"))  # a row per group and range
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [F.col("c._part") == F.col("s._part")]
    within = Window.partitionBy(*(F.col(k) for k in keys), "_part").orderBy("_v")
    j = counted.alias("c").join(starts.alias("s"), on).select(*(F.col(f"c.{k}").alias(k) for k in keys), F.col("c._part").alias("_part"), "_v", "_c", "_before", "_all")
    upto = j.withColumn("_to", F.col("_before") + F.sum("_c").over(within)).withColumn("_from", F.col("_to") - F.col("_c"))
    places = [F.lit(float(q)) * (F.col("_all") - 1) for q in shares]
    # the values at the places below and above each quantile
    held = lambda at: (F.col("_from") <= at) & (at < F.col("_to"))
    found = upto.groupBy(*keys).agg(*(F.max(F.when(held(f(p)), F.col("_v"))).alias(f"_{w}{i}") for i, p in enumerate(places) for w, f in (("lo", F.floor), ("hi", F.ceil))), F.max("_all").alias("_all"))
    values = [F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(F.col(f"_lo{i}") * (F.ceil(p) - p) + F.col(f"_hi{i}") * (p - F.floor(p))) for i, p in enumerate(places)]
    return found.select(*keys, F.array(*values).alias("values"))
