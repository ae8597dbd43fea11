"""Which deliveries of a feed are complete, and in which order they count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def complete_runs(runs: DataFrame) -> DataFrame:
    """The successful runs, once each, as ``(source, collector_run_id, snapshot_no, collected_at, ingested_at, seq)``.

    ``seq`` counts from 0 per source by ``collected_at`` (then ``snapshot_no``,
    then the id). Runs without an id, source or collection time can't be ordered and are left out.
    """
    once = (
        runs.where((F.col("run_status") == "success") & F.col("collector_run_id").isNotNull() & F.col("source").isNotNull() & F.col("collected_at").isNotNull())
        .groupBy("source", "collector_run_id")
        .agg(F.min("snapshot_no").alias("snapshot_no"), F.min("collected_at").alias("collected_at"), F.min("ingested_at").alias("ingested_at"))
    )
    order = Window.partitionBy("source").orderBy("collected_at", "snapshot_no", "collector_run_id")
    return once.withColumn("seq", F.row_number().over(order) - 1)
