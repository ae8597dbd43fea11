"""The lateness views on a running stream: a fast layer per batch, a scheduled recomputation, and what is served."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.lake.table import Table
from tidewatch.operators.lateness import Periods, first_arrivals, increments, is_open, serve

_STATE = T.StructType([T.StructField("layer", T.StringType()), T.StructField("grp", T.StringType()), T.StructField("period_start", T.LongType()), T.StructField("n", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("at", T.TimestampType())])


class LambdaView:
    """Counts per group and period of one log of events.

    All layers are rows of one versioned table, so that every change of them is one commit. Every micro-batch adds
    to ``fast``. ``recompute`` counts from the whole log, makes open periods the new ``base``, moves the ones past their
    cut-off to ``frozen`` and drops the fast rows of the batches it has seen; those that arrive while it runs stay. A copy of an event that
    comes in a later micro-batch is counted again by the fast layer until the next recomputation corrects it.
    """

    def __init__(self, spark: SparkSession, folder: str, identifier: Column, group: str, occurred: str, arrived: str, periods: Periods = Periods()):
        self.state = Table(spark, f"{folder}/views", _STATE, "at")
        self.what, self.periods = (identifier, group, occurred, arrived), periods

    def _rows(self, df: DataFrame, layer: str, batch: int) -> DataFrame:
        return df.select(F.lit(layer).alias("layer"), "grp", "period_start", F.col("n").cast("long").alias("n"), F.lit(batch).cast("long").alias("batch"), F.current_timestamp().alias("at"))

    def _counts(self, rows: DataFrame) -> DataFrame:
        counted = increments(first_arrivals(rows, *self.what), self.periods).where("stage <> 'cut_off'")
        return counted.groupBy("grp", "period_start").agg(F.sum("n").alias("n"))

    def add(self, batch: DataFrame, batch_id: int, stream: str = "stream") -> None:
        """For ``foreachBatch``: increments of the batch, once however often it comes."""
        self.state.append(self._rows(self._counts(batch), "fast", batch_id), once=(stream, batch_id))

    def recompute(self, log: DataFrame, now_us: int, seen: int) -> None:
        """Count again from the full log, which holds all batches up to ``seen``; what was frozen stays as it was. One commit, done again if a batch was added meanwhile."""
        view, still = self._counts(log), is_open(now_us, self.periods)
        moment = view.sparkSession.createDataFrame([(None, 0, now_us)], "grp string, period_start long, n long")

        def change(old: DataFrame) -> DataFrame:
            frozen = old.where("layer = 'frozen'")
            on = F.col("v.grp").eqNullSafe(F.col("h.grp")) & (F.col("v.period_start") == F.col("h.period_start"))
            closed = view.alias("v").where(~still).join(frozen.select("grp", "period_start").alias("h"), on, "left_anti")
            later = old.where((F.col("layer") == "fast") & (F.col("batch") > seen))
            parts = (self._rows(closed, "frozen", seen), self._rows(view.where(still), "base", seen), later, self._rows(moment, "moment", seen))
            for part in parts:
                frozen = frozen.unionByName(part)
            return frozen

        self.state.update(change)

    def read(self) -> DataFrame:
        rows = self.state.read()
        last = rows.where("layer = 'moment'").agg(F.max("n")).first()[0]
        of = lambda layer: rows.where(F.col("layer") == layer).select("grp", "period_start", "n")
        never = -(self.periods.length + self.periods.cut_off) * 1_000_000 * 1_000_000  # before any recomputation nothing is frozen
        return serve(of("frozen"), of("base"), of("fast"), never if last is None else last, self.periods)
