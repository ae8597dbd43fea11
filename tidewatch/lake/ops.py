"""Operational tables: how far each source has been read, and what runs did."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch.lake.table import Table

_S, _TS = T.StringType(), T.TimestampType()
WATERMARK = T.StructType([T.StructField("source", _S), T.StructField("watermark_at", _TS), T.StructField("rows", T.LongType())])
RUN = T.StructType([T.StructField("run_id", _S), T.StructField("pipeline", _S), T.StructField("status", _S), T.StructField("ended_at", _TS), T.StructField("rows", T.LongType()), T.StructField("details", _S)])


class Operations:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.watermarks = Table(spark, f"{folder}/ingestion_watermark", WATERMARK, "watermark_at")
        self.runs = Table(spark, f"{folder}/pipeline_run", RUN, "ended_at")

    def advance(self, source: str, at: datetime, rows: int) -> None:
        """One row per source: the newest takes the place of the one before."""
        self.watermarks.upsert(self.spark.createDataFrame([(source, at, rows)], WATERMARK), ["source"])

    def record(self, run_id: str, pipeline: str, status: str, rows: int = 0, **details) -> bool:
        """Note how a run ended. A failure to note it is logged and never stops the run."""
        try:
            self.runs.append(self.spark.createDataFrame([(run_id, pipeline, status, datetime.now(timezone.utc), rows, json.dumps(details, default=str))], RUN))
            return True
        except Exception:
            logging.getLogger(__name__).exception("the run's record could not be written")
            return False

    def history(self) -> DataFrame:
        return self.runs.read()
