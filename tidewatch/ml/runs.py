"""Runs of experiments: parameters, metrics, tags, small artifacts, status; append-only."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.lake.table import Table

SCHEMA = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()), T.StructField("status", T.StringType()), T.StructField("ended_at", T.TimestampType()), T.StructField("params", T.MapType(T.StringType(), T.StringType())), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())), T.StructField("error", T.StringType()), T.StructField("tags", T.MapType(T.StringType(), T.StringType())), T.StructField("artifacts", T.MapType(T.StringType(), T.StringType()))])


class Run:
    def __init__(self) -> None:
        self.params: dict[str, str] = {}
        self.metrics: dict[str, float] = {}
        self.tags: dict[str, str] = {}
        self.artifacts: dict[str, str] = {}

    def tag(self, **values) -> None:
        self.tags |= {k: str(v) for k, v in values.items()}

    def artifact(self, name: str, text: str) -> None:
        """A small text that belongs to the run, such as a report or a list of terms."""
        self.artifacts[name] = text

    def param(self, **values) -> None:
        self.params |= {k: str(v) for k, v in values.items()}

    def metric(self, **values) -> None:
        """Missing values and NaN are left out."""
        self.metrics |= {k: float(v) for k, v in values.items() if v is not None and not math.isnan(v)}


class Runs:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, Table(spark, path, SCHEMA, "ended_at")

    @contextmanager
    def run(self, experiment: str) -> Iterator[Run]:
        """Recorded as finished, or as failed with the error, which goes on."""
        r, status, error = Run(), "FINISHED", None
        try:
            yield r
        except Exception as e:
            status, error = "FAILED", str(e)[:2000]
            raise
        finally:
            row = (uuid.uuid4().hex, experiment, status, datetime.now(timezone.utc), r.params, r.metrics, error, r.tags, r.artifacts)
            self.table.append(self.spark.createDataFrame([row], SCHEMA))

    def newest(self) -> DataFrame:
        """The newest finished run of each experiment."""
        w = Window.partitionBy("experiment").orderBy(F.desc("ended_at"), F.desc("run_id"))
        return self.table.read().where("status = 'FINISHED'").withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
