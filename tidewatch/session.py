"""Session set-up for tests, benches and scripts; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidewatch", **conf: str) -> SparkSession:
    """A local session in UTC with adaptive execution."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TIDEWATCH_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=base | conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
