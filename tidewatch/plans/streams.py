"""Streams, versions and the topic log as queries; each run has folders of its own below the shared one."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.lake.table import Table
from tidewatch.schemas import BRONZE
from tidewatch.sources.tables import table
from tidewatch.storage import shared_dir
from tidewatch.streaming.bronze import sync
from tidewatch.streaming.topics import TopicLog, TopicSpec, topic_name


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _envelopes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze_events").drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_key", "_bronze_written_at")


def _by_source(events: DataFrame) -> list[tuple[str | None, DataFrame]]:
    """The sources of a table, of which there are a few, in order, with their rows; those without a source come last."""
    names = sorted((r["source"] for r in events.select("source").distinct().collect()), key=lambda x: (x is None, x))
    return [(x, events.where(F.col("source").eqNullSafe(x))) for x in names]


def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Every source through a topic of its own and into one Bronze table, read again; what isn't valid is in the dead letters."""
    root, events = _folder(spark, "stream"), _envelopes(spark, d)
    log = TopicLog(spark, f"{root}/log")
    for source, rows in _by_source(events):
        topic = topic_name(source or "unknown")
        log.create(TopicSpec(topic))
        log.produce(topic, rows)
        sync(spark, log, topic, f"{root}/bronze", f"{root}/letters", f"{root}/checkpoint/{topic}")
    return Table(spark, f"{root}/bronze", BRONZE).read().groupBy("source", "event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


def time_travel(spark: SparkSession, d: str) -> DataFrame:
    """A commit per source, in the order of their names, which together hold the whole table; every version."""
    b = table(spark, d, "bronze_events").select(*BRONZE.names)
    t = Table(spark, _folder(spark, "versions"), BRONZE)
    versions = [t.append(rows)["version"] for _, rows in _by_source(b)]
    counts = [t.read(version=v).groupBy("source").agg(F.count("*").alias("n")).select(F.lit(v).alias("version"), "source", "n") for v in versions]
    return reduce(DataFrame.unionByName, counts)


QUERIES = {f.__name__: f for f in (stream_bronze, time_travel)}
SQL = {
    "stream_bronze": "SELECT source, event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM bronze_events GROUP BY 1, 2",
    "time_travel": "WITH s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS v FROM bronze_events GROUP BY 1) SELECT a.v::INTEGER AS version, b.source, b.n FROM s a JOIN s b ON b.v <= a.v",
}
