"""Topic to Bronze: one stream with a checkpoint, a dead-letter table, and no batch written twice."""

from __future__ import annotations

import signal
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.lake.table import Table
from tidewatch.schemas import BRONZE, DEAD_LETTER, ENVELOPE, SOURCES
from tidewatch.sources.envelope import invalid_reason
from tidewatch.streaming.topics import TopicLog, spec_of

_WIRE = "event_id string, source string, event_type string, schema_version int, occurred_at timestamp, ingested_at timestamp, payload string, content_hash string, collector_run_id string, collector_host string"
WIRE_SCHEMA = f"{_WIRE}, _raw string, _key string, _offset long, _appended_at timestamp, _partition int"
#: Most characters of an error's message and of a raw row that a dead letter keeps.
MESSAGE, RAW = 2000, 100_000


def decoded(rows: DataFrame) -> DataFrame:
    """Rows of a topic with the envelope of those that came as raw text (``_raw``) read from it, and ``_broken`` with what is wrong with a text that can't be.

    The reader's schema decides: fields it doesn't know are passed over, fields that the writer didn't have are null. An empty
    text stands for a deletion, which this log doesn't know.
    """
    fields = [f for f in ENVELOPE.names]
    read = F.from_json("_raw", T.StructType([*(T.StructField(f.name, f.dataType) for f in ENVELOPE), T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"})
    r = rows.withColumn("_r", F.when(F.col("_raw").isNotNull(), read))
    broken = F.when(F.trim("_raw") == "", "Tombstone").when(F.col("_raw").isNotNull() & (F.col("_r").isNull() | F.col("_r._bad").isNotNull()), "DecodeError")
    return r.withColumns({f: F.coalesce(F.col(f"_r.{f}"), F.col(f)) for f in fields}).withColumn("_broken", broken).drop("_r")


def split_batch(rows: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """Rows for Bronze, and dead letters for texts that can't be read and for what isn't a valid envelope."""
    read = decoded(rows)
    marked = read.withColumn("_why", F.coalesce(F.when(F.col("_broken") == "Tombstone", "an empty message").when(F.col("_broken").isNotNull(), "not an envelope in JSON"), invalid_reason(read)))
    good = marked.where("_why is null").select(*ENVELOPE.names, F.lit(topic).alias("_kafka_topic"), F.col("_partition").alias("_kafka_partition"), F.col("_offset").alias("_kafka_offset"), F.current_timestamp().alias("_bronze_written_at"))
    raw = F.substring(F.coalesce("_raw", F.to_json(F.struct(*ENVELOPE.names))), 1, RAW)
    bad = marked.where("_why is not null").select(F.current_timestamp().alias("failed_at"), "source", F.lit(topic).alias("topic"), F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), F.coalesce("_broken", F.lit("InvalidEnvelope")).alias("error_class"), F.substring("_why", 1, MESSAGE).alias("error_message"), raw.alias("raw"), F.lit("bronze").alias("stage"))
    return good, bad


def letters(spark: SparkSession, folder: str, topic: str | None = None) -> DataFrame:
    """Dead letters by topic, stage and kind of error: how many, when last, and one of the texts."""
    rows = Table(spark, folder, DEAD_LETTER, "failed_at").read()
    return (rows if topic is None else rows.where(F.col("topic") == topic)).groupBy("topic", "stage", "error_class").agg(F.count(F.lit(1)).alias("n"), F.max("failed_at").alias("last_at"), F.max_by("raw", "failed_at").alias("sample"))


def sync(spark: SparkSession, log: TopicLog, topic: str, bronze: str, letters: str, checkpoint: str, files_per_batch: int = 100) -> dict[str, int]:
    """Read what is new in a topic into Bronze and stop; ``{"written": n, "dead_lettered": n}``.

    A batch is committed to the table before the checkpoint moves on; if the
    process dies between the two, the batch comes again and is found committed.
    A new checkpoint folder replays the topic.
    """
    good_table, bad_table = Table(spark, bronze, BRONZE), Table(spark, letters, DEAD_LETTER, "failed_at")
    report = {"written": 0, "dead_lettered": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_batch(batch, topic)
        for name, table, rows in (("written", good_table, good), ("dead_lettered", bad_table, bad)):
            commit = table.append(rows, once=(checkpoint, batch_id))
            if commit and not commit.get("repeated"):
                report[name] += commit["added"]
        log.note_consumed(checkpoint, {r["_partition"]: r["n"] for r in batch.groupBy("_partition").agg((F.max("_offset") + 1).alias("n")).collect()})  # a row per partition

    q = log.read_stream(topic, WIRE_SCHEMA, files_per_batch).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    with stopping(q):
        q.awaitTermination()
    return report


@contextmanager
def stopping(query: StreamingQuery) -> Iterator[None]:
    """Within it, an interrupt or a request to end stops the query after what it has committed; the next run goes on from there."""
    if threading.current_thread() is not threading.main_thread():  # signals reach the main thread only
        yield
        return
    had = {s: signal.signal(s, lambda *_: query.stop()) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        yield
    finally:
        for s, handler in had.items():
            signal.signal(s, handler)


def sync_all(spark: SparkSession, log: TopicLog, root: str, sources: Iterable[str] = SOURCES, replay: bool = False) -> dict[str, dict[str, int]]:
    """Every source's topic into its Bronze table, one after the other; a source without a topic has nothing to read."""
    report = {}
    for source in sources:
        topic = spec_of(source).name
        if log.exists(topic):
            group = uuid.uuid4().hex if replay else "bronze"
            report[source] = sync(spark, log, topic, f"{root}/bronze/{source}", f"{root}/dead_letters", f"{root}/checkpoints/{source}/{group}")
    return report


def windowed_counts(stream: DataFrame, at: str, length: str, lateness: str, *keys: str) -> DataFrame:
    """Counts per window and key of a stream, late rows accepted up to ``lateness``."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, length), *keys).agg(F.count("*").alias("n"))


def distinct_within(stream: DataFrame, at: str, lateness: str, *keys: str) -> DataFrame:
    """One row of each key of a stream within the lateness allowed."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))
