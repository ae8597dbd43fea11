"""A partitioned, append-only log in a directory, read with Structured Streaming.

``<topic>/_topic.json`` holds the declared settings; rows lie under
``<topic>/data/_partition=<p>/`` as Parquet with their offset in the
partition. A produced batch is staged, its offsets reserved by publishing the next file of ``<topic>/_ends``
(which fails if another producer was first), and its files then moved in, so that readers follow only whole files. Every row of an
entity is in one partition, and ``(_partition, _offset)`` gives its order.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.lake.table import Table
from tidewatch.schemas import ENVELOPE, SOURCES
from tidewatch.sources.envelope import invalid_reason
from tidewatch.storage import Files, shared_dir

#: About how many rows one task of ``TopicLog.produce`` sorts, and how many of the newest batches a topic remembers by name.
CHUNK, BATCHES = 50_000, 1000
_PLACE = "_offset long, _appended_at timestamp, _partition int"


@dataclass(frozen=True)
class TopicSpec:
    """Declared settings of a topic."""

    name: str
    partitions: int = 3
    retention_hours: int = 168
    cleanup: str = "delete"
    timestamps: str = "log_append"


#: Declared settings per source. Hours that rows are kept.
RETENTION_HOURS = {"cowrie": 24 * 30}


def spec_of(source: str) -> TopicSpec:
    """The declared topic of a source; an unknown source is refused."""
    if source not in SOURCES:
        raise KeyError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
    return TopicSpec(topic_name(source), retention_hours=RETENTION_HOURS.get(source, 24 * 7))


def undelivered(marked: DataFrame, topic: str) -> DataFrame:
    """Dead letters of rows that a topic refused (``_why``)."""
    return marked.select(F.current_timestamp().alias("failed_at"), "source", F.lit(topic).alias("topic"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"), F.lit("InvalidEnvelope").alias("error_class"), F.substring("_why", 1, 2000).alias("error_message"), F.substring(F.to_json(F.struct(*ENVELOPE.names)), 1, 100_000).alias("raw"), F.lit("produce").alias("stage"))


def raw_messages(messages: DataFrame) -> DataFrame:
    """``(key, value)`` messages of other writers for ``TopicLog.produce``: the value, an envelope in JSON, is read by the consumer. A null value, a deletion, comes as an empty text."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in ENVELOPE]
    return messages.select(*nothing, F.coalesce("value", F.lit("")).alias("_raw"), F.col("key").alias("_key"))


def topic_name(source: str, version: int = 1) -> str:
    return f"raw.{source}.v{version}"


def subject_name(topic: str) -> str:
    return f"{topic}-value"


def entity_key() -> Column:
    """The entity a row belongs to: a honeypot session, else the first of URL, address, CVE, session or source address; else the event itself."""
    p = F.from_json("payload", "session string, url string, ip_address string, cve_id string, session_id string, src_ip string")
    some = lambda k: F.nullif(p[k], F.lit(""))
    return F.when(F.col("source") == "cowrie", F.coalesce(some("session"), F.col("event_id"))).otherwise(F.coalesce(*(some(k) for k in ("url", "ip_address", "cve_id", "session_id", "src_ip")), F.col("event_id")))


def partition_of(key: Column, partitions: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


class TopicLog:
    """Topics below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _path(self, name: str, *more: str) -> str:
        return "/".join((self.root, name, *more))

    def exists(self, name: str) -> bool:
        return self.files.exists(self._path(name, "_topic.json"))

    def create(self, spec: TopicSpec, dry_run: bool = False) -> str:
        """``exists``, ``would create`` or ``created``."""
        if self.exists(spec.name):
            return "exists"
        if dry_run:
            return "would create"
        self.files.make_folder(self._path(spec.name, "data"))
        self._save(spec)
        return "created"

    def _save(self, spec: TopicSpec) -> None:
        self.files.replace(self._path(spec.name, "_topic.json"), json.dumps(asdict(spec), sort_keys=True))

    def describe(self, name: str) -> TopicSpec:
        return TopicSpec(**json.loads(self.files.read(self._path(name, "_topic.json"))))

    def reconcile(self, spec: TopicSpec, apply: bool = False) -> str:
        """``missing``, ``in sync``, ``would change`` or ``updated``; the number of partitions of a topic with rows never changes."""
        if not self.exists(spec.name):
            return "missing"
        has = self.describe(spec.name)
        if has == spec:
            return "in sync"
        if has.partitions != spec.partitions and self.counts(spec.name):
            raise ValueError("a topic with rows keeps its partitions: its entities would move")
        if not apply:
            return "would change"
        self._save(spec)
        return "updated"

    def delete(self, name: str, dry_run: bool = False) -> str:
        if not self.exists(name):
            return "missing"
        if not dry_run:
            self.files.remove(self._path(name))
        return "would delete" if dry_run else "deleted"

    def _ends(self, name: str) -> tuple[int, dict]:
        """The number of the newest file of reserved offsets and what it says: ``{ends, batches, moves}``."""
        files = [n for n in self.files.names(self._path(name, "_ends")) if n.endswith(".json") and not n.startswith(".")]
        return (int(files[-1][:12]), json.loads(self.files.read(self._path(name, "_ends", files[-1])))) if files else (0, {"ends": {}, "batches": {}})

    def counts(self, name: str) -> dict[int, int]:
        """Rows that each partition has been given, which are also its next offsets; nothing is scanned."""
        return {int(p): n for p, n in self._ends(name)[1]["ends"].items() if n}

    def earliest(self, name: str) -> dict[int, int]:
        """The least offset that each partition still holds; its end if retention has taken all."""
        path = self._path(name, "data")
        held = {}
        if any(e.startswith("_partition=") for e in self.files.names(path)):
            held = {r["_partition"]: r["low"] for r in self.spark.read.schema(_PLACE).parquet(path).groupBy("_partition").agg(F.min("_offset").alias("low")).collect()}  # a row per partition
        return {p: held.get(p, end) for p, end in self.counts(name).items()}

    def produce(self, name: str, events: DataFrame, batch: str | None = None, dead: Table | None = None) -> dict[str, int]:
        """Append events; ``{"produced", "delivered", "failed", "dead_lettered"}``. Offsets go on where each partition ended.

        With ``dead``, rows that aren't valid envelopes aren't delivered but written there; without it, readers judge them. Rows are cut into ranges of
        about ``CHUNK`` and sorted within them; an offset is the place in the range plus the rows of the partition's ranges before it, so no
        task sorts a whole partition. ``batch`` names what is produced: produced again, it is found there, finished if need be, and nothing is added.
        """
        spec = self.describe(name)
        root, tag = self._path(name), batch or uuid.uuid4().hex
        if batch and batch in (done := self._ends(name)[1])["batches"]:
            self._move_in(name, done["batches"][batch])
            return done["batches"][batch]["report"]
        order = ("_partition", "ingested_at", "event_id", *(["_raw"] if "_raw" in events.columns else []))
        marked = events.withColumn("_why", F.lit(None).cast("string") if dead is None else invalid_reason(events))
        n, bad = marked.agg(F.count(F.lit(1)), F.count("_why")).first()
        report = {"produced": n, "delivered": n - bad, "failed": bad, "dead_lettered": 0}
        if bad:
            written = dead.append(undelivered(marked.where("_why is not null"), name), once=(f"produce {tag}", 0))
            report["dead_lettered"] = written["added"] if written else 0
        if n == bad:
            return report
        rows = marked.where("_why is null").drop("_why").withColumn("_key", F.col("_key") if "_key" in events.columns else entity_key()).withColumn("_partition", partition_of(F.col("_key"), spec.partitions))
        staged = f"{shared_dir(self.spark)}/produce-{uuid.uuid4().hex}"
        placed = rows.repartitionByRange(-(-(n - bad) // CHUNK), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
        placed.write.parquet(staged)
        placed = self.spark.read.schema(placed.schema).parquet(staged).withColumn("_range", F.shiftright("_at", 33))
        ranges = placed.groupBy("_partition", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        before = Window.partitionBy("_partition").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
        given = {str(r["_partition"]): r["n"] for r in ranges.groupBy("_partition").agg(F.sum("_rows").alias("n")).collect()}  # a row per partition
        try:
            while True:
                number, past = self._ends(name)
                start = F.coalesce(*(F.when(F.col("_partition") == int(p), F.lit(top)) for p, top in past["ends"].items()), F.lit(0))
                base = ranges.select("_partition", "_range", (start + F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
                out = placed.join(F.broadcast(base), ["_partition", "_range"]).withColumn("_offset", (F.col("_at") + F.col("_base")).cast("long"))
                waiting = f"{root}/_staged/{uuid.uuid4().hex}"
                out.select(*rows.columns, "_offset", F.current_timestamp().alias("_appended_at")).write.partitionBy("_partition").parquet(waiting)
                entry = {"report": report, "folder": waiting}
                batches = dict(list(past["batches"].items())[-BATCHES + 1 :]) | {tag: entry}
                ends = past["ends"] | {p: past["ends"].get(p, 0) + m for p, m in given.items()}
                self.files.make_folder(f"{root}/_ends")
                if self.files.publish(f"{root}/_ends/{number + 1:012d}.json", json.dumps({"ends": ends, "batches": batches}, sort_keys=True)):
                    break
                self.files.remove(waiting)  # another producer has these offsets
        finally:
            self.files.remove(staged)
        self._move_in(name, entry)
        return report

    def _move_in(self, name: str, entry: dict) -> None:
        """Move a reserved batch's files to where readers look; what was moved before is passed over."""
        waiting = entry["folder"]
        for path, _ in self.files.files(waiting, ".parquet"):
            inside = path[path.index("/_partition=") + 1 :]
            self.files.move(path, self._path(name, "data", inside))
        if self.files.exists(waiting):
            self.files.remove(waiting)

    def retain(self, name: str, now: datetime | None = None) -> int:
        """Drop files whose newest row was appended longer ago than the topic keeps rows; how many. Offsets go on as before."""
        spec, now = self.describe(name), now or datetime.now(timezone.utc)
        path = self._path(name, "data")
        if spec.cleanup != "delete" or not any(e.startswith("_partition=") for e in self.files.names(path)):
            return 0
        newest = self.spark.read.schema(_PLACE).parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.max("_appended_at").alias("t"))
        gone = newest.where(F.col("t") < F.lit(now - timedelta(hours=spec.retention_hours))).select("f").toLocalIterator()
        n = 0
        for r in gone:
            self.files.remove(r["f"])
            n += 1
        return n

    def read_stream(self, name: str, schema, files_per_batch: int = 100) -> DataFrame:
        """The topic as a stream, from the earliest row; a checkpoint holds how far a group has read."""
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(self._path(name, "data"))

    def consumed(self, name: str, checkpoint: str) -> dict[int, int]:
        """The next offset of each partition for the reader with this checkpoint, from the table of the offsets it has noted there."""
        path = f"{checkpoint.rstrip('/')}/consumed.json"
        return {int(p): n for p, n in json.loads(self.files.read(path)).items()} if self.files.exists(path) else {}

    def note_consumed(self, checkpoint: str, offsets: dict[int, int]) -> None:
        """For a reader's batch: the offsets that it has gone past, kept beside its checkpoint."""
        had = self.consumed("", checkpoint)
        self.files.replace(f"{checkpoint.rstrip('/')}/consumed.json", json.dumps({p: max(had.get(p, 0), offsets.get(p, 0)) for p in had.keys() | offsets.keys()}))

    def lag(self, name: str, consumed: dict[int, int] | str) -> dict[int, int]:
        """Rows of each partition that a reader hasn't read: by its next offsets or its checkpoint; from the earliest row held if it has never read."""
        at = self.consumed(name, consumed) if isinstance(consumed, str) else consumed
        low = self.earliest(name) if not at else {}
        return {p: max(0, high - at.get(p, low.get(p, 0))) for p, high in self.counts(name).items()}
