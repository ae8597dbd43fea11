"""Schemas of the envelope, dead letters and Bronze, and when one may follow another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SOURCES = ("urlhaus", "cisa_kev", "nvd", "tor_exit", "feodo", "cowrie")
EVENT_TYPES = ("ioc.url", "ioc.ip", "vuln.cve", "network.tor_exit", "session.ssh", "session.command")


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable, {"field_id": i}) for i, (n, t, nullable) in enumerate(fields, 1)])


_S, _I, _L, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()
ENVELOPE = _struct(
    ("event_id", _S, False), ("source", _S, False), ("event_type", _S, False), ("schema_version", _I, False), ("occurred_at", _TS, False), ("ingested_at", _TS, False), ("payload", _S, False), ("content_hash", _S, False), ("collector_run_id", _S, True), ("collector_host", _S, True),
)
BRONZE = _struct(*((f.name, f.dataType, f.nullable) for f in ENVELOPE), ("_kafka_topic", _S, True), ("_kafka_partition", _I, True), ("_kafka_offset", _L, True), ("_bronze_written_at", _TS, False))
DEAD_LETTER = _struct(
    ("failed_at", _TS, False), ("source", _S, True), ("topic", _S, True), ("partition", _I, True), ("offset", _L, True), ("error_class", _S, False), ("error_message", _S, False), ("raw", _S, True), ("stage", _S, False),
)


@dataclass(frozen=True)
class Field:
    """A field of a wire schema; ``default`` counts only with ``has_default``."""

    name: str
    type: str
    has_default: bool = False


def is_full_compatible(old: list[Field], new: list[Field]) -> tuple[bool, list[str]]:
    """Whether readers of either schema can read what the other wrote, and why not.

    Fields may come or go only with a default; types stay.
    """
    a, b = {f.name: f for f in old}, {f.name: f for f in new}
    why = [f"{n}: added without a default" for n in b.keys() - a.keys() if not b[n].has_default]
    why += [f"{n}: removed, and it had no default" for n in a.keys() - b.keys() if not a[n].has_default]
    why += [f"{n}: {a[n].type} became {b[n].type}" for n in a.keys() & b.keys() if a[n].type != b[n].type]
    return not why, sorted(why)
