"""Envelopes around payloads: identity, content hash, validation."""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import EVENT_TYPES, SOURCES


class Uuid7:
    """Time-ordered identifiers: within a process each is greater than the one before."""

    def __init__(self) -> None:
        self._lock, self._ms, self._n = threading.Lock(), 0, 0

    def __call__(self) -> str:
        with self._lock:
            ms = time.time_ns() // 1_000_000
            if ms > self._ms:
                self._ms, self._n = ms, int.from_bytes(os.urandom(1), "big")
            else:
                self._n += 1
                if self._n > 0xFFF:
                    self._ms, self._n = self._ms + 1, 0
            head, n = self._ms, self._n
        tail = int.from_bytes(os.urandom(8), "big") & ((1 << 62) - 1)
        return str(uuid.UUID(int=(head << 80) | (7 << 76) | (n << 64) | (2 << 62) | tail))


def canonical_json(value: object) -> str:
    """Keys sorted, no blanks, ASCII only; what JSON lacks as text."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)


def utc(moment: datetime) -> datetime:
    """In UTC; a time without a zone is refused."""
    if moment.tzinfo is None:
        raise ValueError("a time needs a zone")
    return moment.astimezone(timezone.utc)


def aware_timestamp(text: Column) -> Column:
    """An ISO-8601 text with a zone as a timestamp; null for any other."""
    return F.when(text.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), text.try_cast("timestamp"))


def canonical(payload: Column) -> Column:
    """A JSON text in canonical form; what isn't JSON stays as it is. Arrow batches; Spark's own writer doesn't sort keys."""

    def again(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else canonical_json(json.loads(t))
            except ValueError:
                return t

        return texts.map(one)

    return F.pandas_udf(again, "string")(payload)


def with_uuid7(df: DataFrame, name: str = "event_id") -> DataFrame:
    """A new identifier per row, rising within each partition."""
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Uuid7()
        for pdf in batches:
            yield pdf.assign(**{name: [make() for _ in range(len(pdf))]})

    return df.mapInPandas(number, f"{fields}, `{name}` string")


def envelope(rows: DataFrame, source: str, event_type: Column | str, run_id: str | None = None, host: str | None = None) -> DataFrame:
    """``(occurred_at, payload)`` rows as envelopes: canonical payload, its hash, identity, arrival."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    c = rows.withColumn("payload", canonical(F.col("payload"))).withColumn("content_hash", F.sha2("payload", 256))
    return with_uuid7(c.select(F.lit(source).alias("source"), kind.alias("event_type"), F.lit(1).alias("schema_version"), "occurred_at", F.current_timestamp().alias("ingested_at"), "payload", "content_hash", F.lit(run_id).cast("string").alias("collector_run_id"), F.lit(host).cast("string").alias("collector_host")))


def invalid_reason(df: DataFrame) -> Column:
    """Why an envelope isn't valid; null if it is."""
    missing = [F.when(F.col(c).isNull(), f"{c} is missing") for c in ("event_id", "payload", "content_hash", "occurred_at", "ingested_at")]
    return F.coalesce(*missing, F.when(~F.coalesce(F.col("source").isin(list(SOURCES)), F.lit(False)), "unknown source"), F.when(~F.coalesce(F.col("event_type").isin(list(EVENT_TYPES)), F.lit(False)), "unknown event type"))
