"""One collection: envelopes to a sink, with an account of it. Bad rows are counted, never fatal; the sink is always closed."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources import feeds
from tidewatch.sources.envelope import envelope, invalid_reason
from tidewatch.sources.sinks import Sink
from tidewatch.storage import settle


@dataclass
class Collected:
    """``emitted`` rows went to the sink, ``rejected`` weren't valid envelopes; ``lag_seconds``: how long after they happened they arrived, on average."""

    source: str
    run_id: str
    status: str = "success"
    fetched: int = 0
    emitted: int = 0
    rejected: int = 0
    seconds: float = 0.0
    lag_seconds: float | None = None
    error: str = ""

    @property
    def rejection_rate(self) -> float:
        return self.rejected / self.fetched if self.fetched else 0.0


FEEDS: dict[str, tuple[str, Callable[[SparkSession, str], DataFrame]]] = {
    "urlhaus": ("ioc.url", feeds.url_feed),
    "cisa_kev": ("vuln.cve", feeds.kev_catalogue),
    "feodo": ("ioc.ip", feeds.c2_list),
    "tor_exit": ("network.tor_exit", feeds.exit_list),
}


def from_file(spark: SparkSession, source: str, path: str, host: str | None = None) -> Callable[[str], DataFrame]:
    """The envelopes of a delivered file, for ``collect``. An unknown source is refused."""
    if source == "cowrie":
        def lines(run_id: str) -> DataFrame:
            good, _ = feeds.honeypot_lines(spark.read.text(path))
            return envelope(good, "cowrie", F.col("event_type"), run_id, host)

        return lines
    kind, read = FEEDS[source]
    return lambda run_id: envelope(read(spark, path), source, kind, run_id, host)


def payloads(stored: DataFrame) -> DataFrame:
    """Stored envelopes with their payload read back as ``payload_map`` (keys and values as text).

    A payload that can't be read as an object comes back under the one key ``_unparsed``, so that no row is lost.
    """
    read = F.from_json("payload", "map<string, string>")
    lost = F.create_map(F.lit("_unparsed"), F.col("payload"))
    whole = F.try_parse_json("payload").isNotNull() & F.trim("payload").startswith("{")
    return stored.withColumn("payload_map", F.when(F.coalesce(whole, F.lit(False)), read).otherwise(lost))


def collect(source: str, envelopes: Callable[[str], DataFrame], sink: Sink, limit: int | None = None) -> Collected:
    """Run ``envelopes(run_id)`` into a sink. An error gives status ``failed`` and is reported, not raised.

    ``limit`` stops after so many rows. The envelopes are written once before they are counted, so that identities stay.
    """
    report, began = Collected(source, uuid.uuid4().hex), time.time()
    try:
        rows = envelopes(report.run_id)
        rows = settle(rows if limit is None else rows.limit(limit), "collected")
        good = rows.where(invalid_reason(rows).isNull())
        lag = (F.unix_micros("ingested_at") - F.unix_micros("occurred_at")) / F.lit(1e6)
        report.fetched, report.lag_seconds = rows.agg(F.count(F.lit(1)), F.avg(lag)).first()
        report.emitted = sink.write(good)
        report.rejected = report.fetched - report.emitted
    except Exception as e:  # noqa: BLE001 - the account of the run says what happened
        report.status, report.error = "failed", str(e)[:2000]
    finally:
        sink.close()
        report.seconds = time.time() - began
    return report
