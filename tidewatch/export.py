"""A governed export: allowed columns only, all files or none, no address that isn't published on purpose."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import IPV4_IN_TEXT, address_pseudonym, redact_ipv4
from tidewatch.storage import Files

#: A model by its name, or None where it was never built.
Read = Callable[[str], DataFrame | None]

# The counters of the summary, and the columns, order and length of each list that is published.
COUNTERS = {
    "silver.kev_vulnerabilities": {"exploited_cves": "count(1)", "ransomware_linked_cves": "count_if(is_ransomware_linked)", "vendors": "count(DISTINCT vendor)"},
    "silver.urlhaus_urls": {"malware_urls": "count(1)", "online_malware_urls": "count_if(is_online)", "malware_hosts": "count(DISTINCT host)"},
    "silver.feodo_c2_servers": {"c2_servers": "count(1)"},
    "silver.tor_exit_nodes": {"tor_exit_nodes": "count_if(is_current_exit)"},
    "ml.url_campaigns": {"url_campaigns": "count(1)"},
    "ml.url_campaign_servers": {"clustered_servers": "count(1)"},
    "silver.honeypot_sessions": {"honeypot_sessions": "count(1)"},
}
LISTS = {
    "vendors": ("gold.vendor_exploitation", ("vendor", "exploited_cves", "ransomware_linked_cves", "ransomware_share_pct", "products_affected", "most_recently_added"), ("-exploited_cves", "vendor"), 25),
    "malware_tags": ("gold.malware_url_tags", ("tag", "urls", "online_urls", "distinct_hosts", "urls_per_host"), ("-urls", "tag"), 25),
    "c2": ("gold.c2_infrastructure", ("ip_address", "malware", "is_online", "port", "as_name", "country", "hosting_type", "was_ever_tor_exit", "is_current_tor_exit", "first_seen", "last_online"), ("-is_online", "malware", "ip_address"), None),
    "campaigns": ("ml.url_campaigns", ("campaign_id", "servers", "urls", "online_urls", "distinct_subnets", "top_tags", "top_paths"), ("-servers", "campaign_id"), 20),
    "watchlist": ("ml.kev_ransomware_scores", ("watchlist_rank", "cve_id", "vendor", "product", "vulnerability_name", "date_added", "ransomware_probability"), ("watchlist_rank",), 25),
}


class ExportRefused(RuntimeError):
    """Nothing was written."""


def encode(value):
    """What JSON lacks: times and dates in ISO form, decimals as numbers."""
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    raise TypeError(type(value))


def rows(df: DataFrame | None, most: int | None) -> list[dict]:
    """The rows of a report for the driver, ``most`` of them if given; none for a table that isn't there."""
    return [] if df is None else [r.asDict(recursive=True) for r in (df if most is None else df.limit(most)).collect()]


def summary(read: Read) -> dict[str, int | None]:
    """All counters; null where the model was never built."""
    found: dict[str, int | None] = {}
    for name, counters in COUNTERS.items():
        df = read(name)
        row = None if df is None else df.agg(*(F.expr(e).alias(c) for c, e in counters.items())).first()
        found |= {c: None if row is None else row[c] for c in counters}
    return found


def report(read: Read, name: str) -> DataFrame | None:
    """A published list as a table: its columns, in its order, as long as it may be."""
    model, columns, order, most = LISTS[name]
    df = read(model)
    if df is None:
        return None
    if name == "watchlist":
        df = df.where("on_watchlist")
    by: list[Column] = [F.desc_nulls_last(o[1:]) if o[0] == "-" else F.asc_nulls_last(o) for o in order]
    df = df.orderBy(*by).select(*columns)
    return df if most is None else df.limit(most)


def honeypot(sessions: DataFrame | None, events: DataFrame | None, anomalies: DataFrame | None, key: bytes | None) -> dict:
    """The honeypot's figures: texts redacted, source addresses only as pseudonyms. Without a key it is refused."""
    if sessions is None or sessions.isEmpty():
        return {"available": False}
    if key is None:
        raise ExportRefused("sessions are there, but no pseudonymisation key")
    overview = sessions.agg(F.count("*").alias("sessions"), F.min("started_at").alias("first_session"), F.max("started_at").alias("last_session"), F.count_if("login_succeeded").alias("logged_in"), F.count_if(F.col("commands_run") > 0).alias("ran_commands"), F.count_if(F.col("downloads") > 0).alias("downloaded"), F.countDistinct("src_ip").alias("distinct_sources"))

    def top(df, column, name, n, only=None):
        if df is None:
            return []
        kept = df.where(F.col(column).isNotNull() if only is None else F.col(column).isNotNull() & only)
        return rows(kept.groupBy(F.col(column).alias("v")).agg(F.count("*").alias(name)).orderBy(F.desc(name), "v").limit(n).select(redact_ipv4(F.col("v")).alias("value"), name), n)

    login = F.col("eventid").isin("cowrie.login.failed", "cowrie.login.success")
    flagged = [] if anomalies is None else rows(anomalies.where("is_flagged").orderBy("anomaly_rank").limit(20).select("anomaly_rank", "started_at", "protocol", "commands_run", "downloads", redact_ipv4(F.col("reasons")).alias("reasons"), address_pseudonym(F.col("src_ip"), key).alias("source")), 20)
    return {
        "available": True,
        "overview": rows(overview, 1)[0],
        "daily": rows(sessions.groupBy(F.to_date("started_at").alias("day")).agg(F.count("*").alias("sessions")).orderBy(F.desc("day")), 30),
        "protocols": rows(sessions.groupBy(F.coalesce("protocol", F.lit("unknown")).alias("protocol")).agg(F.count("*").alias("sessions")).orderBy(F.desc("sessions"), "protocol"), 50),
        "top_usernames": top(events, "username", "attempts", 15, login),
        "top_passwords": top(events, "password", "attempts", 15, login),
        "top_first_commands": top(sessions, "first_command", "sessions", 10),
        "flagged_sessions": flagged,
    }


def build(read: Read, key: bytes | None) -> dict[str, object]:
    """The payloads of all seven files but for their envelope."""
    lists = {name: rows(report(read, name), None) for name in LISTS}
    return {"summary": summary(read), **lists, "honeypot": honeypot(read("silver.honeypot_sessions"), read("silver.honeypot_events"), read("ml.honeypot_session_anomalies"), key)}


def publish(spark: SparkSession, folder: str, payloads: Mapping[str, object], secrets: DataFrame | None = None, run_url: str | None = None, revision: str | None = None, models: Mapping[str, str] | None = None) -> list[str]:
    """Write ``<name>.json`` for every payload into a new folder and point ``current.json`` at it: readers see all new files, or none.

    The honeypot's text is scanned, always: an address anywhere in it refuses the whole export. ``secrets``
    (one column) are further values that must not stand in it; the text, which is small, is sent to the values, not the values to the driver.
    """
    about = {"schema_version": 1, "generated_at": datetime.now(timezone.utc).isoformat(), "run_url": run_url, "revision": revision, "models": dict(models or {})}
    texts = {}
    for name, p in payloads.items():
        own = about | ({"counts": p} if name == "summary" else {"data": p})
        texts[name] = json.dumps(own if name == "summary" else {"schema_version": 1, "generated_at": about["generated_at"], "data": p}, default=encode, sort_keys=True)
    guarded = json.dumps(payloads.get("honeypot"), default=encode, ensure_ascii=False)
    if found := re.search(IPV4_IN_TEXT, guarded):
        raise ExportRefused(f"an address stands in the honeypot's text, at {found.start()}")
    if secrets is not None:
        c = F.trim(secrets.columns[0])
        if secrets.where(c != "").where(F.lit(guarded).contains(c)).limit(1).count():
            raise ExportRefused("a source address stands in the honeypot's text")
    files, version = Files(spark), f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    root = folder.rstrip("/")
    for name, text in texts.items():
        files.write(f"{root}/{version}/{name}.json", text)
    files.replace(f"{root}/current.json", json.dumps({"version": version, "files": sorted(texts)}))
    return sorted(texts)


def published(spark: SparkSession, folder: str) -> dict[str, dict]:
    """What readers see: every file of the current export."""
    files, root = Files(spark), folder.rstrip("/")
    now = json.loads(files.read(f"{root}/current.json"))
    return {n: json.loads(files.read(f"{root}/{now['version']}/{n}.json")) for n in now["files"]}
