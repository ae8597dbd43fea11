"""Staging, silver and gold tables as functions from tables to tables.

A payload is parsed once per row, all leaves as text, and cast afterwards.
"Latest row of each key" is one aggregation with partial maxima, not a sort of
every key's rows; nulls of the offset count lowest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import is_documentation_address
from tidewatch.functions.urls import url_host


def _parsed(bronze: DataFrame, source: str, leaves: str) -> DataFrame:
    return bronze.where(F.col("source") == source).withColumn("p", F.from_json("payload", leaves))


def _int(c: Column) -> Column:
    """A text as a whole number, decimals rounded half away from zero; null for what isn't a number or doesn't fit."""
    number = F.when(c.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$"), F.round(F.trim(c).try_cast("double")))
    return F.when(number.between(-(2**31), 2**31 - 1), number.cast("int"))


def _date(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date"))


_FIXED = ("event_id", "ingested_at", "content_hash", "_kafka_offset")


def stg_cisa_kev(bronze: DataFrame) -> DataFrame:
    b = _parsed(bronze, "cisa_kev", "cve_id string, vendor string, product string, name string, description string, required_action string, date_added string, due_date string, ransomware_use string, cwes array<string>, catalog_version string")
    return b.select(
        *_FIXED, "occurred_at", "p.cve_id", "p.vendor", "p.product", F.col("p.name").alias("vulnerability_name"), "p.description", "p.required_action",
        _date(F.col("p.date_added")).alias("date_added"), _date(F.col("p.due_date")).alias("due_date"), F.col("p.ransomware_use").alias("ransomware_use_raw"), (F.col("p.ransomware_use") == "Known").alias("is_ransomware_linked"), "p.cwes", "p.catalog_version",
    )


def stg_urlhaus(bronze: DataFrame) -> DataFrame:
    b = _parsed(bronze, "urlhaus", "urlhaus_id string, url string, url_status string, threat string, tags array<string>, reporter string, urlhaus_link string")
    return b.select(*_FIXED, F.col("occurred_at").alias("listed_at"), "p.urlhaus_id", "p.url", url_host(F.col("p.url")).alias("host"), "p.url_status", "p.threat", "p.tags", "p.reporter", "p.urlhaus_link")


def stg_feodo(bronze: DataFrame) -> DataFrame:
    b = _parsed(bronze, "feodo", "ip_address string, port string, status string, hostname string, as_number string, as_name string, country string, malware string, first_seen string, last_online string")
    return b.select(*_FIXED, "collector_host", "p.ip_address", _int(F.col("p.port")).alias("port"), "p.status", "p.hostname", _int(F.col("p.as_number")).alias("as_number"), "p.as_name", "p.country", "p.malware", F.col("p.first_seen").try_cast("timestamp_ntz").alias("first_seen"), _date(F.col("p.last_online")).alias("last_online"))


def stg_tor_exit(bronze: DataFrame) -> DataFrame:
    return _parsed(bronze, "tor_exit", "ip_address string").select(*_FIXED, "p.ip_address")


def stg_cowrie(bronze: DataFrame) -> DataFrame:
    b = _parsed(bronze, "cowrie", "eventid string, session string, sensor string, src_ip string, src_port string, dst_port string, protocol string, username string, password string, input string, url string, shasum string, version string, hassh string, duration_ms string, duration string")
    return b.select(
        *_FIXED, "occurred_at", "collector_host", "p.eventid", F.col("p.session").alias("session_id"), "p.sensor", "p.src_ip", _int(F.col("p.src_port")).alias("src_port"), _int(F.col("p.dst_port")).alias("dst_port"), "p.protocol", "p.username", "p.password",
        F.col("p.input").alias("command_input"), F.col("p.url").alias("download_url"), F.col("p.shasum").alias("download_sha256"), F.col("p.version").alias("client_version"), "p.hassh",
        F.coalesce(F.col("p.duration_ms").try_cast("double") / 1000, F.col("p.duration").try_cast("double")).alias("duration_seconds"),
    )


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str], observed: str = "ingested_at") -> DataFrame:
    """The newest row of each key, with when it was first and last observed and how often; null keys are left out."""
    rest = [c for c in rows.columns if c != key]
    last = F.max(F.struct(*order, F.struct(*rest).alias("_row")))
    return (
        rows.where(F.col(key).isNotNull()).groupBy(key)
        .agg(last["_row"].alias("_row"), F.min(observed).alias("first_observed_at"), F.max(observed).alias("last_observed_at"), F.count(F.lit(1)).alias("times_observed"))
        .select(key, *(F.col(f"_row.{c}").alias(c) for c in rest), "first_observed_at", "last_observed_at", "times_observed")
    )


_NEWEST = ("ingested_at", "_kafka_offset", "event_id")


def kev_vulnerabilities(stg: DataFrame) -> DataFrame:
    return latest_per_key(stg, "cve_id", _NEWEST).withColumnRenamed("event_id", "source_event_id").drop("ingested_at", "_kafka_offset", "content_hash", "occurred_at", "ransomware_use_raw")


def urlhaus_urls(stg: DataFrame) -> DataFrame:
    s = latest_per_key(stg, "url", _NEWEST).withColumns({"is_online": F.col("url_status") == "online", "tags": F.coalesce("tags", F.array().cast("array<string>"))})
    return s.withColumnRenamed("event_id", "source_event_id").drop("ingested_at", "_kafka_offset", "content_hash")


def feodo_c2_servers(stg: DataFrame) -> DataFrame:
    s = latest_per_key(stg.where(~is_documentation_address(F.col("ip_address"))), "ip_address", _NEWEST).withColumn("is_online", F.col("status") == "online")
    return s.withColumnRenamed("event_id", "source_event_id").drop("ingested_at", "_kafka_offset", "content_hash", "collector_host")


def tor_exit_nodes(stg: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", "ingested_at")
    newest = stg.agg(F.max(minute).alias("snapshot_minute"))  # one row
    per = stg.where("ip_address is not null").groupBy("ip_address").agg(F.min("ingested_at").alias("first_observed_at"), F.max("ingested_at").alias("last_observed_at"), F.countDistinct(minute).alias("snapshots_seen_in"))
    return per.crossJoin(F.broadcast(newest)).withColumn("is_current_exit", F.date_trunc("minute", "last_observed_at") == F.col("snapshot_minute")).drop("snapshot_minute")


def honeypot_events(stg: DataFrame) -> DataFrame:
    """One row per content, the first copy that arrived; documentation addresses are left out."""
    rows = stg.where(F.col("eventid").isNotNull() & F.col("session_id").isNotNull() & F.col("src_ip").isNotNull() & ~is_documentation_address(F.col("src_ip")))
    rest = [c for c in rows.columns if c != "content_hash"]
    order = F.struct("ingested_at", F.coalesce("_kafka_offset", F.lit(2**63 - 1)), "event_id", F.struct(*rest).alias("_row"))
    first = rows.groupBy("content_hash").agg(F.min(order)["_row"].alias("_row")).select("content_hash", *(F.col(f"_row.{c}").alias(c) for c in rest))
    return first.withColumnsRenamed({"event_id": "source_event_id", "ingested_at": "first_ingested_at"}).drop("_kafka_offset", "collector_host")


def honeypot_sessions(events: DataFrame) -> DataFrame:
    """One row per session; of equal times the least content hash counts as first."""
    e = F.col("eventid")
    first = lambda c, *also: F.min(F.when(F.col(c).isNotNull() & (also[0] if also else F.lit(True)), F.struct("occurred_at", "content_hash", c)))[c]
    return events.groupBy("session_id").agg(
        first("sensor").alias("sensor"), first("src_ip").alias("src_ip"), F.max("protocol").alias("protocol"),
        F.max(F.when(e == "cowrie.client.version", F.col("client_version"))).alias("client_version"), F.max(F.when(e == "cowrie.client.kex", F.col("hassh"))).alias("hassh"),
        F.min("occurred_at").alias("started_at"), F.max(F.when(e == "cowrie.session.closed", F.col("occurred_at"))).alias("ended_at"), F.max(F.when(e == "cowrie.session.closed", F.col("duration_seconds"))).alias("duration_seconds"),
        F.coalesce(F.bool_or(e == "cowrie.session.closed"), F.lit(False)).alias("is_closed"), F.count_if(e.isin("cowrie.login.failed", "cowrie.login.success")).alias("login_attempts"), F.coalesce(F.bool_or(e == "cowrie.login.success"), F.lit(False)).alias("login_succeeded"),
        F.countDistinct("username").alias("distinct_usernames"), F.countDistinct("password").alias("distinct_passwords"), F.count_if(e == "cowrie.command.input").alias("commands_run"), first("command_input", e == "cowrie.command.input").alias("first_command"),
        F.count_if(e == "cowrie.session.file_download").alias("downloads"), F.count(F.lit(1)).alias("event_count"),
    )


def vendor_exploitation(kev: DataFrame, as_of) -> DataFrame:
    """``as_of`` (a date) decides which deadlines are still open."""
    linked, n = F.count_if("is_ransomware_linked"), F.count(F.lit(1))
    return kev.groupBy("vendor").agg(
        n.alias("exploited_cves"), linked.alias("ransomware_linked_cves"), F.round(F.lit(100.0) * linked.cast("double") / n, 1).alias("ransomware_share_pct"), F.countDistinct("product").alias("products_affected"),
        F.min("date_added").alias("first_added"), F.max("date_added").alias("most_recently_added"), F.count_if(F.col("due_date") >= F.lit(as_of).cast("date")).alias("open_deadlines"),
    )


def malware_url_tags(urls: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    tagged = urls.where(F.size("tags") > 0).select("url", "host", "is_online", F.explode("tags").alias("t"))
    return tagged.groupBy(F.lower("t").alias("tag")).agg(n.alias("urls"), F.count_if("is_online").alias("online_urls"), F.countDistinct("host").alias("distinct_hosts"), F.round(n.cast("double") / F.nullif(F.countDistinct("host"), F.lit(0)), 1).alias("urls_per_host"))


# Names of large hosting companies, as they stand in AS names.
CLOUDS = "amazon|aws|digitalocean|google|microsoft|azure|ovh|hetzner|linode|akamai|vultr|oracle"


def c2_infrastructure(c2: DataFrame, tor: DataFrame) -> DataFrame:
    t = tor.select("ip_address", F.lit(True).alias("_tor"), F.col("is_current_exit").alias("_now"))
    return c2.join(t, "ip_address", "left").select(
        "ip_address", "malware", "is_online", "port", "as_name", "as_number", "country", "hostname", "first_seen", "last_online", F.col("_tor").isNotNull().alias("was_ever_tor_exit"), F.coalesce("_now", F.lit(False)).alias("is_current_tor_exit"),
        F.when(F.lower(F.coalesce("as_name", F.lit(""))).rlike(CLOUDS), "commercial_cloud").otherwise("other").alias("hosting_type"),
    )
