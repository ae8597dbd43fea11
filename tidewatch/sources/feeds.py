"""Feeds in their delivered formats, as ``(occurred_at, payload)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the columns of the URL feed, which has no header line.
URL_COLUMNS = "id string, dateadded string, url string, url_status string, last_online string, threat string, tags string, urlhaus_link string, reporter string"
_KEV = "struct<catalogVersion: string, vulnerabilities: array<struct<cveID: string, vendorProject: string, product: string, vulnerabilityName: string, dateAdded: string, shortDescription: string, requiredAction: string, dueDate: string, knownRansomwareCampaignUse: string, cwes: array<string>, notes: string>>>"
_FEODO = "array<struct<ip_address: string, port: int, status: string, hostname: string, as_number: int, as_name: string, country: string, first_seen: string, last_online: string, malware: string>>"


def _time(c: Column, form: str) -> Column:
    return F.try_to_timestamp(c, F.lit(form))


def _payload(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def url_feed(spark: SparkSession, path: str) -> DataFrame:
    """The URL feed (CSV with ``#`` lines). Rows without URL or a good date are left out."""
    raw = spark.read.schema(URL_COLUMNS).option("comment", "#").option("quote", '"').option("escape", '"').csv(path)
    tags = F.filter(F.transform(F.split(F.coalesce("tags", F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")
    at = _time(F.col("dateadded"), "yyyy-MM-dd HH:mm:ss")
    return raw.where(F.col("url").isNotNull() & (F.col("url") != "") & at.isNotNull()).select(at.alias("occurred_at"), _payload(F.col("id").alias("urlhaus_id"), "url", "url_status", "last_online", "threat", tags.alias("tags"), "urlhaus_link", "reporter").alias("payload"))


def kev_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of exploited vulnerabilities (one JSON object); a bad date becomes the time of reading."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", _KEV).alias("k"))
    v = raw.select("k.catalogVersion", F.explode("k.vulnerabilities").alias("v"))
    at = F.coalesce(_time(F.col("v.dateAdded"), "yyyy-MM-dd"), F.current_timestamp())
    return v.select(
        at.alias("occurred_at"),
        _payload(F.col("v.cveID").alias("cve_id"), F.col("v.vendorProject").alias("vendor"), "v.product", F.col("v.vulnerabilityName").alias("name"), F.col("v.shortDescription").alias("description"), F.col("v.requiredAction").alias("required_action"), F.col("v.dateAdded").alias("date_added"), F.col("v.dueDate").alias("due_date"), F.col("v.knownRansomwareCampaignUse").alias("ransomware_use"), F.coalesce("v.cwes", F.array().cast("array<string>")).alias("cwes"), "v.notes", F.col("catalogVersion").alias("catalog_version")).alias("payload"),
    )


def c2_list(spark: SparkSession, path: str) -> DataFrame:
    """The C2 list (one JSON array); anything else gives no rows."""
    raw = spark.read.text(path, wholetext=True).where(F.trim("value").startswith("[")).select(F.explode(F.from_json("value", _FEODO)).alias("c")).where("c is not null and c.ip_address is not null")
    at = F.coalesce(_time(F.col("c.first_seen"), "yyyy-MM-dd HH:mm:ss"), F.current_timestamp())
    return raw.select(at.alias("occurred_at"), _payload(*(F.col(f"c.{n}") for n in ("ip_address", "port", "status", "hostname", "as_number", "as_name", "country", "first_seen", "last_online", "malware"))).alias("payload"))


def exit_list(spark: SparkSession, path: str) -> DataFrame:
    """One address per line; blank and ``#`` lines are left out; all rows share one time."""
    line = F.trim("value")
    rows = spark.read.text(path).select(line.alias("ip_address")).where((F.col("ip_address") != "") & ~F.col("ip_address").startswith("#"))
    return rows.select(F.current_timestamp().alias("occurred_at"), _payload("ip_address").alias("payload"))


def honeypot_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log lines as ``(occurred_at, event_type, payload)``, and the lines refused: no JSON object, another program's event, no time with a zone."""
    from tidewatch.sources.envelope import aware_timestamp

    p = F.from_json(column, "eventid string, timestamp string, session string")
    read = lines.withColumn("_p", p).withColumn("occurred_at", aware_timestamp(F.col("_p.timestamp")))
    good = F.coalesce(F.try_parse_json(column).isNotNull() & F.col("_p.eventid").startswith("cowrie.") & F.col("occurred_at").isNotNull(), F.lit(False))
    kind = F.when(F.col("_p.eventid").startswith("cowrie.command."), "session.command").otherwise("session.ssh")
    return read.where(good).select("occurred_at", kind.alias("event_type"), F.col(column).alias("payload")), read.where(~good).select(F.col(column).alias("raw"))


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines of all shapes under ``source=/date=`` folders, in one table."""
    return spark.read.option("mergeSchema", "true").json(path)
