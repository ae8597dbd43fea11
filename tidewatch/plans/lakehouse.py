"""Staging, silver, gold, exploration and export queries over ``bronze_events``, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import export
from tidewatch.functions.text import redact_ipv4
from tidewatch.models import layers as m
from tidewatch.sources.tables import table

#: The day on which deadlines are judged.
AS_OF = "2024-06-30"


def flat(df: DataFrame) -> DataFrame:
    """Times as microseconds, dates as text and lists joined by commas, so that results compare across engines."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "timestamp":
            c = F.unix_micros(c)
        elif kind == "timestamp_ntz":
            c = F.unix_micros(c.cast("timestamp"))
        elif kind == "date":
            c = c.cast("string")
        elif kind.startswith("array"):
            c = F.array_join(c, ",")
        cols.append(c.alias(name))
    return df.select(*cols)


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bronze_events")


def _silver(spark: SparkSession, d: str, name: str) -> DataFrame:
    b = _bronze(spark, d)
    if name == "honeypot_sessions":
        return m.honeypot_sessions(m.honeypot_events(m.stg_cowrie(b)))
    stg, fn = {"kev": (m.stg_cisa_kev, m.kev_vulnerabilities), "urls": (m.stg_urlhaus, m.urlhaus_urls), "c2": (m.stg_feodo, m.feodo_c2_servers), "tor": (m.stg_tor_exit, m.tor_exit_nodes), "honeypot_events": (m.stg_cowrie, m.honeypot_events)}[name]
    return fn(stg(b))


def _gold(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name == "vendors":
        return m.vendor_exploitation(_silver(spark, d, "kev"), AS_OF)
    if name == "tags":
        return m.malware_url_tags(_silver(spark, d, "urls"))
    return m.c2_infrastructure(_silver(spark, d, "c2"), _silver(spark, d, "tor"))


def explore_sources(spark, d):
    lag = F.avg((F.unix_micros("ingested_at") - F.unix_micros("occurred_at")) / F.lit(86_400e6))
    return _bronze(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("events"), F.min("occurred_at").cast("date").cast("string").alias("oldest_event"), F.max("occurred_at").cast("date").cast("string").alias("newest_event"), F.round(lag, 4).alias("avg_lag_days"))


def explore_vendors(spark, d):
    k = m.stg_cisa_kev(_bronze(spark, d))
    return k.groupBy("vendor").agg(F.count(F.lit(1)).alias("exploited_cves"), F.sum(F.when(F.col("ransomware_use_raw") == "Known", 1).otherwise(0)).alias("used_by_ransomware")).orderBy(F.desc("exploited_cves"), F.asc_nulls_last("vendor")).limit(10)


def explore_years(spark, d):
    k = m.stg_cisa_kev(_bronze(spark, d))
    return k.groupBy(F.year("date_added").alias("year_added")).agg(F.count(F.lit(1)).alias("cves_added"), F.sum(F.when(F.col("ransomware_use_raw") == "Known", 1).otherwise(0)).alias("ransomware_linked")).orderBy(F.desc_nulls_last("year_added")).limit(8)


def explore_tags(spark, d):
    return m.stg_urlhaus(_bronze(spark, d)).where(F.size("tags") > 0).select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("malicious_urls")).orderBy(F.desc("malicious_urls"), "tag").limit(12)


def explore_c2_tor(spark, d):
    c2 = m.stg_feodo(_bronze(spark, d)).select(F.col("ip_address").alias("ip"), "malware").distinct()
    tor = m.stg_tor_exit(_bronze(spark, d)).select(F.col("ip_address").alias("ip"), F.lit(True).alias("t")).distinct()
    return c2.join(tor, "ip", "left").select("malware", "ip", F.col("t").isNotNull().alias("is_tor_exit"))


def _model(spark, d):
    """The models that the export reads; those of the ML layer were never built here."""
    silver = {"silver.kev_vulnerabilities": "kev", "silver.urlhaus_urls": "urls", "silver.feodo_c2_servers": "c2", "silver.tor_exit_nodes": "tor", "silver.honeypot_sessions": "honeypot_sessions"}
    gold = {"gold.vendor_exploitation": "vendors", "gold.malware_url_tags": "tags", "gold.c2_infrastructure": "c2"}
    return lambda name: _silver(spark, d, silver[name]) if name in silver else _gold(spark, d, gold[name]) if name in gold else None


def export_counts(spark, d):
    """All eleven counters; null for models that were never built."""
    counts = export.summary(_model(spark, d))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def export_vendors(spark, d):
    return flat(export.report(_model(spark, d), "vendors"))


def export_tags(spark, d):
    return export.report(_model(spark, d), "malware_tags")


def export_c2(spark, d):
    return flat(export.report(_model(spark, d), "c2"))


def export_overview(spark, d):
    return flat(_silver(spark, d, "honeypot_sessions").agg(F.count(F.lit(1)).alias("sessions"), F.min("started_at").alias("first_session"), F.max("started_at").alias("last_session"), F.count_if("login_succeeded").alias("logged_in"), F.count_if(F.col("commands_run") > 0).alias("ran_commands"), F.count_if(F.col("downloads") > 0).alias("downloaded"), F.countDistinct("src_ip").alias("distinct_sources")))


def export_daily(spark, d):
    return _silver(spark, d, "honeypot_sessions").groupBy(F.date_trunc("day", "started_at").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("sessions")).orderBy(F.desc("day")).limit(30)


def export_protocols(spark, d):
    return _silver(spark, d, "honeypot_sessions").groupBy(F.coalesce("protocol", F.lit("unknown")).alias("protocol")).agg(F.count(F.lit(1)).alias("sessions"))


def _logins(spark, d, column):
    e = _silver(spark, d, "honeypot_events").where(F.col("eventid").isin("cowrie.login.failed", "cowrie.login.success") & F.col(column).isNotNull())
    top = e.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("attempts")).orderBy(F.desc("attempts"), "v").limit(15)
    return top.select(redact_ipv4(F.col("v")).alias("value"), "attempts")


def export_usernames(spark, d):
    return _logins(spark, d, "username")


def export_passwords(spark, d):
    return _logins(spark, d, "password")


def export_commands(spark, d):
    top = _silver(spark, d, "honeypot_sessions").where("first_command is not null").groupBy(F.col("first_command").alias("v")).agg(F.count(F.lit(1)).alias("sessions")).orderBy(F.desc("sessions"), "v").limit(10)
    return top.select(redact_ipv4(F.col("v")).alias("value"), "sessions")


QUERIES = {
    **{f"stg_{n}": (lambda s, d, f=f: flat(f(_bronze(s, d)))) for n, f in (("cisa_kev", m.stg_cisa_kev), ("urlhaus", m.stg_urlhaus), ("feodo", m.stg_feodo), ("tor_exit", m.stg_tor_exit), ("cowrie", m.stg_cowrie))},
    **{f"silver_{n}": (lambda s, d, k=k: flat(_silver(s, d, k))) for n, k in (("kev_vulnerabilities", "kev"), ("urlhaus_urls", "urls"), ("feodo_c2_servers", "c2"), ("tor_exit_nodes", "tor"), ("honeypot_events", "honeypot_events"), ("honeypot_sessions", "honeypot_sessions"))},
    **{f"gold_{n}": (lambda s, d, k=k: flat(_gold(s, d, k))) for n, k in (("vendor_exploitation", "vendors"), ("malware_url_tags", "tags"), ("c2_infrastructure", "c2"))},
    **{f.__name__: f for f in (explore_sources, explore_vendors, explore_years, explore_tags, explore_c2_tor, export_counts, export_vendors, export_tags, export_c2, export_overview, export_daily, export_protocols, export_usernames, export_passwords, export_commands)},
}

_j = lambda *ks: ", ".join(f"json_extract_string(payload, '$.{k}') AS {k}" for k in ks)
_list = lambda k: f"from_json(json_extract(payload, '$.{k}'), '[\"VARCHAR\"]')"
_CTES = f"""kev0 AS (SELECT event_id, ingested_at, content_hash, _kafka_offset, occurred_at, {_j("cve_id", "vendor", "product")}, json_extract_string(payload, '$.name') AS vulnerability_name, {_j("description", "required_action")},
  try_cast(json_extract_string(payload, '$.date_added') AS DATE) AS date_added, try_cast(json_extract_string(payload, '$.due_date') AS DATE) AS due_date, json_extract_string(payload, '$.ransomware_use') AS ransomware_use_raw,
  json_extract_string(payload, '$.ransomware_use') = 'Known' AS is_ransomware_linked, {_list("cwes")} AS cwes, {_j("catalog_version")} FROM bronze_events WHERE source = 'cisa_kev'),
url0 AS (SELECT event_id, ingested_at, content_hash, _kafka_offset, occurred_at AS listed_at, {_j("urlhaus_id", "url")}, nullif(lower(regexp_extract(json_extract_string(payload, '$.url'), '^[a-zA-Z]+://([^/:?#]+)', 1)), '') AS host, {_j("url_status", "threat")}, {_list("tags")} AS tags, {_j("reporter", "urlhaus_link")} FROM bronze_events WHERE source = 'urlhaus'),
feo0 AS (SELECT event_id, ingested_at, content_hash, _kafka_offset, collector_host, {_j("ip_address")}, try_cast(json_extract_string(payload, '$.port') AS INTEGER) AS port, {_j("status", "hostname")}, try_cast(json_extract_string(payload, '$.as_number') AS INTEGER) AS as_number, {_j("as_name", "country", "malware")},
  try_cast(json_extract_string(payload, '$.first_seen') AS TIMESTAMP) AS first_seen, try_cast(json_extract_string(payload, '$.last_online') AS DATE) AS last_online FROM bronze_events WHERE source = 'feodo'),
tor0 AS (SELECT event_id, ingested_at, content_hash, _kafka_offset, {_j("ip_address")} FROM bronze_events WHERE source = 'tor_exit'),
cow0 AS (SELECT event_id, ingested_at, content_hash, _kafka_offset, occurred_at, collector_host, {_j("eventid")}, json_extract_string(payload, '$.session') AS session_id, {_j("sensor", "src_ip")}, try_cast(json_extract_string(payload, '$.src_port') AS INTEGER) AS src_port, try_cast(json_extract_string(payload, '$.dst_port') AS INTEGER) AS dst_port,
  {_j("protocol", "username", "password")}, json_extract_string(payload, '$.input') AS command_input, json_extract_string(payload, '$.url') AS download_url, json_extract_string(payload, '$.shasum') AS download_sha256, json_extract_string(payload, '$.version') AS client_version, {_j("hassh")},
  coalesce(try_cast(json_extract_string(payload, '$.duration_ms') AS DOUBLE) / 1000, try_cast(json_extract_string(payload, '$.duration') AS DOUBLE)) AS duration_seconds FROM bronze_events WHERE source = 'cowrie'),
kev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY ingested_at DESC, _kafka_offset DESC NULLS LAST, event_id DESC) AS rn, min(ingested_at) OVER (PARTITION BY cve_id) AS first_observed_at, max(ingested_at) OVER (PARTITION BY cve_id) AS last_observed_at, count(*) OVER (PARTITION BY cve_id) AS times_observed FROM kev0 WHERE cve_id IS NOT NULL) WHERE rn = 1),
url AS (SELECT *, url_status = 'online' AS is_online FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingested_at DESC, _kafka_offset DESC NULLS LAST, event_id DESC) AS rn, min(ingested_at) OVER (PARTITION BY url) AS first_observed_at, max(ingested_at) OVER (PARTITION BY url) AS last_observed_at, count(*) OVER (PARTITION BY url) AS times_observed FROM url0 WHERE url IS NOT NULL) WHERE rn = 1),
feo AS (SELECT *, status = 'online' AS is_online FROM (SELECT *, row_number() OVER (PARTITION BY ip_address ORDER BY ingested_at DESC, _kafka_offset DESC NULLS LAST, event_id DESC) AS rn, min(ingested_at) OVER (PARTITION BY ip_address) AS first_observed_at, max(ingested_at) OVER (PARTITION BY ip_address) AS last_observed_at, count(*) OVER (PARTITION BY ip_address) AS times_observed FROM feo0
  WHERE ip_address IS NOT NULL AND NOT (ip_address LIKE '192.0.2.%' OR ip_address LIKE '198.51.100.%' OR ip_address LIKE '203.0.113.%')) WHERE rn = 1),
tor AS (SELECT *, date_trunc('minute', last_observed_at) = (SELECT max(date_trunc('minute', ingested_at)) FROM tor0) AS is_current_exit FROM (SELECT ip_address, min(ingested_at) AS first_observed_at, max(ingested_at) AS last_observed_at, count(DISTINCT date_trunc('minute', ingested_at)) AS snapshots_seen_in FROM tor0 WHERE ip_address IS NOT NULL GROUP BY ip_address)),
ev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY ingested_at, _kafka_offset NULLS LAST, event_id) AS rn FROM cow0 WHERE eventid IS NOT NULL AND session_id IS NOT NULL AND src_ip IS NOT NULL AND NOT (src_ip LIKE '192.0.2.%' OR src_ip LIKE '198.51.100.%' OR src_ip LIKE '203.0.113.%')) WHERE rn = 1),
ses AS (SELECT session_id, arg_min(sensor, (occurred_at, content_hash)) FILTER (sensor IS NOT NULL) AS sensor, arg_min(src_ip, (occurred_at, content_hash)) AS src_ip, max(protocol) AS protocol, max(client_version) FILTER (eventid = 'cowrie.client.version') AS client_version, max(hassh) FILTER (eventid = 'cowrie.client.kex') AS hassh,
  min(occurred_at) AS started_at, max(occurred_at) FILTER (eventid = 'cowrie.session.closed') AS ended_at, max(duration_seconds) FILTER (eventid = 'cowrie.session.closed') AS duration_seconds, coalesce(bool_or(eventid = 'cowrie.session.closed'), false) AS is_closed,
  count(*) FILTER (eventid IN ('cowrie.login.failed', 'cowrie.login.success')) AS login_attempts, coalesce(bool_or(eventid = 'cowrie.login.success'), false) AS login_succeeded, count(DISTINCT username) AS distinct_usernames, count(DISTINCT password) AS distinct_passwords, count(*) FILTER (eventid = 'cowrie.command.input') AS commands_run,
  arg_min(command_input, (occurred_at, content_hash)) FILTER (eventid = 'cowrie.command.input' AND command_input IS NOT NULL) AS first_command, count(*) FILTER (eventid = 'cowrie.session.file_download') AS downloads, count(*) AS event_count FROM ev GROUP BY session_id),
ven AS (SELECT vendor, count(*) AS exploited_cves, count(*) FILTER (is_ransomware_linked) AS ransomware_linked_cves, round(100.0::DOUBLE * count(*) FILTER (is_ransomware_linked) / count(*), 1) AS ransomware_share_pct, count(DISTINCT product) AS products_affected, min(date_added)::VARCHAR AS first_added, max(date_added)::VARCHAR AS most_recently_added, count(*) FILTER (due_date >= DATE '{AS_OF}') AS open_deadlines FROM kev GROUP BY vendor),
tag AS (SELECT lower(t) AS tag, count(*) AS urls, count(*) FILTER (is_online) AS online_urls, count(DISTINCT host) AS distinct_hosts, round(count(*)::DOUBLE / nullif(count(DISTINCT host), 0), 1) AS urls_per_host FROM (SELECT host, is_online, unnest(tags) AS t FROM url WHERE len(tags) > 0) GROUP BY 1),
c2 AS (SELECT f.ip_address, f.malware, f.is_online, f.port, f.as_name, f.as_number, f.country, f.hostname, epoch_us(f.first_seen) AS first_seen, f.last_online::VARCHAR AS last_online, t.ip_address IS NOT NULL AS was_ever_tor_exit, coalesce(t.is_current_exit, false) AS is_current_tor_exit,
  CASE WHEN regexp_matches(lower(coalesce(f.as_name, '')), '{m.CLOUDS}') THEN 'commercial_cloud' ELSE 'other' END AS hosting_type FROM feo f LEFT JOIN tor t ON t.ip_address = f.ip_address)"""
_obs = "epoch_us(first_observed_at) AS first_observed_at, epoch_us(last_observed_at) AS last_observed_at, times_observed, event_id AS source_event_id"
_fix = "event_id, epoch_us(ingested_at) AS ingested_at, content_hash, _kafka_offset"
_cow = "eventid, session_id, sensor, src_ip, src_port, dst_port, protocol, username, password, command_input, download_url, download_sha256, client_version, hassh, duration_seconds"
_redact = lambda c: f"regexp_replace({c}, '(^|[^0-9.])((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\\.){{3}}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])($|[^0-9.])', '\\1[ip]\\5', 'g')"
_cte = lambda select: f"WITH {_CTES} {select}"
_login = lambda c: _cte(f"SELECT {_redact('v')} AS value, attempts FROM (SELECT {c} AS v, count(*) AS attempts FROM ev WHERE eventid IN ('cowrie.login.failed', 'cowrie.login.success') AND {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)")

SQL = {
    "stg_cisa_kev": _cte(f"SELECT {_fix}, epoch_us(occurred_at) AS occurred_at, cve_id, vendor, product, vulnerability_name, description, required_action, date_added::VARCHAR AS date_added, due_date::VARCHAR AS due_date, ransomware_use_raw, is_ransomware_linked, array_to_string(cwes, ',') AS cwes, catalog_version FROM kev0"),
    "stg_urlhaus": _cte(f"SELECT {_fix}, epoch_us(listed_at) AS listed_at, urlhaus_id, url, host, url_status, threat, array_to_string(tags, ',') AS tags, reporter, urlhaus_link FROM url0"),
    "stg_feodo": _cte(f"SELECT {_fix}, collector_host, ip_address, port, status, hostname, as_number, as_name, country, malware, epoch_us(first_seen) AS first_seen, last_online::VARCHAR AS last_online FROM feo0"),
    "stg_tor_exit": _cte(f"SELECT {_fix}, ip_address FROM tor0"),
    "stg_cowrie": _cte(f"SELECT {_fix}, epoch_us(occurred_at) AS occurred_at, collector_host, {_cow} FROM cow0"),
    "silver_kev_vulnerabilities": _cte(f"SELECT cve_id, vendor, product, vulnerability_name, description, required_action, date_added::VARCHAR AS date_added, due_date::VARCHAR AS due_date, is_ransomware_linked, array_to_string(cwes, ',') AS cwes, catalog_version, {_obs} FROM kev"),
    "silver_urlhaus_urls": _cte(f"SELECT url, host, urlhaus_id, url_status, is_online, threat, array_to_string(coalesce(tags, []), ',') AS tags, reporter, epoch_us(listed_at) AS listed_at, urlhaus_link, {_obs} FROM url"),
    "silver_feodo_c2_servers": _cte(f"SELECT ip_address, port, status, is_online, hostname, as_number, as_name, country, malware, epoch_us(first_seen) AS first_seen, last_online::VARCHAR AS last_online, {_obs} FROM feo"),
    "silver_tor_exit_nodes": _cte("SELECT ip_address, epoch_us(first_observed_at) AS first_observed_at, epoch_us(last_observed_at) AS last_observed_at, snapshots_seen_in, is_current_exit FROM tor"),
    "silver_honeypot_events": _cte(f"SELECT content_hash, event_id AS source_event_id, epoch_us(ingested_at) AS first_ingested_at, epoch_us(occurred_at) AS occurred_at, {_cow} FROM ev"),
    "silver_honeypot_sessions": _cte("SELECT * REPLACE (epoch_us(started_at) AS started_at, epoch_us(ended_at) AS ended_at) FROM ses"),
    "gold_vendor_exploitation": _cte("SELECT * FROM ven"),
    "gold_malware_url_tags": _cte("SELECT * FROM tag"),
    "gold_c2_infrastructure": _cte("SELECT * FROM c2"),
    "explore_sources": "SELECT source, count(*) AS events, min(occurred_at)::DATE::VARCHAR AS oldest_event, max(occurred_at)::DATE::VARCHAR AS newest_event, round(avg((epoch_us(ingested_at) - epoch_us(occurred_at)) / 86400e6), 4) AS avg_lag_days FROM bronze_events GROUP BY source",
    "explore_vendors": _cte("SELECT vendor, count(*) AS exploited_cves, sum(CASE WHEN ransomware_use_raw = 'Known' THEN 1 ELSE 0 END)::BIGINT AS used_by_ransomware FROM kev0 GROUP BY vendor ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10"),
    "explore_years": _cte("SELECT year(date_added)::INTEGER AS year_added, count(*) AS cves_added, sum(CASE WHEN ransomware_use_raw = 'Known' THEN 1 ELSE 0 END)::BIGINT AS ransomware_linked FROM kev0 GROUP BY 1 ORDER BY 1 DESC NULLS LAST LIMIT 8"),
    "explore_tags": _cte("SELECT tag, count(*) AS malicious_urls FROM (SELECT unnest(tags) AS tag FROM url0 WHERE len(tags) > 0) GROUP BY tag ORDER BY 2 DESC, 1 LIMIT 12"),
    "explore_c2_tor": _cte("SELECT c.malware, c.ip, t.ip IS NOT NULL AS is_tor_exit FROM (SELECT DISTINCT ip_address AS ip, malware FROM feo0) c LEFT JOIN (SELECT DISTINCT ip_address AS ip FROM tor0) t ON t.ip = c.ip"),
    "export_counts": _cte("""SELECT (SELECT count(*) FROM kev) AS exploited_cves, (SELECT count(*) FILTER (is_ransomware_linked) FROM kev) AS ransomware_linked_cves, (SELECT count(DISTINCT vendor) FROM kev) AS vendors, (SELECT count(*) FROM url) AS malware_urls, (SELECT count(*) FILTER (is_online) FROM url) AS online_malware_urls,
(SELECT count(DISTINCT host) FROM url) AS malware_hosts, (SELECT count(*) FROM feo) AS c2_servers, (SELECT count(*) FILTER (is_current_exit) FROM tor) AS tor_exit_nodes, NULL::BIGINT AS url_campaigns, NULL::BIGINT AS clustered_servers, (SELECT count(*) FROM ses) AS honeypot_sessions"""),
    "export_vendors": _cte("SELECT vendor, exploited_cves, ransomware_linked_cves, ransomware_share_pct, products_affected, most_recently_added FROM ven ORDER BY exploited_cves DESC, vendor NULLS LAST LIMIT 25"),
    "export_tags": _cte("SELECT tag, urls, online_urls, distinct_hosts, urls_per_host FROM tag ORDER BY urls DESC, tag LIMIT 25"),
    "export_c2": _cte("SELECT ip_address, malware, is_online, port, as_name, country, hosting_type, was_ever_tor_exit, is_current_tor_exit, first_seen, last_online FROM c2"),
    "export_overview": _cte("SELECT count(*) AS sessions, epoch_us(min(started_at)) AS first_session, epoch_us(max(started_at)) AS last_session, count(*) FILTER (login_succeeded) AS logged_in, count(*) FILTER (commands_run > 0) AS ran_commands, count(*) FILTER (downloads > 0) AS downloaded, count(DISTINCT src_ip) AS distinct_sources FROM ses"),
    "export_daily": _cte("SELECT started_at::DATE::VARCHAR AS day, count(*) AS sessions FROM ses GROUP BY 1 ORDER BY 1 DESC LIMIT 30"),
    "export_protocols": _cte("SELECT coalesce(protocol, 'unknown') AS protocol, count(*) AS sessions FROM ses GROUP BY 1"),
    "export_usernames": _login("username"),
    "export_passwords": _login("password"),
    "export_commands": _cte(f"SELECT {_redact('v')} AS value, sessions FROM (SELECT first_command AS v, count(*) AS sessions FROM ses WHERE first_command IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"),
}
