"""The general training-data queries (p1 to p3, p5 to p7) and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.keys import plain_cve, plain_ip, plain_uuid, text_or_empty
from tidewatch.operators import asof, dedup, drift, history, lateness, snapshots
from tidewatch.operators.runs import complete_runs
from tidewatch.sources.tables import table
from tidewatch.storage import settle, shared_dir


# --- 1: schemas that drift between files ----------------------------------------------------


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "landed_lines"))


def p1_table(spark: SparkSession, d: str) -> DataFrame:
    """Every readable line in one consistent table, a row per line and field."""
    return drift.consistent(table(spark, d, "landed_lines"))


def p1_alternatives(spark: SparkSession, d: str) -> DataFrame:
    """The types each path has had, nested ones too, and the file in which each appeared."""
    return drift.alternatives(table(spark, d, "landed_lines")).select("source", "path", "tag", "n_values", "first_file")


# --- 2: what changed between full snapshots -------------------------------------------------


def snapshot_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``(source, key, seq, sig)`` of the three feeds' complete lists, and the runs."""
    runs = complete_runs(table(spark, d, "collector_runs"))
    of = lambda source: runs.where(F.col("source") == source).select("source", "collector_run_id", "seq")
    cwes = F.array_join(F.array_sort(F.filter(F.transform(F.coalesce(F.col("cwes"), F.array().cast("array<string>")), text_or_empty), lambda x: x != "")), "\x1f")
    kev_sig = snapshots.signature(*(text_or_empty(F.col(c)) for c in ("vendor", "product", "vulnerability_name", "required_action", "ransomware_use_raw")), F.col("date_added"), F.col("due_date"), cwes)
    feodo_sig = snapshots.signature(*(text_or_empty(F.col(c)) for c in ("status", "hostname", "as_name", "country", "malware")), F.col("port"), F.col("as_number"))
    tor = table(spark, d, "tor_exit_snapshots").select("collector_run_id", plain_ip(F.col("ip_address")).alias("key")).where("key is not null").join(of("tor_exit"), "collector_run_id").groupBy("source", "key", "seq").agg(F.lit(0).cast("long").alias("sig"))
    parts = [tor]
    for source, name, key, sig in (("cisa_kev", "kev_snapshots", plain_cve(F.col("cve_id")), kev_sig), ("feodo", "feodo_snapshots", plain_ip(F.col("ip_address")), feodo_sig)):
        rows = table(spark, d, name).select("collector_run_id", key.alias("key"), sig.alias("sig"), F.coalesce("_kafka_offset", F.lit(-1)).alias("off")).where("key is not null")
        parts.append(rows.join(of(source), "collector_run_id").groupBy("source", "key", "seq").agg(F.max(F.struct("off", "sig"))["sig"].alias("sig")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]), runs


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The keys of each feed's first lists are numbered by one run, those of all later lists by the next, which finds the ordinals kept."""
    records, runs = snapshot_records(spark, d)
    records = settle(records, "p2-records")
    kept = snapshots.Ordinals(spark, f"{shared_dir(spark)}/p2-ordinals-{uuid.uuid4().hex}")
    kept.extend(records.where("seq = 0").select("source", "key"))
    changes = snapshots.snapshot_changes(records, runs.select("source", "seq"), kept.extend(records.select("source", "key")))
    return changes.join(runs.select("source", "seq", "snapshot_no"), ["source", "seq"]).select("source", "snapshot_no", F.col("key").alias("record_key"), "change_kind")


# --- 3: messages delivered more than once ---------------------------------------------------


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.repeated(table(spark, d, "bronze_events"), plain_uuid(F.col("event_id")), "event_id").select("event_id")


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bronze_events")
    order = [F.asc_nulls_last(c) for c in ("ingested_at", "_kafka_partition", "_kafka_offset", "_bronze_written_at", "event_id", "payload")]
    kept = dedup.exactly_once(b, plain_uuid(F.col("event_id")), order)
    return kept.select(plain_uuid(F.col("event_id")).alias("event_id"), "source", "event_type", F.unix_micros("ingested_at").alias("ingested_us"), "_kafka_partition", "_kafka_offset", "content_hash")


# --- 5: attributes as known at event time ---------------------------------------------------


def session_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "honeypot_sessions").select("session_id", plain_ip(F.col("src_ip")).alias("ip"), F.unix_micros("started_at").alias("at")).where("session_id is not null and ip is not null and at is not null").distinct()


def tor_known_intervals(spark: SparkSession, d: str) -> DataFrame:
    """``(ip, valid_from, valid_to)`` in microseconds: when an address was known to be on the list that counted."""
    lists = asof.known_lists(complete_runs(table(spark, d, "collector_runs")).where("source = 'tor_exit'"))
    n = lists.count()  # a row per delivery
    units = table(spark, d, "tor_exit_snapshots").select("collector_run_id", plain_ip(F.col("ip_address")).alias("ip")).where("ip is not null").join(lists.select("collector_run_id", "eff"), "collector_run_id").select("ip", "eff", F.lit(1).alias("on_list"))
    spans = history.coalesce_runs(units, ["ip"], "eff", "on_list", n)
    begin, end = lists.select(F.col("eff").alias("start"), F.col("known_from").alias("valid_from")), lists.select((F.col("eff") + 1).alias("end"), F.col("known_to").alias("valid_to"))
    return spans.join(begin, "start").join(end, "end").select("ip", "valid_from", "valid_to")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return asof.valid_at(session_events(spark, d), tor_known_intervals(spark, d), "ip", "at").select("session_id").distinct()


def p5_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Each session address and start with what was known then."""
    events = session_events(spark, d)
    hit = asof.valid_at(events, tor_known_intervals(spark, d), "ip", "at").select("session_id", "ip", "at", F.col("valid_from").alias("known_since_us"))
    return events.join(hit, ["session_id", "ip", "at"], "left").select("session_id", F.col("ip").alias("src_ip"), F.col("at").alias("started_us"), F.col("known_since_us").isNotNull().alias("was_known_tor_exit"), "known_since_us")


# --- 6: history of changing attributes ------------------------------------------------------


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    runs = complete_runs(table(spark, d, "collector_runs"))
    secs = F.floor(F.unix_micros("collected_at") / F.lit(1_000_000)).cast("long")
    tor_runs = runs.where("source = 'tor_exit'").select("collector_run_id", "seq", secs.alias("t"))
    feodo_runs = runs.where("source = 'feodo'").select("collector_run_id", secs.alias("t"))
    n = tor_runs.count()  # a row per delivery
    seen = table(spark, d, "tor_exit_snapshots").select("collector_run_id", plain_ip(F.col("ip_address")).alias("ip")).where("ip is not null").join(tor_runs, "collector_run_id")
    spans = settle(history.coalesce_runs(seen.select("ip", "seq", F.lit(1).alias("flag")), ["ip"], "seq", "flag", n), "p6-spans")
    times = tor_runs.select("seq", "t")
    # a span opens a version with 1; where it doesn't reach the last list, the next list opens one with 0
    opened = spans.select("ip", F.lit(1).alias("flag"), F.col("start").alias("seq")).unionByName(spans.where(F.col("end") < n).select("ip", F.lit(0).alias("flag"), F.col("end").alias("seq")))
    tor = opened.join(times, "seq").select(F.lit("tor_exit").alias("entity_kind"), "ip", "flag", "t")
    # the first time each address was on a Tor list, and on a C2 list
    first_tor = spans.groupBy("ip").agg(F.min("start").alias("seq")).join(times, "seq").select("ip", F.col("t").alias("tor_t"))
    first_c2 = table(spark, d, "feodo_snapshots").select("collector_run_id", plain_ip(F.col("ip_address")).alias("ip")).where("ip is not null").join(feodo_runs, "collector_run_id").groupBy("ip").agg(F.min("t").alias("c2_t"))
    # every delivery of either feed from an address's first C2 list on is an observation of it, a unit interval; the tree makes versions of them
    stamps = tor_runs.select("t").unionByName(feodo_runs.select("t")).distinct().withColumn("seq", F.row_number().over(_by_time()) - 1)  # at most one per delivery
    m = stamps.count()
    units = first_c2.join(first_tor, "ip", "left").join(F.broadcast(stamps), F.col("t") >= F.col("c2_t")).select("ip", "seq", F.coalesce((F.col("tor_t") <= F.col("t")).cast("int"), F.lit(0)).alias("flag"))
    c2_spans = history.coalesce_runs(units, ["ip"], "seq", "flag", m)
    c2 = c2_spans.join(stamps, c2_spans["start"] == stamps["seq"]).select(F.lit("c2").alias("entity_kind"), "ip", "flag", "t")
    version = _versions()
    return tor.unionByName(c2).select("entity_kind", F.col("ip").alias("ip_address"), "flag", F.col("t").alias("valid_from"), F.coalesce(F.lead("t").over(version), F.lit(-1)).cast("long").alias("valid_to"))


def _by_time():
    from pyspark.sql import Window

    return Window.orderBy("t")


def _versions():
    from pyspark.sql import Window

    return Window.partitionBy("entity_kind", "ip").orderBy("t")


# --- 7: late and out-of-order events --------------------------------------------------------


def honeypot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Served from the lambda views: the last midnight's batch, and the fast layer for what arrived since."""
    b, p = table(spark, d, "bronze_events").where("source = 'cowrie'"), lateness.Periods()
    events = lateness.first_arrivals(b, plain_uuid(F.col("event_id")), "collector_host", "occurred_at", "ingested_at")
    last = b.agg(F.max(F.unix_micros("ingested_at"))).first()[0] or 0
    return lateness.reconciled(lateness.build_views(events, p, last - last % 86_400_000_000), p)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return lateness.late_kinds(honeypot_counts(spark, d)).select(F.col("grp").alias("collector_host"), F.col("period_start").alias("hour_start"), "late_kind")


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    return honeypot_counts(spark, d).select(F.col("grp").alias("collector_host"), F.col("period_start").alias("hour_start"), "provisional", "final", "late", "cut_off")


QUERIES = {f.__name__: f for f in (p1_found, p1_table, p1_alternatives, p2_found, p3_found, p3_kept, p5_found, p5_sessions, p6_found, p7_found, p7_counts)}

# Pieces of the SQL, in DuckDB's dialect.
_IP = "CASE WHEN regexp_full_match(regexp_replace(lower(regexp_replace({c}, '\\s+', '', 'g')), '^::ffff:', ''), '[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}') THEN regexp_replace(lower(regexp_replace({c}, '\\s+', '', 'g')), '^::ffff:', '') END"
_UUID = "regexp_replace(lower(regexp_replace(event_id, '[\\s{}\\-]+', '', 'g')), '^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$', '\\1-\\2-\\3-\\4-\\5')"
_RUNS = """runs AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY collected_at, snapshot_no, collector_run_id) - 1 AS seq FROM (
  SELECT source, collector_run_id, min(snapshot_no) AS snapshot_no, min(collected_at) AS collected_at, min(ingested_at) AS ingested_at
  FROM collector_runs WHERE run_status = 'success' GROUP BY source, collector_run_id))"""
_T = "coalesce(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
_txt = lambda *cs: ", ".join(_T.format(c=c) + f" AS {c}" for c in cs)

_P2 = f"""WITH {_RUNS},
kev AS (SELECT r.source, r.seq, upper(regexp_replace(cve_id, '\\s+', '', 'g')) AS k, _kafka_offset AS o,
  md5(concat_ws('|', {", ".join(_T.format(c=c) for c in ("vendor", "product", "vulnerability_name", "required_action", "ransomware_use_raw"))}, coalesce(date_added::varchar, '-'), coalesce(due_date::varchar, '-'), array_to_string(list_sort(coalesce(cwes, [])), ','))) AS sig
  FROM kev_snapshots k JOIN runs r ON r.collector_run_id = k.collector_run_id AND r.source = 'cisa_kev'),
feo AS (SELECT r.source, r.seq, {_IP.format(c="ip_address")} AS k, _kafka_offset AS o,
  md5(concat_ws('|', {", ".join(_T.format(c=c) for c in ("status", "hostname", "as_name", "country", "malware"))}, coalesce(port::varchar, '-'), coalesce(as_number::varchar, '-'))) AS sig
  FROM feodo_snapshots f JOIN runs r ON r.collector_run_id = f.collector_run_id AND r.source = 'feodo'),
tor AS (SELECT r.source, r.seq, {_IP.format(c="ip_address")} AS k, 0 AS o, '' AS sig FROM tor_exit_snapshots t JOIN runs r ON r.collector_run_id = t.collector_run_id AND r.source = 'tor_exit'),
one AS (SELECT source, seq, k, max_by(sig, o) AS sig FROM (SELECT * FROM kev UNION ALL SELECT * FROM feo UNION ALL SELECT * FROM tor) WHERE k IS NOT NULL AND k <> '' GROUP BY source, seq, k)
SELECT r.source, r.snapshot_no, coalesce(n.k, o.k) AS record_key, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM (SELECT * FROM one WHERE seq > 0) n FULL JOIN (SELECT source, seq + 1 AS seq, k, sig FROM one) o ON n.source = o.source AND n.seq = o.seq AND n.k = o.k
JOIN runs r ON r.source = coalesce(n.source, o.source) AND r.seq = coalesce(n.seq, o.seq)
WHERE o.k IS NULL OR n.k IS NULL OR o.sig <> n.sig"""

_P5 = f"""WITH {_RUNS},
s AS (SELECT DISTINCT session_id, {_IP.format(c="src_ip")} AS ip, started_at FROM honeypot_sessions),
l AS (SELECT s.session_id, s.ip, s.started_at, max_by(r.collector_run_id, r.collected_at) AS run FROM s JOIN runs r ON r.source = 'tor_exit' AND r.ingested_at <= s.started_at WHERE s.ip IS NOT NULL GROUP BY ALL),
t AS (SELECT DISTINCT collector_run_id AS run, {_IP.format(c="ip_address")} AS ip FROM tor_exit_snapshots)
SELECT DISTINCT l.session_id FROM l JOIN t ON t.run = l.run AND t.ip = l.ip"""

_P6 = f"""WITH {_RUNS},
tor AS (SELECT DISTINCT {_IP.format(c="ip_address")} AS ip, r.seq FROM tor_exit_snapshots t JOIN runs r ON r.collector_run_id = t.collector_run_id AND r.source = 'tor_exit'),
one AS (SELECT *, lag(seq) OVER w AS before, lead(seq) OVER w AS after FROM tor WHERE ip IS NOT NULL WINDOW w AS (PARTITION BY ip ORDER BY seq)),
ends AS (SELECT 'tor_exit' AS k, ip, 1 AS flag, seq FROM one WHERE before IS NULL OR before < seq - 1 UNION ALL SELECT 'tor_exit', ip, 0, seq + 1 FROM one WHERE after IS NULL OR after > seq + 1),
te AS (SELECT k, ip, flag, epoch_us(r.collected_at) // 1000000 AS t FROM ends JOIN runs r ON r.source = 'tor_exit' AND r.seq = ends.seq),
ft AS (SELECT ip, min(t) AS t FROM te GROUP BY ip),
fc AS (SELECT {_IP.format(c="ip_address")} AS ip, min(epoch_us(r.collected_at) // 1000000) AS t FROM feodo_snapshots f JOIN runs r ON r.collector_run_id = f.collector_run_id AND r.source = 'feodo' GROUP BY 1),
c2 AS (SELECT 'c2' AS k, fc.ip, 0 AS flag, fc.t FROM fc LEFT JOIN ft ON ft.ip = fc.ip WHERE fc.ip IS NOT NULL AND (ft.t IS NULL OR ft.t > fc.t) UNION ALL SELECT 'c2', fc.ip, 1, greatest(fc.t, ft.t) FROM fc JOIN ft ON ft.ip = fc.ip),
v AS (SELECT * FROM te UNION ALL SELECT * FROM c2)
SELECT k AS entity_kind, ip AS ip_address, flag, t AS valid_from, coalesce(lead(t) OVER (PARTITION BY k, ip ORDER BY t), -1) AS valid_to FROM v"""

_P7 = f"""e AS (SELECT {_UUID} AS id, min(epoch_us(ingested_at)) AS a, arg_min(epoch_us(occurred_at), ingested_at) AS t, arg_min(collector_host, ingested_at) AS h FROM bronze_events WHERE source = 'cowrie' GROUP BY 1),
c AS (SELECT h, (t // 3600000000) * 3600 AS hour_start, a - (t // 3600000000 + 1) * 3600000000 AS late FROM e)"""

_TAG = "CASE json_type({j}) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END"
_LINES = """ok AS (SELECT source, collector_host AS host, file_id, line_no, collected_at, p, row_number() OVER () AS rid FROM (SELECT *, CASE WHEN json_valid(payload) THEN payload END::JSON AS p FROM landed_lines) WHERE json_type(p) = 'OBJECT')"""
_REC = f"""coalesce('u:' || nullif(regexp_replace(p ->> '$.urlhaus_id', '\\s+', '', 'g'), ''), 'i:' || {_IP.format(c="(p ->> '$.ip_address')")}, 'c:' || nullif(upper(regexp_replace(p ->> '$.cve_id', '\\s+', '', 'g')), ''), 's:' || nullif(regexp_replace(p ->> '$.session', '\\s+', '', 'g'), ''))"""
_DRIFT = f"""files AS (SELECT file_id, any_value(source) AS source, any_value(host) AS host, min(collected_at) AS began, count(*) AS n FROM ok GROUP BY 1),
steps AS (SELECT *, row_number() OVER w AS seq, lag(file_id) OVER w AS prev FROM files WINDOW w AS (PARTITION BY source, host ORDER BY began NULLS LAST, file_id)),
v AS (SELECT file_id, rec, f, j, {_TAG.format(j="j")} AS tag FROM (SELECT file_id, rec, f, json_extract(p, '$."' || f || '"') AS j FROM (SELECT file_id, p, {_REC} AS rec, unnest(json_keys(p)) AS f FROM ok))),
own AS (SELECT file_id, f, sum(c) AS c, arg_max(tag, (c, tag)) FILTER (tag IS NOT NULL) AS tag FROM (SELECT file_id, f, tag, count(*) AS c FROM v GROUP BY ALL) GROUP BY 1, 2),
has AS (SELECT s.file_id, s.prev, s.source, s.host, s.seq, f, last_value(tag IGNORE NULLS) OVER (PARTITION BY s.source, s.host, f ORDER BY seq ROWS UNBOUNDED PRECEDING) AS tag FROM own JOIN steps s USING (file_id) WHERE c * 2 > n),
d AS (SELECT coalesce(n.file_id, o.file_id) AS file_id, coalesce(n.prev, o.prev) AS prev, coalesce(n.f, o.f) AS f, n.f IS NOT NULL AS is_new, o.f IS NOT NULL AS is_old, n.tag AS nt, o.tag AS ot
  FROM (SELECT * FROM has WHERE prev IS NOT NULL) n FULL JOIN (SELECT s.file_id, s.prev, h.f, h.tag FROM steps s JOIN has h ON h.file_id = s.prev) o ON n.file_id = o.file_id AND n.f = o.f),
x AS (SELECT DISTINCT d.file_id, d.f, is_new, rec, v.tag || ':' || CASE WHEN v.tag = 'number' THEN j::DOUBLE::VARCHAR ELSE j::VARCHAR END AS val FROM d JOIN v ON v.file_id = CASE WHEN is_new THEN d.file_id ELSE prev END AND v.f = d.f WHERE is_new <> is_old AND rec IS NOT NULL AND v.tag IS NOT NULL),
e AS (SELECT o.file_id, o.f AS a, n.f AS b, count(DISTINCT o.rec) AS eq FROM x o JOIN x n ON n.is_new AND NOT o.is_new AND n.file_id = o.file_id AND n.rec = o.rec AND n.val = o.val GROUP BY ALL),
sh AS (SELECT o.file_id, o.f AS a, n.f AS b, count(DISTINCT o.rec) AS n FROM x o JOIN x n ON n.is_new AND NOT o.is_new AND n.file_id = o.file_id AND n.rec = o.rec GROUP BY ALL),
ren AS (SELECT file_id, a, b FROM e JOIN sh USING (file_id, a, b) WHERE eq * 2 > n QUALIFY row_number() OVER (PARTITION BY file_id, a ORDER BY eq / n DESC, eq DESC, b) = 1 AND row_number() OVER (PARTITION BY file_id, b ORDER BY eq / n DESC, eq DESC, a) = 1),
report AS (SELECT file_id, 'renamed' AS change_kind, a AS old_field, b AS new_field FROM ren
  UNION ALL SELECT file_id, 'retyped', f, f FROM d WHERE is_new AND is_old AND nt <> ot
  UNION ALL SELECT file_id, 'removed', f, '' FROM d WHERE NOT is_new AND NOT EXISTS (SELECT 1 FROM ren r WHERE r.file_id = d.file_id AND r.a = d.f)
  UNION ALL SELECT file_id, 'added', '', f FROM d WHERE NOT is_old AND NOT EXISTS (SELECT 1 FROM ren r WHERE r.file_id = d.file_id AND r.b = d.f))"""

SQL = {
    "p1_alternatives": f"""WITH RECURSIVE {_LINES},
t AS (SELECT source, file_id, collected_at, unnest(list_transform(json_keys(p), lambda k: {{'path': k, 'j': json_extract(p, '$."' || k || '"')}})) AS x FROM ok
UNION ALL SELECT source, file_id, collected_at, unnest(CASE json_type(x.j) WHEN 'OBJECT' THEN list_transform(json_keys(x.j), lambda k: {{'path': x.path || '.' || k, 'j': json_extract(x.j, '$."' || k || '"')}}) WHEN 'ARRAY' THEN list_transform(json_extract(x.j, '$[*]'), lambda e: {{'path': x.path || '[]', 'j': e}}) ELSE [] END) FROM t)
SELECT source, x.path AS path, {_TAG.format(j="x.j")} AS tag, count(*) AS n_values, arg_min(file_id, (epoch_us(collected_at), file_id)) AS first_file FROM t WHERE json_type(x.j) <> 'NULL' GROUP BY 1, 2, 3""",
    "p1_found": f"""WITH {_LINES}, {_DRIFT} SELECT file_id, change_kind, old_field, new_field FROM report""",
    "p1_table": f"""WITH RECURSIVE {_LINES}, {_DRIFT},
und AS (SELECT DISTINCT source, host, a, b FROM (SELECT f.source, f.host, a, b FROM ren JOIN files f USING (file_id) UNION ALL SELECT f.source, f.host, b, a FROM ren JOIN files f USING (file_id))),
reach AS (SELECT source, host, a, b FROM und UNION SELECT r.source, r.host, r.a, u.b FROM reach r JOIN und u ON u.source = r.source AND u.host = r.host AND u.a = r.b),
names AS (SELECT source, host, a AS original, least(a, min(b)) AS name FROM reach GROUP BY source, host, a),
cells AS (SELECT c.*, coalesce(n.name, c.original) AS field FROM (SELECT file_id, line_no, source, host, original, json_extract(p, '$."' || original || '"') AS j FROM (SELECT *, unnest(json_keys(p)) AS original FROM ok)) c LEFT JOIN names n ON n.source = c.source AND n.host = c.host AND n.original = c.original),
typed AS (SELECT *, {_TAG.format(j="j")} AS tag, CASE WHEN json_type(j) <> 'NULL' THEN j ->> '$' END AS txt,
  CASE json_type(j) WHEN 'OBJECT' THEN '{{' || array_to_string(list_transform(list_sort(json_keys(j)), lambda k: '"' || k || '":' || json_extract(j, '$."' || k || '"')::VARCHAR), ',') || '}}' ELSE j::VARCHAR END AS whole FROM cells),
mains AS (SELECT source, field, arg_max(tag, (c, tag)) AS main FROM (SELECT source, field, tag, count(*) AS c FROM typed WHERE tag IS NOT NULL GROUP BY ALL) GROUP BY ALL),
n AS (SELECT t.*, main, CASE WHEN tag IN ('number', 'string') THEN try_cast(txt AS DOUBLE) END AS num FROM typed t LEFT JOIN mains m ON m.source = t.source AND m.field = t.field)
SELECT file_id, line_no, source, host AS collector_host, field, original, tag, CASE WHEN tag = 'string' THEN txt END AS as_string, CASE WHEN tag = 'number' THEN num END AS as_number, CASE WHEN tag = 'boolean' THEN txt::BOOLEAN END AS as_boolean, CASE WHEN tag IN ('array', 'object') THEN whole END AS as_json,
CASE WHEN tag IS NULL THEN NULL WHEN main = 'number' THEN CASE WHEN num = floor(num) AND abs(num) < 1e15 THEN num::BIGINT::VARCHAR ELSE num::VARCHAR END WHEN main = 'boolean' THEN try_cast(lower(txt) AS BOOLEAN)::VARCHAR
  WHEN main IN ('array', 'object') THEN CASE WHEN tag = main THEN whole WHEN main = 'array' THEN '[' || whole || ']' END ELSE CASE WHEN tag IN ('array', 'object') THEN whole ELSE txt END END AS canonical FROM n""",
    "p2_found": _P2,
    "p3_found": f"SELECT event_id FROM (SELECT {_UUID} AS event_id FROM bronze_events) GROUP BY event_id HAVING count(*) > 1",
    "p3_kept": f"""SELECT {_UUID} AS event_id, source, event_type, epoch_us(ingested_at) AS ingested_us, _kafka_partition, _kafka_offset, content_hash FROM bronze_events
QUALIFY row_number() OVER (PARTITION BY {_UUID} ORDER BY ingested_at, _kafka_partition NULLS LAST, _kafka_offset NULLS LAST, _bronze_written_at NULLS LAST, event_id, payload) = 1""",
    "p5_found": _P5,
    "p5_sessions": f"""WITH {_RUNS},
s AS (SELECT DISTINCT session_id, {_IP.format(c="src_ip")} AS ip, started_at FROM honeypot_sessions WHERE {_IP.format(c="src_ip")} IS NOT NULL),
x AS (SELECT collector_run_id, collected_at, ingested_at, max(collected_at) OVER (ORDER BY ingested_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM runs WHERE source = 'tor_exit'),
l AS (SELECT collector_run_id, row_number() OVER (ORDER BY ingested_at) AS eff, epoch_us(ingested_at) AS f, epoch_us(lead(ingested_at) OVER (ORDER BY ingested_at)) AS t FROM x WHERE top IS NULL OR collected_at > top),
u AS (SELECT DISTINCT {_IP.format(c="ip_address")} AS ip, eff FROM tor_exit_snapshots JOIN l USING (collector_run_id)),
g AS (SELECT ip, min(eff) AS a, max(eff) AS b FROM (SELECT ip, eff, eff - row_number() OVER (PARTITION BY ip ORDER BY eff) AS isl FROM u WHERE ip IS NOT NULL) GROUP BY ip, isl),
i AS (SELECT g.ip, l1.f, l2.t FROM g JOIN l l1 ON l1.eff = g.a JOIN l l2 ON l2.eff = g.b)
SELECT session_id, s.ip AS src_ip, epoch_us(started_at) AS started_us, i.f IS NOT NULL AS was_known_tor_exit, i.f AS known_since_us FROM s LEFT JOIN i ON i.ip = s.ip AND i.f <= epoch_us(started_at) AND (i.t IS NULL OR epoch_us(started_at) < i.t)""",
    "p6_found": _P6,
    "p7_found": f"WITH {_P7} SELECT DISTINCT h AS collector_host, hour_start, CASE WHEN late < 259200000000 THEN 'corrected' ELSE 'cut_off' END AS late_kind FROM c WHERE late >= 900000000",
    "p7_counts": f"WITH {_P7} SELECT h AS collector_host, hour_start, count(*) FILTER (late < 900000000) AS provisional, count(*) FILTER (late < 259200000000) AS final, count(*) FILTER (late >= 900000000 AND late < 259200000000) AS late, count(*) FILTER (late >= 259200000000) AS cut_off FROM c GROUP BY h, hour_start",
}
