"""One query per relational operator, each beside the SQL that must give its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.text import hmac_sha256, redact_ipv4, words
from tidewatch.functions.urls import ipv4_24, url_host, url_last_segment, url_port
from tidewatch.ml.search import STOP_WORDS
from tidewatch.operators.ranking import numbered, quantiles as exact_quantiles
from tidewatch.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEY = b"not a secret: fixed for comparing the engines"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(s, d):
    return table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# --- projections, JSON, filters -------------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, epoch_us(date_trunc('minute', ts)) AS minute_us, ts::DATE::VARCHAR AS day, event_type AS kind FROM events")
def json_unpack(s, d):
    return _events(s, d).select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.unix_micros(F.date_trunc("minute", "ts")).alias("minute_us"), F.col("ts").cast("date").cast("string").alias("day"), F.col("event_type").alias("kind"))


@query("SELECT k % 10 AS k_mod, count(*) AS n, sum(k)::BIGINT AS total FROM (SELECT json_extract_string(props, '$.k')::INTEGER AS k FROM events) GROUP BY 1")
def json_one_parse(s, d):
    return _events(s, d).select(F.from_json("props", "k int")["k"].alias("k")).groupBy((F.col("k") % 10).alias("k_mod")).agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'small' END AS size_class, o_orderstatus = 'F' AS is_final FROM orders WHERE o_orderstatus IN ('F', 'P') AND NOT (o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '5-%')")
def case_like_in(s, d):
    o = table(s, d, "orders").where(F.col("o_orderstatus").isin("F", "P") & ~(F.col("o_orderpriority").startswith("1-") | F.col("o_orderpriority").startswith("5-")))
    return o.select("o_orderkey", F.when(F.col("o_totalprice") >= 300000, "large").when(F.col("o_totalprice") >= 100000, "middle").otherwise("small").alias("size_class"), (F.col("o_orderstatus") == "F").alias("is_final"))


@query("SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey BETWEEN 5 AND 9")
def bound_parameters(s, d):
    """Values are bound, never pasted into the statement."""
    return s.sql("SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM {c} WHERE c_mktsegment = :segment AND c_nationkey BETWEEN :low AND :high", args={"segment": "BUILDING", "low": 5, "high": 9}, c=table(s, d, "customer"))


# --- windows and deduplication --------------------------------------------------------------


@query("SELECT user_id, event_id, event_type, epoch_us(first_ts) AS first_us, epoch_us(last_ts) AS last_us, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, min(ts) OVER (PARTITION BY user_id) AS first_ts, max(ts) OVER (PARTITION BY user_id) AS last_ts, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE rn = 1")
def latest_per_key(s, d):
    last = F.max(F.struct("ts", "event_id", "event_type"))
    return _events(s, d).groupBy("user_id").agg(last.alias("l"), F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).select("user_id", "l.event_id", "l.event_type", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us"), "n")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_per_key(s, d):
    w = Window.partitionBy("user_id", "event_type").orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))
    return _events(s, d).withColumn("rn", F.row_number().over(w)).where("rn = 1").select("user_id", "event_type", "event_id")


@query("SELECT min(event_id) AS event_id, sha256(concat_ws('|', user_id, event_type, props)) AS content_hash FROM (SELECT * FROM events UNION ALL SELECT * FROM events) GROUP BY 2")
def dedup_content_hash(s, d):
    e = _events(s, d)
    again = e.unionByName(e)  # every row sent twice
    return again.select("event_id", F.sha2(F.concat_ws("|", "user_id", "event_type", "props"), 256).alias("content_hash")).groupBy("content_hash").agg(F.min("event_id").alias("event_id"))


@query("SELECT event_id, row_number() OVER (ORDER BY value DESC, ts, event_id) AS value_rank FROM events")
def rank_global(s, d):
    """Every row's place in one order of all rows."""
    return numbered(_events(s, d).select("event_id", "value", "ts"), [F.desc_nulls_last("value"), F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")], "value_rank").select("event_id", "value_rank")


@query("SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN row_number() OVER (PARTITION BY user_id, event_type = 'purchase' ORDER BY value DESC, event_id) END AS purchase_rank FROM events")
def rank_subset(s, d):
    buys = F.col("event_type") == "purchase"
    return _events(s, d).withColumn("b", buys).withColumn("r", F.row_number().over(Window.partitionBy("user_id", "b").orderBy(F.desc("value"), "event_id"))).select("user_id", "event_id", F.when(F.col("b"), F.col("r")).alias("purchase_rank"))


@query("SELECT user_id, n, row_number() OVER (ORDER BY n DESC, user_id) AS new_id FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)")
def renumber_groups(s, d):
    g = _events(s, d).groupBy("user_id").agg(F.count("*").alias("n"))  # a row per group
    return g.withColumn("new_id", F.row_number().over(Window.orderBy(F.desc("n"), "user_id")))


# --- aggregation ----------------------------------------------------------------------------


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks, count(DISTINCT event_type) AS kinds, coalesce(bool_or(event_type = 'error'), false) AS had_error, max(value) FILTER (event_type = 'purchase') AS top_purchase, arg_min(event_type, (ts, event_id)) AS first_kind, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS spent FROM events GROUP BY user_id""")
def user_behaviour(s, d):
    k = F.col("event_type")
    return _events(s, d).groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(k == "click").alias("clicks"), F.countDistinct(k).alias("kinds"), F.coalesce(F.bool_or(k == "error"), F.lit(False)).alias("had_error"), F.max(F.when(k == "purchase", F.col("value"))).alias("top_purchase"), F.min(F.struct("ts", "event_id", "event_type"))["event_type"].alias("first_kind"), F.round(F.sum(F.when(k == "purchase", F.col("value")).otherwise(0)), 4).alias("spent"))


@query("""SELECT c_mktsegment, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS final_orders, round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*), 1) AS final_share_pct, count(DISTINCT c_custkey) AS customers, min(o_orderdate)::DATE::VARCHAR AS first_day, max(o_orderdate)::DATE::VARCHAR AS last_day, count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01') AS open_orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def order_share_by_segment(s, d):
    done = F.count_if(F.col("o_orderstatus") == "F")
    j = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), done.alias("final_orders"), F.round(F.lit(100.0) * done.cast("double") / F.count("*"), 1).alias("final_share_pct"), F.countDistinct("c_custkey").alias("customers"), F.min("o_orderdate").cast("date").cast("string").alias("first_day"), F.max("o_orderdate").cast("date").cast("string").alias("last_day"), F.count_if(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).alias("open_orders"))


@query("SELECT user_id, max(date_trunc('minute', ts)) = (SELECT max(date_trunc('minute', ts)) FROM events) AS is_current, count(DISTINCT date_trunc('minute', ts)) AS minutes_seen FROM events GROUP BY user_id")
def snapshot_membership(s, d):
    e = _events(s, d).withColumn("m", F.date_trunc("minute", "ts"))
    return e.groupBy("user_id").agg(F.max("m").alias("last"), F.countDistinct("m").alias("minutes_seen")).crossJoin(F.broadcast(e.agg(F.max("m").alias("top")))).select("user_id", (F.col("last") == F.col("top")).alias("is_current"), "minutes_seen")


@query("SELECT user_id, event_type, n, place FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY user_id, event_type) WHERE place <= 3")
def mode_k_per_group(s, d):
    n = _events(s, d).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))).where("place <= 3")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.99), 6) AS q99, round(stddev_pop(value), 6) AS std FROM events GROUP BY event_type")
def quantiles(s, d):
    e = _events(s, d).select("event_type", "value")
    std = e.groupBy("event_type").agg(F.round(F.stddev_pop("value"), 6).alias("std"))
    q = exact_quantiles(e, ["event_type"], "value", (0.5, 0.25, 0.75, 0.99))
    return q.join(std, "event_type").select("event_type", *(F.round(F.col("values")[i], 6).alias(n) for i, n in enumerate(("median", "q25", "q75", "q99"))), "std")


@query("""SELECT e.event_id, round((e.value - q.m) / CASE WHEN q.b > q.a THEN q.b - q.a WHEN q.s > 0 THEN q.s ELSE 1 END, 6) AS z FROM events e JOIN (SELECT event_type, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, stddev_pop(value) AS s FROM events GROUP BY 1) q USING (event_type)""")
def robust_z(s, d):
    e = _events(s, d).select("event_id", "event_type", "value")
    q = exact_quantiles(e, ["event_type"], "value", (0.5, 0.25, 0.75)).join(e.groupBy("event_type").agg(F.stddev_pop("value").alias("s")), "event_type")  # a row per type
    spread = F.col("values")[2] - F.col("values")[1]
    return e.join(q, "event_type").select("event_id", F.round((F.col("value") - F.col("values")[0]) / F.when(spread > 0, spread).when(F.col("s") > 0, F.col("s")).otherwise(1.0), 6).alias("z"))


@query("SELECT event_id, round(ln(1 + greatest(value, 0)), 6) AS log_value, round(-ln(count(*) OVER (PARTITION BY event_type)::DOUBLE / count(*) OVER ()), 6) AS rarity, (event_type = 'error')::INTEGER AS is_error FROM events")
def feature_transform(s, d):
    e = _events(s, d)
    share = e.groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(e.agg(F.count("*").alias("all"))))
    return e.join(share, "event_type").select("event_id", F.round(F.log1p(F.greatest("value", F.lit(0.0))), 6).alias("log_value"), F.round(-F.log(F.col("n").cast("double") / F.col("all")), 6).alias("rarity"), (F.col("event_type") == "error").cast("int").alias("is_error"))


@query("SELECT ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def daily_counts(s, d):
    return _events(s, d).groupBy(F.date_trunc("day", "ts").cast("date").cast("string").alias("day")).agg(F.count("*").alias("n")).orderBy(F.desc("day")).limit(30)


@query("SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(*) FILTER (event_type = 'error') AS errors, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, round(sum(value), 4) AS total, round(avg(value), 6) AS mean FROM events")
def counts_row(s, d):
    return _events(s, d).agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("event_type") == "error").alias("errors"), F.unix_micros(F.min("ts")).alias("first_us"), F.unix_micros(F.max("ts")).alias("last_us"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS lines, round(avg((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400e6), 6) AS avg_lag_days FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def avg_lag_days(s, d):
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    j = table(s, d, "lineitem").select("l_orderkey", "l_shipdate").join(table(s, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("lines"), F.round(F.avg((us("l_shipdate") - us("o_orderdate")) / F.lit(86_400e6)), 6).alias("avg_lag_days"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def select_distinct(s, d):
    return _events(s, d).select("user_id", "event_type").distinct()


# --- joins and set operations ---------------------------------------------------------------


@query("SELECT s_suppkey, c.k IS NOT NULL AS has_customers, coalesce(c.n, 0) AS customers, CASE WHEN regexp_matches(lower(coalesce(s_name, '')), '00[1-5]') THEN 'early' ELSE 'other' END AS kind FROM supplier LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY 1) c ON c.k = s_nationkey")
def left_join_flags(s, d):
    c = table(s, d, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    return table(s, d, "supplier").join(c, F.col("s_nationkey") == F.col("k"), "left").select("s_suppkey", F.col("k").isNotNull().alias("has_customers"), F.coalesce("n", F.lit(0)).alias("customers"), F.when(F.lower(F.coalesce("s_name", F.lit(""))).rlike("00[1-5]"), "early").otherwise("other").alias("kind"))


@query("SELECT c_custkey, 'without' AS kind FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT c_custkey, 'with' FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_semi_keys(s, d):
    c, o = table(s, d, "customer").select("c_custkey"), table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_anti").withColumn("kind", F.lit("without")).unionByName(c.join(o, "c_custkey", "left_semi").withColumn("kind", F.lit("with")))


@query("SELECT n_name AS place, NULL::VARCHAR AS region, n_nationkey AS k FROM nation UNION ALL SELECT NULL, r_name, r_regionkey FROM region")
def union_by_name(s, d):
    n = table(s, d, "nation").select(F.col("n_name").alias("place"), F.col("n_nationkey").alias("k"))
    return n.unionByName(table(s, d, "region").select(F.col("r_name").alias("region"), F.col("r_regionkey").alias("k")), allowMissingColumns=True)


@query("SELECT (SELECT sum(n)::BIGINT FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)) AS grouped_total, (SELECT count(*) FROM orders) AS plain_total")
def reconcile_totals(s, d):
    o = table(s, d, "orders")
    grouped = o.groupBy("o_custkey").agg(F.count("*").alias("n")).agg(F.sum("n").alias("grouped_total"))
    return grouped.crossJoin(o.agg(F.count("*").alias("plain_total")))  # one row each


@query("SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey) AS matched")
def scalar_subqueries(s, d):
    return s.sql("SELECT (SELECT count(*) FROM {o}) AS orders, (SELECT count(*) FROM {c}) AS customers, (SELECT count(DISTINCT o_custkey) FROM {o} JOIN {c} ON c_custkey = o_custkey) AS matched", o=table(s, d, "orders"), c=table(s, d, "customer"))


@query("SELECT coalesce(a.k, b.k) AS c_custkey, CASE WHEN a.k IS NULL THEN 'removed' WHEN b.k IS NULL THEN 'new' ELSE 'changed' END AS kind FROM (SELECT c_custkey AS k, md5(c_name) AS h FROM customer WHERE c_custkey % 7 <> 0) a FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'stale' ELSE md5(c_name) END AS h FROM customer WHERE c_custkey % 11 <> 0) b ON a.k = b.k WHERE a.h IS DISTINCT FROM b.h")
def key_set_difference(s, d):
    """What an incremental refresh has to do: keys that are new, removed or changed by hash."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.md5("c_name").alias("h"))
    now, before = c.where("k % 7 <> 0"), c.where("k % 11 <> 0").select("k", F.when(F.col("k") % 5 == 0, "stale").otherwise(F.col("h")).alias("old"))
    j = now.join(before, "k", "full")
    return j.where(~F.col("h").eqNullSafe(F.col("old"))).select(F.col("k").alias("c_custkey"), F.when(F.col("h").isNull(), "removed").when(F.col("old").isNull(), "new").otherwise("changed").alias("kind"))


@query("SELECT p_partkey, p_name, p_size FROM part ORDER BY p_retailprice DESC, p_size DESC, p_partkey LIMIT 25")
def topk_limits(s, d):
    return table(s, d, "part").orderBy(F.desc("p_retailprice"), F.desc("p_size"), "p_partkey").limit(25).select("p_partkey", "p_name", "p_size")


# --- text, URLs, hashes ---------------------------------------------------------------------


@query("SELECT w AS word, count(DISTINCT doc_id) AS docs, count(*) AS occurrences, round(count(*)::DOUBLE / count(DISTINCT doc_id), 1) AS per_doc FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM documents) GROUP BY w")
def token_counts(s, d):
    w = table(s, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    per = w.groupBy("word", "doc_id").agg(F.count("*").alias("n"))  # one shuffle of partial counts, then of words
    return per.groupBy("word").agg(F.count("*").alias("docs"), F.sum("n").alias("occurrences")).withColumn("per_doc", F.round(F.col("occurrences").cast("double") / F.col("docs"), 1))


_URL = r"regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)"


@query(f"""SELECT DISTINCT url, lower(regexp_replace({_URL}, ':[0-9]*$', '')) AS host, coalesce(try_cast(nullif(regexp_extract({_URL}, ':([0-9]+)$', 1), '') AS INTEGER), CASE lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) WHEN 'https' THEN 443 WHEN 'http' THEN 80 END) AS port,
coalesce(nullif(regexp_extract(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), ''), '(root)') AS last_segment, CASE WHEN regexp_full_match(lower(regexp_replace({_URL}, ':[0-9]*$', '')), '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+') THEN regexp_extract({_URL}, '^([0-9]+\\.[0-9]+\\.[0-9]+)', 1) END AS net FROM urlhaus_urls""")
def url_parts(s, d):
    u = F.col("url")
    return table(s, d, "urlhaus_urls").select("url").distinct().select("url", url_host(u).alias("host"), url_port(u).alias("port"), url_last_segment(u).alias("last_segment"), ipv4_24(url_host(u)).alias("net"))


@query(f"""SELECT lower(regexp_replace({_URL}, ':[0-9]*$', '')) AS host, count(*) AS urls, count(*) FILTER (url_status = 'online') AS online_urls, array_to_string(list_sort(list(DISTINCT coalesce(nullif(regexp_extract(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), ''), '(root)'))), ' ') AS paths FROM urlhaus_urls GROUP BY 1""")
def host_profiles(s, d):
    u = F.col("url")
    return table(s, d, "urlhaus_urls").groupBy(url_host(u).alias("host")).agg(F.count("*").alias("urls"), F.count_if(F.col("url_status") == "online").alias("online_urls"), F.array_join(F.array_sort(F.collect_set(url_last_segment(u))), " ").alias("paths"))


_OCTETS = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP_ONCE = f"'(^|[^0-9.])({_OCTETS}\\.){{3}}{_OCTETS}($|[^0-9.])', '\\1[ip]\\5', 'g')"


# twice, as two addresses may share the character between them, which this engine's patterns must take along
@query(f"SELECT doc_id, sha256(r) AS redacted_hash, len(regexp_extract_all(text, '\\[ip\\]'))::INTEGER AS before, len(regexp_extract_all(r, '\\[ip\\]'))::INTEGER AS after FROM (SELECT doc_id, text, regexp_replace(regexp_replace(text, {_IP_ONCE}, {_IP_ONCE} AS r FROM documents)")
def ip_redact(s, d):
    """Addresses in the documents' texts as ``[ip]``."""
    held = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"\[ip\]"), F.lit(0)))
    return table(s, d, "documents").select("doc_id", F.sha2(redact_ipv4(F.col("text")), 256).alias("redacted_hash"), held(F.col("text")).alias("before"), held(redact_ipv4(F.col("text"))).alias("after"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal <> 0")
def not_equal_filter(s, d):
    return table(s, d, "customer").where((F.col("c_mktsegment") != "BUILDING") & (F.col("c_acctbal") != 0)).select("c_custkey", "c_nationkey")


@query("SELECT o_orderkey, o_orderstatus = 'F' AS is_final FROM orders ORDER BY o_orderstatus = 'F' DESC, o_totalprice DESC, o_orderkey LIMIT 30")
def flag_first_order(s, d):
    final = F.col("o_orderstatus") == "F"
    return table(s, d, "orders").orderBy(final.desc(), F.desc("o_totalprice"), "o_orderkey").limit(30).select("o_orderkey", final.alias("is_final"))


@query("WITH t AS (SELECT l_orderkey AS k, list(DISTINCT l_suppkey) AS s FROM lineitem GROUP BY 1) SELECT a.k AS order_a, b.k AS order_b, len(list_intersect(a.s, b.s))::INTEGER AS shared FROM t a JOIN t b ON b.k = a.k + 1 WHERE len(list_intersect(a.s, b.s)) > 0")
def set_overlap(s, d):
    """How many suppliers an order shares with the next one."""
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set("l_suppkey").alias("s"))
    j = t.select(F.col("k").alias("order_a"), "s").join(t.select((F.col("k") - 1).alias("order_a"), F.col("k").alias("order_b"), F.col("s").alias("s2")), "order_a")
    return j.select("order_a", "order_b", F.size(F.array_intersect("s", "s2")).alias("shared")).where("shared > 0")


def _pad(x: int) -> str:
    return "".join(f"\\x{b ^ x:02x}" for b in KEY.ljust(64, b"\0"))


@query(f"SELECT DISTINCT user_id, 'anon-' || substr(sha256('{_pad(0x5C)}'::BLOB || unhex(sha256('{_pad(0x36)}'::BLOB || user_id::VARCHAR::BLOB))), 1, 16) AS pseudonym FROM events")
def hmac_pseudonym(s, d):
    u = _events(s, d).select("user_id").distinct()
    return u.select("user_id", F.concat(F.lit("anon-"), F.substring(hmac_sha256(F.col("user_id").cast("string"), KEY), 1, 16)).alias("pseudonym"))


@query("""SELECT source, CASE WHEN source = 'cowrie' THEN coalesce(nullif(json_extract_string(payload, '$.session'), ''), event_id) ELSE coalesce(nullif(json_extract_string(payload, '$.url'), ''), nullif(json_extract_string(payload, '$.ip_address'), ''), nullif(json_extract_string(payload, '$.cve_id'), ''), nullif(json_extract_string(payload, '$.session_id'), ''), nullif(json_extract_string(payload, '$.src_ip'), ''), event_id) END AS entity, count(*) AS rows_of_entity FROM bronze_events GROUP BY 1, 2""")
def partition_keys(s, d):
    from tidewatch.streaming.topics import entity_key

    return table(s, d, "bronze_events").groupBy("source", entity_key().alias("entity")).agg(F.count("*").alias("rows_of_entity"))


@query()
def partition_balance(s, d):
    """Rows per partition of three, by the entity key's hash."""
    from tidewatch.streaming.topics import entity_key, partition_of

    return table(s, d, "bronze_events").groupBy("source", partition_of(entity_key(), 3).alias("partition")).agg(F.count("*").alias("n"))


# --- quality --------------------------------------------------------------------------------


@query("""SELECT 'not_null:o_custkey' AS check_name, count(*) FILTER (o_custkey IS NULL) AS failing FROM orders UNION ALL SELECT 'unique:o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'accepted_values:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders UNION ALL SELECT 'unique:event_id', (SELECT count(*) FROM (SELECT event_id FROM bronze_events GROUP BY 1 HAVING count(*) > 1))""")
def quality_report(s, d):
    from tidewatch.quality import accepted_values, not_null, report, unique

    o, b = table(s, d, "orders"), table(s, d, "bronze_events")
    return report({"not_null:o_custkey": not_null(o, "o_custkey"), "unique:o_orderkey": unique(o, "o_orderkey"), "accepted_values:o_orderstatus": accepted_values(o, "o_orderstatus", ["O", "F"]), "unique:event_id": unique(b, "event_id")})


# --- vectors, search, scoring ---------------------------------------------------------------


@query("""WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0), c AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e, q)
SELECT query_id, vec_id, score FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""")
def vector_topk(s, d):
    """The ten nearest of every hundredth vector, itself among them."""
    from tidewatch.ml.search import nearest

    e = table(s, d, "embeddings")
    return nearest(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 10, digits=6, own=True).select("query_id", F.col("hit_id").alias("vec_id"), "score")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_GRAMS = "list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))"
_KEYWORD = f"""docs AS (SELECT doc_id, {_GRAMS} AS w FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda t: t NOT IN ({_STOP})) AS w FROM documents WHERE text IS NOT NULL)), n AS (SELECT count(*) AS n FROM docs),
tf AS (SELECT doc_id, t, count(*) AS c FROM (SELECT doc_id, unnest(w) AS t FROM docs) GROUP BY 1, 2), df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
wt AS (SELECT tf.doc_id, tf.t, (1 + ln(c)) * (ln((1 + n)::DOUBLE / (1 + df)) + 1) AS x FROM tf JOIN df USING (t), n), nrm AS (SELECT doc_id, sqrt(sum(x * x)) AS l FROM wt GROUP BY 1),
q AS (SELECT t, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS x FROM df, n WHERE t IN ('ransomware', 'gateway', 'login', 'ransomware gateway', 'gateway login')), ql AS (SELECT sqrt(sum(x * x)) AS l FROM q),
score AS (SELECT doc_id, round(sum(wt.x * q.x) / (any_value(nrm.l) * any_value(ql.l)), 6) AS score FROM wt JOIN q USING (t) JOIN nrm USING (doc_id), ql GROUP BY doc_id)"""


@query(f"WITH {_KEYWORD} SELECT doc_id, score FROM score ORDER BY score DESC, doc_id LIMIT 20")
def keyword_search(s, d):
    from tidewatch.ml.search import keyword_scores

    return keyword_scores(table(s, d, "documents"), "doc_id", "text", "the ransomware gateway login").orderBy(F.desc("score"), "doc_id").limit(20)


@query(f"""WITH {_KEYWORD}, a AS (SELECT doc_id AS id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM score QUALIFY r <= 50), b AS (SELECT doc_id AS id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS r FROM documents QUALIFY r <= 50)
SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS fused FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id""")
def rrf_fusion(s, d):
    from tidewatch.ml.search import fuse, keyword_scores, ranked

    docs = table(s, d, "documents")
    a = ranked(keyword_scores(docs, "doc_id", "text", "the ransomware gateway login"), "doc_id", "score", 50)
    b = ranked(docs.select("doc_id", F.col("n_chars").alias("score")), "doc_id", "score", 50)
    return fuse([a, b], "doc_id").select(F.col("doc_id").alias("id"), F.round("fused", 9).alias("fused"))


def _precision_at_5(e, queries):
    from tidewatch.ml.search import nearest

    hits = nearest(queries, e, "vec_id", "embedding", 5).join(e.select(F.col("vec_id").alias("hit_id"), F.col("label").alias("hl")), "hit_id").join(e.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql")), "query_id")
    return hits.groupBy("query_id").agg(F.round(F.avg((F.col("hl") == F.col("ql")).cast("int")), 6).alias("precision_at_5"))


@query("""WITH q AS (SELECT vec_id, embedding, label FROM embeddings WHERE vec_id % 100 = 0), c AS (SELECT q.vec_id AS q, q.label AS ql, e.label AS el, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) DESC, e.vec_id) AS r FROM embeddings e JOIN q ON e.vec_id <> q.vec_id)
SELECT q AS query_id, round(avg((ql = el)::INTEGER), 6) AS precision_at_5 FROM c WHERE r <= 5 GROUP BY q""")
def precision_at_k(s, d):
    """Of every hundredth vector as a query, the share of its five nearest that carry its label."""
    e = table(s, d, "embeddings")
    return _precision_at_5(e, e.where("vec_id % 100 = 0"))


_LABELLED = "l AS (SELECT doc_id, n_chars::DOUBLE AS score, (source = 'kev_note')::INTEGER AS y FROM documents WHERE source IS NOT NULL)"


@query(f"""WITH {_LABELLED}, g AS (SELECT score, sum(y) AS p, count(*) AS c FROM l GROUP BY score), r AS (SELECT score, p, c, sum(p) OVER (ORDER BY score DESC) AS tp, sum(c) OVER (ORDER BY score DESC) AS n, sum(p) OVER () AS np, sum(c) OVER () AS total FROM g)
SELECT round(sum((p / np) * (tp / n))::DOUBLE, 6) AS average_precision, round((sum((c - p) * (tp - p) + (c - p) * p / 2.0) / (any_value(np) * (any_value(total) - any_value(np))))::DOUBLE, 6) AS roc_auc, any_value(np)::BIGINT AS positives FROM r""")
def ranking_metrics(s, d):
    from tidewatch.ml.metrics import ranking_quality

    docs = table(s, d, "documents").where("source is not null").select(F.col("n_chars").cast("double").alias("score"), (F.col("source") == "kev_note").cast("int").alias("y"))
    return ranking_quality(docs, "score", "y")


@query("SELECT CASE WHEN date_added < DATE '2023-01-01' THEN 'train' ELSE 'test' END AS side, count(*) AS n, count(*) FILTER (ransomware_use_raw = 'Known') AS positives FROM kev_snapshots WHERE date_added IS NOT NULL GROUP BY 1")
def temporal_split(s, d):
    from tidewatch.ml.metrics import split_by_date

    k = split_by_date(table(s, d, "kev_snapshots"), "date_added", "2023-01-01")
    return k.groupBy("side").agg(F.count("*").alias("n"), F.count_if(F.col("ransomware_use_raw") == "Known").alias("positives"))


@query("SELECT label, fold, count(*) AS n FROM (SELECT label, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % 5 AS fold FROM embeddings) GROUP BY 1, 2")
def stratified_folds(s, d):
    from tidewatch.ml.metrics import folds

    return folds(table(s, d, "embeddings"), "label", [F.col("vec_id")], 5).groupBy("label", F.col("fold").cast("long").alias("fold")).agg(F.count("*").alias("n"))


@query("WITH g AS (SELECT label AS c, vec_id % 5 AS net, count(*) AS n FROM embeddings GROUP BY 1, 2), w AS (SELECT sum(n * (n - 1) / 2)::BIGINT AS same FROM g), t AS (SELECT sum(n * (n - 1) / 2)::BIGINT AS pairs FROM (SELECT c, sum(n) AS n FROM g GROUP BY 1)) SELECT same AS same_net_pairs, pairs AS within_pairs, round(same / pairs, 6) AS within_rate FROM w, t")
def pair_coherence(s, d):
    """How many pairs of a cluster share a network, from counts; no pair is made."""
    g = table(s, d, "embeddings").groupBy(F.col("label").alias("c"), (F.col("vec_id") % 5).alias("net")).agg(F.count("*").alias("n"))
    two = lambda n: F.sum(F.expr(f"{n} * ({n} - 1) div 2"))
    return g.agg(two("n").alias("same_net_pairs")).crossJoin(g.groupBy("c").agg(F.sum("n").alias("m")).agg(two("m").alias("within_pairs"))).withColumn("within_rate", F.round(F.col("same_net_pairs") / F.col("within_pairs"), 6))


# --- streams as extensions ------------------------------------------------------------------


@query("SELECT epoch_us(time_bucket(INTERVAL 1 hour, ts)) AS window_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(s, d):
    return _events(s, d).groupBy(F.window("ts", "1 hour")["start"].alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_micros("w").alias("window_us"), "event_type", "n", "total")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 minute THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM k GROUP BY user_id, sid""")
def session_windows(s, d):
    return _events(s, d).groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.unix_micros("w.start").alias("start_us"), "n")
