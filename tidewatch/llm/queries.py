"""The queries of this package (p4, p8 to p10) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import clusters, garbled, mixing, tokens
from tidewatch.sources.tables import table
from tidewatch.storage import settle


def _celled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    hosts, profiles = clusters.profiles(clusters.server_features(table(spark, d, "urlhaus_urls")))
    return clusters.cells(profiles), hosts


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.pairs(settle(clusters.linked(*_celled(spark, d)), "linked"))


def p4_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The k-means clusters: size and most typical members."""
    return clusters.described(*_celled(spark, d))


def p4_typical(spark: SparkSession, d: str) -> DataFrame:
    """The clusters of ``p4_found``: size and most typical members."""
    celled, hosts = _celled(spark, d)
    return clusters.typical_members(settle(clusters.linked(celled, hosts), "linked"), celled, hosts)


def p4_members(spark: SparkSession, d: str) -> DataFrame:
    """Each server of a cluster of ``p4_found`` with the cluster's name (its first server) and size."""
    clustered = settle(clusters.linked(*_celled(spark, d)), "linked")
    named = clustered.groupBy("cluster").agg(F.min("host").alias("name"))
    return clustered.join(named, "cluster").select("host", F.col("name").alias("cluster"), "size")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, decoded from their ids."""
    return tokens.decode(p8_ids(spark, d), "doc_id")


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return mixing.sized_documents(table(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets")).select("mix_name", "source", "doc_id", "tokens", "times")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sized, targets = _sized(spark, d), table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix(sized, targets), mixing.budgets(sized, targets))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled.found(table(spark, d, "documents"), "doc_id", "text")


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return garbled.restored(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p4_found, p4_members, p4_clusters, p4_typical, p8_ids, p8_round_trip, p9_mix, p9_shares, p10_found, p10_restored)}
_AT = r"regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)"
_P4 = rf"""WITH RECURSIVE u AS (SELECT *, coalesce(nullif(lower(regexp_replace({_AT}, ':[0-9]*$', '')), ''), lower(trim(host))) AS h,
  coalesce(nullif(regexp_extract(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), ''), '(root)') AS segment,
  coalesce(nullif(regexp_extract({_AT}, ':([0-9]+)$', 1), ''), CASE lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) WHEN 'https' THEN '443' WHEN 'http' THEN '80' END) AS port FROM urlhaus_urls WHERE url IS NOT NULL),
f AS (SELECT DISTINCT h, x FROM (SELECT h, 'path=' || segment AS x FROM u UNION ALL SELECT h, 'port=' || port FROM u UNION ALL SELECT h, 'tag=' || t FROM (SELECT h, lower(regexp_replace(unnest(tags), '^\s+|\s+$', '', 'g')) AS t FROM u) WHERE t <> '') WHERE h IS NOT NULL AND x IS NOT NULL),
p AS (SELECT DISTINCT min(h) OVER (PARTITION BY s) AS p, h, s FROM (SELECT h, list_sort(list(x)) AS s FROM f GROUP BY h)),
k AS (SELECT p.p, len(any_value(s)) AS n, unnest(any_value(s)) AS x FROM p GROUP BY p),
link AS MATERIALIZED (SELECT a.p AS a, b.p AS b FROM k a JOIN k b USING (x) GROUP BY a.p, b.p HAVING count(*) * 3 >= any_value(a.n) + any_value(b.n)),
r AS (SELECT a, b FROM link UNION SELECT r.a, link.b FROM r JOIN link ON link.a = r.b),
c AS (SELECT a AS p, min(b) AS cluster FROM r GROUP BY a),
m AS (SELECT p.h AS host, min(p.h) OVER w AS cluster, count(*) OVER w AS size FROM c JOIN p USING (p) WINDOW w AS (PARTITION BY c.cluster) QUALIFY size >= 5)"""
SQL = {
    "p4_found": f"{_P4} SELECT x.host AS host_a, y.host AS host_b FROM m x JOIN m y ON x.cluster = y.cluster AND x.host < y.host",
    "p4_members": f"{_P4} SELECT host, cluster, size FROM m",
    "p8_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
