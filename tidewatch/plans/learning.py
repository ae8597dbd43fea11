"""Clustering, scoring and anomaly queries over the domain's tables; SQL can't express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import export
from tidewatch.ml import dbscan, marts, search
from tidewatch.models import layers
from tidewatch.sources.tables import table
from tidewatch.storage import settle


def _labelled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = settle(marts.host_profiles(table(spark, d, "urlhaus_urls")), "host-profiles")
    return p, dbscan.dbscan(p.select("host", "tokens"))


def dbscan_hosts(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d)[1]


def campaign_summaries(spark: SparkSession, d: str) -> DataFrame:
    return dbscan.summaries(*_labelled(spark, d)).withColumns({"top_tags": F.array_join("top_tags", ","), "top_paths": F.array_join("top_paths", ",")})


def campaign_coherence(spark: SparkSession, d: str) -> DataFrame:
    """Coherence and coverage of the campaigns, one row."""
    p, labels = _labelled(spark, d)
    labels = settle(labels, "labels")
    return dbscan.coherence(labels.join(p.select("host", "net"), "host"), "host", "net").crossJoin(marts.coverage(labels))


def _kev(spark: SparkSession, d: str) -> DataFrame:
    return layers.kev_vulnerabilities(layers.stg_cisa_kev(table(spark, d, "bronze_events")))


def logit_scores(spark: SparkSession, d: str) -> DataFrame:
    """Each vulnerability with its probability of ransomware use, by a model of the earlier ones; ranked where it is late and unlinked."""
    scored, _ = marts.ransomware(_kev(spark, d))
    return scored.select("cve_id", F.col("ransomware_probability").alias("probability"), "on_watchlist", "watchlist_rank")


def semantic_ask(spark: SparkSession, d: str) -> DataFrame:
    """The ten vulnerabilities nearest to a question, through the index of their texts."""
    kev = settle(marts.document(_kev(spark, d)).select("cve_id", "text"), "kev-texts")
    e = search.HashedWords()
    index, _ = search.refresh(kev, None, "cve_id", "text", e)
    return search.ask(settle(index, "index"), kev, "cve_id", "text", e, "remote code execution in a gateway appliance").select("cve_id", "score")


def iforest_scores(spark: SparkSession, d: str) -> DataFrame:
    s = layers.honeypot_sessions(layers.honeypot_events(layers.stg_cowrie(table(spark, d, "bronze_events"))))
    found = marts.anomalies(s)
    if found is None:
        return spark.createDataFrame([], "session_id string, anomaly_rank long, score double, is_flagged boolean, reasons string")
    return found.select("session_id", "anomaly_rank", F.round("score", 6).alias("score"), "is_flagged", "reasons")


def export_campaigns(spark: SparkSession, d: str) -> DataFrame:
    models = marts.campaigns(layers.urlhaus_urls(layers.stg_urlhaus(table(spark, d, "bronze_events"))))
    return export.report(models.get, "campaigns").withColumns({"top_tags": F.array_join("top_tags", ","), "top_paths": F.array_join("top_paths", ",")})


def export_watchlist(spark: SparkSession, d: str) -> DataFrame:
    scored, _ = marts.ransomware(_kev(spark, d))
    return export.report({"ml.kev_ransomware_scores": scored}.get, "watchlist")


QUERIES = {f.__name__: f for f in (dbscan_hosts, campaign_summaries, campaign_coherence, logit_scores, semantic_ask, iforest_scores, export_campaigns, export_watchlist)}
