"""The tables of the ML layer, as functions from silver tables to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import joined_text
from tidewatch.functions.urls import ipv4_24, url_host, url_last_segment, url_port
from tidewatch.ml import dbscan, logit, search, sessions
from tidewatch.operators.ranking import quantiles
from tidewatch.storage import settle


def host_profiles(urls: DataFrame, status: Column | None = None) -> DataFrame:
    """``(host, paths, tags, ports, urls, online_urls, tokens, net)`` per server; ``status``: whether a URL is online."""
    u, blank = F.col("url"), F.array().cast("array<string>")
    per = urls.where(u.isNotNull()).groupBy(url_host(u).alias("host")).agg(
        F.collect_set(url_last_segment(u)).alias("paths"), F.array_distinct(F.flatten(F.collect_list(F.coalesce("tags", blank)))).alias("tags"), F.collect_set(url_port(u)).alias("ports"),
        F.count("*").alias("urls"), F.count_if(F.col("url_status") == "online" if status is None else status).alias("online_urls"),
    )
    named = lambda c, p: F.transform(c, lambda x: F.concat(F.lit(p), F.regexp_replace(x.cast("string"), " ", "_")))
    return per.where("host is not null").withColumns({"tokens": F.array_sort(F.concat(named("paths", "path="), named("tags", "tag="), named("ports", "port="))), "net": ipv4_24(F.col("host"))})


def campaigns(urls: DataFrame) -> dict[str, DataFrame]:
    """``ml.url_campaigns``, ``ml.url_campaign_servers`` and the one row of ``ml.url_campaign_metrics``; they belong together."""
    p = settle(host_profiles(urls), "host-profiles")
    labels = settle(dbscan.dbscan(p.select("host", "tokens")), "campaign-labels")
    members = labels.where("cluster <> -1")
    servers = members.join(p, "host").select(F.col("cluster").alias("campaign_id"), "host", "urls", "online_urls", "net")
    metrics = dbscan.coherence(labels.join(p.select("host", "net"), "host"), "host", "net").crossJoin(coverage(labels))
    return {"ml.url_campaigns": dbscan.summaries(p, labels).withColumnRenamed("cluster", "campaign_id"), "ml.url_campaign_servers": servers, "ml.url_campaign_metrics": metrics}


def coverage(labels: DataFrame) -> DataFrame:
    """One row ``(servers, clustered, coverage)``: the share of servers that belong to a campaign; 0 for no servers."""
    n, c = F.count(F.lit(1)), F.count_if(F.col("cluster") != -1)
    return labels.agg(n.alias("servers"), c.alias("clustered"), F.when(n > 0, c / n).otherwise(F.lit(0.0)).alias("coverage"))


def document(kev: DataFrame) -> DataFrame:
    """``kev`` with ``text``, what search and scoring read of a vulnerability."""
    return kev.withColumn("text", joined_text(F.col("vendor"), F.col("product"), F.col("vulnerability_name"), F.col("description"), F.array_join("cwes", " ")))


def ransomware(kev: DataFrame, cutoff: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``ml.kev_ransomware_scores`` and the one row of its metrics. The cutoff is by default the date that three quarters of the vulnerabilities precede."""
    k = settle(document(kev).where("date_added is not null").withColumn("y", F.coalesce("is_ransomware_linked", F.lit(False)).cast("int")), "kev")
    if cutoff is None:
        epoch = F.lit("1970-01-01").cast("date")
        at = quantiles(k.select(F.datediff("date_added", epoch).alias("v")), [], "v", (0.75,)).first()
        cutoff = str(k.sparkSession.range(1).select(F.date_add(epoch, int(at["values"][0]) if at else 0)).first()[0])
    quality, model = logit.evaluate_temporal(k, "text", "y", "date_added", cutoff)
    scored = logit.watch_list(model.score(k), "y", "date_added", cutoff, "cve_id")
    keep = ("cve_id", "vendor", "product", "vulnerability_name", "date_added", F.round("probability", 4).alias("ransomware_probability"), "on_watchlist", "watchlist_rank")
    return scored.select(*keep), quality.withColumn("cutoff", F.lit(cutoff))


def embeddings(kev: DataFrame, index: DataFrame | None, embedder: search.Embedder) -> tuple[DataFrame, dict[str, int]]:
    """``ml.cve_embeddings`` brought up to date, and what had to be done."""
    return search.refresh(document(kev).select("cve_id", "text"), index, "cve_id", "text", embedder)


def anomalies(silver_sessions: DataFrame) -> DataFrame | None:
    """``ml.honeypot_session_anomalies``; None while there are too few closed sessions."""
    return sessions.anomalies(silver_sessions)
