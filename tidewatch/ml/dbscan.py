"""Density clusters of token sets by cosine distance, without all pairs.

Records with equal token sets are one point with a weight. Vectors are binary
TF-IDF of unit length. Of two vectors at least ``1 - eps`` alike, each has a
common token among its rarest ones, before the rest of the vector is too short to reach that likeness (Cauchy and
Schwarz); only records that share such a token are compared, with the full product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.ml.search import tfidf
from tidewatch.operators.components import components
from tidewatch.storage import settle

EPS, LEAST = 0.35, 5


def _prefix(weights: DataFrame, key: str, like: float) -> DataFrame:
    """Of each vector the rarest tokens, up to where the rest is shorter than ``like``."""
    order = Window.partitionBy(key).orderBy(F.desc("weight"), "term")
    rest = Window.partitionBy(key).orderBy(F.desc("weight"), "term").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = weights.withColumn("left", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(rest))).withColumn("n", F.row_number().over(order))
    return w.where(F.col("left") >= F.lit(like - 1e-12)).select(key, "term")


def cosine_links(weights: DataFrame, key: str, like: float) -> DataFrame:
    """``(a, b, cosine)`` of pairs with at least that likeness, each once.

    The order within a vector is by weight; as the weight of a binary vector falls with a token's frequency, both vectors of a pair have
    their common tokens in one order, and the first common one lies in both prefixes.
    """
    index = settle(_prefix(weights, key, like), "prefix")
    x, y = index.select(F.col(key).alias("a"), "term"), index.select(F.col(key).alias("b"), "term")
    met = x.join(y, "term").where("a < b").select("a", "b").distinct()
    packed = weights.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("v"))
    pairs = met.join(packed.select(F.col(key).alias("a"), F.col("v").alias("va")), "a").join(packed.select(F.col(key).alias("b"), F.col("v").alias("vb")), "b")
    common = F.array_intersect(F.map_keys("va"), F.map_keys("vb"))
    product = F.aggregate(common, F.lit(0.0), lambda s, t: s + F.col("va")[t] * F.col("vb")[t])
    return pairs.select("a", "b", product.alias("cosine")).where(F.col("cosine") >= F.lit(like - 1e-12))


def dbscan(sets: DataFrame, key: str = "host", tokens: str = "tokens", eps: float = EPS, least: int = LEAST) -> DataFrame:
    """``(key, cluster)``: 1 is the largest cluster, ties by least key; -1 is noise.

    A point is a core if at least ``least`` records, itself among them, are within
    ``eps``; cores within ``eps`` share a cluster; any other record within
    ``eps`` of a core joins the cluster of the one with the least key. Fewer records than
    ``least`` are all noise. Null or empty token sets are noise; repeated keys count once.
    """
    rows = settle(sets.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(tokens)))).alias("t")), "sets")
    if rows.limit(least).count() < least:
        return rows.select(key, F.lit(-1).alias("cluster"))
    full = rows.where(F.size("t") > 0)
    points = settle(full.groupBy("t").agg(F.min(key).alias("p"), F.count("*").alias("w")), "points")
    n = rows.count()
    df = full.select(F.explode("t").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    raw = points.select("p", F.explode("t").alias("term")).join(df, "term").select("p", "term", (F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1).alias("x"))
    length = raw.groupBy("p").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("l"))
    weights = settle(raw.join(length, "p").select("p", "term", (F.col("x") / F.col("l")).alias("weight")), "weights")
    links = settle(cosine_links(weights, "p", 1 - eps), "links")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    w = points.select("p", "w")
    degree = both.join(w.withColumnRenamed("p", "b"), "b").groupBy(F.col("a").alias("p")).agg(F.sum("w").alias("near"))
    core = settle(w.join(degree, "p", "left").where(F.col("w") + F.coalesce("near", F.lit(0)) >= least).select("p"), "core")
    inner = both.join(core.withColumnRenamed("p", "a"), "a").join(core.withColumnRenamed("p", "b"), "b")
    joined = components(inner)
    cored = core.join(joined, F.col("p") == F.col("node"), "left").select("p", F.coalesce("component", "p").alias("c"))
    border = both.join(core.withColumnRenamed("p", "b"), "b").join(core.withColumnRenamed("p", "a"), "a", "left_anti").groupBy("a").agg(F.min("b").alias("b"))
    labelled = cored.unionByName(border.join(cored.withColumnRenamed("p", "b"), "b").select(F.col("a").alias("p"), "c"))
    member = settle(full.join(points.select("t", "p"), "t").join(labelled, "p").select(key, "c"), "member")
    size = member.groupBy("c").agg(F.count("*").alias("n"), F.min(key).alias("least"))
    number = size.withColumn("cluster", F.row_number().over(Window.orderBy(F.desc("n"), "least"))).select("c", "cluster")  # a row per cluster
    return rows.select(key).join(member.join(number, "c").select(key, "cluster"), key, "left").select(key, F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def summaries(profiles: DataFrame, labels: DataFrame, key: str = "host", top: int = 3) -> DataFrame:
    """Per cluster: servers, URLs, online URLs, distinct /24 networks, the commonest tags and paths (ties by name).

    ``profiles``: ``(key, paths, tags, urls, online_urls, net)``.
    """
    j = profiles.join(labels.where("cluster <> -1"), key)

    def most(column: str, name: str) -> DataFrame:
        n = j.select("cluster", F.explode(column).alias("x")).groupBy("cluster", "x").agg(F.count("*").alias("n"))
        best = n.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("n"), "x"))).where(F.col("r") <= top)
        return best.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda s: s["x"]).alias(name))

    base = j.groupBy("cluster").agg(F.count("*").alias("servers"), F.sum("urls").alias("urls"), F.sum("online_urls").alias("online_urls"), F.countDistinct("net").alias("distinct_subnets"))
    return base.join(most("tags", "top_tags"), "cluster", "left").join(most("paths", "top_paths"), "cluster", "left")


def coherence(labels: DataFrame, key: str, net: str) -> DataFrame:
    """One row: the share of same-network pairs within clusters and among all records, and the lift; by counting, no pair is made. Records without a network don't count."""
    have = labels.where(F.col(net).isNotNull())
    two = lambda c: F.coalesce(F.sum(F.col(c) * (F.col(c) - 1) / 2), F.lit(0.0))

    def rate(df, by, name):
        same = df.groupBy(*by, net).agg(F.count("*").alias("n")).agg(two("n").alias("s"))
        pairs = (df.groupBy(*by) if by else df.groupBy()).agg(F.count("*").alias("n")).agg(two("n").alias("p"))
        return same.crossJoin(pairs).select(F.when(F.col("p") > 0, F.col("s") / F.col("p")).otherwise(0.0).alias(f"{name}_rate"), F.col("p").cast("long").alias(f"{name}_pairs"))

    both = rate(have.where("cluster <> -1"), ["cluster"], "within").crossJoin(rate(have, [], "random"))
    return both.withColumn("lift", F.when(F.col("random_rate") > 0, F.col("within_rate") / F.col("random_rate")))
