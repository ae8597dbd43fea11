"""Grouping records into similarity clusters.

Records with equal feature sets share a profile. Profiles are vectorised with
hashed features weighted by rarity, and divided into cells by distributed
k-means, seeded in parallel with oversampling. ``described`` reports the cells,
with their size and the members nearest each centroid; ``typical_members`` the linked clusters.

Clusters by linked likeness (``linked``) are made from the cells: profiles are compared inside a cell only, and a profile
also visits another cell where it could have a partner. Two exact conditions decide: of two sets alike
enough, the rarest features (as many as their sizes demand) must share one; and the profile must share enough features
with all members of the cell's size class together, whose features are kept as one
bit mask per cell and class. The better k-means has divided the profiles, the fewer visits pass, and no link is lost at the cells' borders.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.urls import url_host, url_last_segment, url_port
from tidewatch.operators.components import components
from tidewatch.storage import settle

#: Cells of k-means, its rounds, and the length of the hashed vectors.
CELLS, ROUNDS, WIDTH = 64, 8, 1024
#: Words of 64 bits of a cell's feature mask.
WORDS = 128
#: Two sets are alike if they share at least a half of the features either has: |A and B| * 3 >= |A| + |B|.
LEAST_CLUSTER = 5
#: Members of a block when the pairs of a cluster are written out.
PAIR_BLOCK = 256


def server_features(urls: DataFrame) -> DataFrame:
    """``(host, feature)``: last path segments, ports and tags over all URLs of a server.

    The host is that of the URL, else the ``host`` column; rows without URL or host say nothing.
    Null and blank tags are no features.
    """
    u = F.col("url")
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda x: F.lower(F.regexp_replace(x, r"(?U)^\s+|\s+$", "")))
    named = F.concat(F.array(F.concat(F.lit("path="), url_last_segment(u)), F.concat(F.lit("port="), url_port(u))), F.transform(F.filter(tags, lambda x: x.isNotNull() & (x != "")), lambda x: F.concat(F.lit("tag="), x)))
    return urls.where(u.isNotNull()).select(F.coalesce(url_host(u), F.lower(F.trim("host"))).alias("host"), F.explode(named).alias("feature")).where("host is not null and feature is not null").distinct()


def profiles(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(host, profile)`` and ``(profile, features, n, hosts)``: equal feature sets once, features rarest first.

    Features are kept as 64-bit hashes beside the hashed vectors' terms.
    """
    per_host = features.groupBy("host").agg(F.array_sort(F.collect_list("feature")).alias("terms")).select("host", F.xxhash64(F.concat_ws("\x1f", "terms"), F.size("terms")).alias("profile"), "terms")
    hosts = settle(per_host, "hosts")
    own = hosts.groupBy("profile").agg(F.first("terms").alias("terms"), F.count(F.lit(1)).alias("hosts"))
    own = settle(own, "own")
    flat = own.select("profile", F.explode("terms").alias("term"))
    df = flat.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ranked = flat.join(df, "term").groupBy("profile").agg(F.array_sort(F.collect_list(F.struct("df", F.xxhash64("term").alias("t")))).alias("r"))
    table = own.join(ranked, "profile").select("profile", "terms", "hosts", F.col("r.t").alias("features"), F.size("r").alias("n"))
    return hosts.select("host", "profile"), settle(table, "profiles")


def cells(table: DataFrame, k: int = CELLS, seed: int = 11) -> DataFrame:
    """``(profile, features, n, hosts, cell, distance)``: each profile's k-means cell and its distance from the centroid.

    Fewer profiles than ``k`` make fewer cells; none make an empty table.
    """
    if table.isEmpty():
        return table.select("profile", "features", "n", "hosts", F.lit(0).alias("cell"), F.lit(0.0).alias("distance"))
    tf = HashingTF(inputCol="terms", outputCol="tf", numFeatures=WIDTH, binary=False)
    counted = tf.transform(table)
    weighted = IDF(inputCol="tf", outputCol="w").fit(counted).transform(counted)
    unit = Normalizer(inputCol="w", outputCol="v", p=2.0).transform(weighted)
    model = KMeans(featuresCol="v", predictionCol="cell", weightCol="hosts", k=k, initMode="k-means||", initSteps=2, maxIter=ROUNDS, seed=seed, solver="row").fit(unit)
    centres = table.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell int, centre array<double>")
    near = model.transform(unit).join(F.broadcast(centres), "cell")
    apart = F.aggregate(F.zip_with(vector_to_array("v"), F.col("centre"), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return settle(near.select("profile", "features", "n", "hosts", "cell", F.sqrt(apart).alias("distance")), "cells")


def described(celled: DataFrame, hosts: DataFrame, typical: int = 5) -> DataFrame:
    """``(cell, members, profiles, mean_distance, rank, host, distance)``: each cluster's size and its most typical members, nearest first."""
    size = celled.groupBy("cell").agg(F.sum("hosts").alias("members"), F.count(F.lit(1)).alias("profiles"), (F.sum(F.col("distance") * F.col("hosts")) / F.sum("hosts")).alias("mean_distance"))
    order = Window.partitionBy("cell").orderBy("distance", "host")
    near = celled.select("profile", "cell", "distance").join(hosts, "profile").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= typical)
    return near.join(size, "cell").select("cell", "members", "profiles", "mean_distance", "rank", "host", "distance")


def _step(n: Column) -> Column:
    """The class of a set's size: the size itself up to 16, above that the least size of a step of a quarter."""
    return F.when(n <= 16, n).otherwise((16 * F.pow(F.lit(1.25), F.floor(F.log(n / F.lit(16.0)) / F.log(F.lit(1.25))))).cast("int"))


def _enough(n: Column, m: Column) -> Column:
    """Features that two sets of these sizes must share."""
    return F.ceil((n + m) / 3).cast("int")


def signatures(celled: DataFrame) -> DataFrame:
    """``(to, other, mask)``: the bits of all features of each cell's members of one size class; a kilobyte per row, at most ``CELLS`` times the classes."""
    bit = celled.select("cell", _step(F.col("n")).alias("other"), F.explode("features").alias("f")).select("cell", "other", F.pmod("f", F.lit(WORDS)).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned("f", 32), F.lit(64)).cast("int")).alias("b"))
    word = bit.groupBy("cell", "other", "w").agg(F.bit_or("b").alias("b"))
    filled = word.groupBy(F.col("cell").alias("to"), "other").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    return filled.select("to", "other", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long"))).alias("mask"))


def prefixes(celled: DataFrame) -> DataFrame:
    """``(profile, cell, n, own, other, pos, feature)``: for each class of sizes (``other``) the rarest features of which a partner must have one.

    For a partner of ``m`` features a set of ``n`` must share ``e = ceil((n + m) / 3)``, so the first common one is
    among its first ``n - e + 1``. Rows that could meet nobody are dropped: no other profile has their key.
    """
    sizes = F.array_distinct(F.transform(F.sequence(F.ceil(F.col("n") / 2).cast("int"), F.col("n") * 2), _step))
    own = celled.withColumn("own", _step(F.col("n"))).withColumn("other", F.explode(sizes))
    keep = F.greatest(F.lit(1), F.col("n") - _enough(F.col("n"), F.col("other")) + 1)
    keyed = own.select("profile", "cell", "n", "own", "other", F.posexplode(F.slice("features", F.lit(1), keep)).alias("pos", "feature"))
    common = keyed.groupBy("feature", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(F.min("profile").alias("p"), F.max("profile").alias("q")).where("p <> q").select("feature", "lo", "hi")
    return keyed.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).join(common, ["feature", "lo", "hi"], "left_semi").drop("lo", "hi")


def visits(celled: DataFrame, home: DataFrame) -> DataFrame:
    """``(profile, cell, n, own, other, to, keys)``: which cells each profile goes to, its own among them, and with which of its prefix features."""
    there = home.select("feature", F.col("own").alias("other"), F.col("other").alias("own"), F.col("cell").alias("to")).distinct()
    asked = home.join(there, ["feature", "own", "other"]).where("to >= cell").repartition("profile")
    asked = asked.groupBy("profile", "cell", "n", "own", "other", "to").agg(F.collect_list(F.struct("pos", "feature")).alias("keys"))
    held = F.aggregate("features", F.lit(0), lambda t, f: t + F.getbit(F.get("mask", F.pmod(f, F.lit(WORDS)).cast("int")), F.pmod(F.shiftrightunsigned(f, 32), F.lit(64)).cast("int")).cast("int"))
    met = asked.join(celled.select("profile", "features"), "profile").join(F.broadcast(signatures(celled)), ["to", "other"])
    return met.where((F.col("to") == F.col("cell")) | (held >= _enough(F.col("n"), F.col("other")))).drop("features", "mask")


def candidates(celled: DataFrame) -> DataFrame:
    """``(a, b)``: the pairs of profiles that must be compared, each once; of two sets no more can be common than what follows their first common feature."""
    home = settle(prefixes(celled), "home")
    far = visits(celled, home).select(F.explode("keys").alias("k"), F.col("own").alias("other"), F.col("other").alias("own"), F.col("to").alias("cell"), F.col("cell").alias("from"), F.col("profile").alias("guest"), F.col("n").alias("gn"))
    met = home.join(far.select("k.feature", F.col("k.pos").alias("gpos"), "other", "own", "cell", "from", "guest", "gn"), ["feature", "own", "other", "cell"]).where("profile <> guest and (from < cell or guest < profile)")
    met = met.where(F.least(F.col("n") - F.col("pos"), F.col("gn") - F.col("gpos")) >= _enough(F.col("n"), F.col("gn")))
    return met.select(F.least("profile", "guest").alias("a"), F.greatest("profile", "guest").alias("b")).distinct()


def links(celled: DataFrame) -> DataFrame:
    """``(a, b)``: profiles that share at least half of the features either has."""
    sets = celled.select("profile", "features", "n")
    left = sets.select(F.col("profile").alias("a"), F.col("features").alias("fa"), F.col("n").alias("na"))
    right = sets.select(F.col("profile").alias("b"), F.col("features").alias("fb"), F.col("n").alias("nb"))
    return candidates(celled).join(left, "a").join(right, "b").where(F.size(F.array_intersect("fa", "fb")) * 3 >= F.col("na") + F.col("nb")).select("a", "b")


def linked(celled: DataFrame, hosts: DataFrame, least: int = LEAST_CLUSTER) -> DataFrame:
    """``(host, cluster, size)``: clusters of records linked by likeness, directly or through others, of at least ``least`` members."""
    joined = components(links(celled))
    member = celled.select("profile", "hosts").join(joined, F.col("profile") == F.col("node"), "left").select("profile", "hosts", F.coalesce("component", "profile").alias("cluster"))
    size = member.groupBy("cluster").agg(F.sum("hosts").alias("size")).where(F.col("size") >= least)
    return hosts.join(member.join(size, "cluster").select("profile", "cluster", "size"), "profile").select("host", "cluster", "size")


def typical_members(clustered: DataFrame, celled: DataFrame, hosts: DataFrame, typical: int = 5) -> DataFrame:
    """``(cluster, members, rank, host, distance)``: size and most typical members of the linked clusters, nearest first.

    A cluster is named by its first host. Its centroid is the mean of its members' sets of features,
    as vectors of zeros and ones; ties go by host.
    """
    named = clustered.groupBy("cluster").agg(F.min("host").alias("name"))
    own = clustered.join(hosts, "host").select("profile", "cluster", "size").distinct().join(celled.select("profile", "features", "n", "hosts"), "profile")
    flat = own.select("profile", "cluster", "size", "n", "hosts", F.explode("features").alias("feature"))
    centre = flat.groupBy("cluster", "feature").agg((F.sum("hosts") / F.max("size")).alias("w"))
    length = centre.groupBy("cluster").agg(F.sum(F.col("w") * F.col("w")).alias("c2"))
    dots = flat.join(centre, ["cluster", "feature"]).groupBy("cluster", "profile", "n").agg(F.sum("w").alias("dot"))
    near = dots.join(length, "cluster").select("cluster", "profile", F.round(F.sqrt(F.greatest(F.col("n") - 2 * F.col("dot") + F.col("c2"), F.lit(0.0))), 6).alias("distance"))
    order = Window.partitionBy("cluster").orderBy("distance", "host")
    ranked = near.join(hosts, "profile").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= typical)
    sizes = clustered.select("cluster", "size").distinct()
    return ranked.join(sizes, "cluster").join(named, "cluster").select(F.col("name").alias("cluster"), F.col("size").alias("members"), "rank", "host", "distance")


def pairs(clustered: DataFrame) -> DataFrame:
    """``(host_a, host_b)``: every pair of one cluster, smaller first, in blocks so that no task holds a large cluster."""
    n = F.ceil(F.col("size") / F.lit(PAIR_BLOCK)).cast("int")
    blocked = clustered.withColumn("blocks", n).withColumn("block", F.pmod(F.xxhash64("host"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = blocked.select("cluster", F.col("host").alias("host_a"), F.col("block").alias("i"), every.alias("j"))
    right = blocked.select("cluster", F.col("host").alias("host_b"), F.col("block").alias("j"), every.alias("i"))
    return left.join(right, ["cluster", "i", "j"]).where("host_a < host_b").select("host_a", "host_b")
