"""Connected components of a link table, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.storage import settle


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 64) -> DataFrame:
    """``(node, component)`` of every node in ``links``; a component is named by its least node.

    Each round takes the least label among a node's neighbours and then the
    label's own label, so that chains shorten by half or more. Minima are
    taken before the shuffle; a hub sends a row per task. Links with a null end are
    left out, a link to itself makes a component of one. Every round is written to the shared folder.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = settle(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = settle(edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    for _ in range(rounds):
        near = edges.join(labels, edges["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["x"]).select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        heads = labels.select(F.col("node").alias("head"), F.col("label").alias("above"))
        moved = settle(step.join(heads, step["label"] == heads["head"], "left").select("node", "was", F.least("label", F.coalesce("above", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components not settled after {rounds} rounds")
