"""History of changing attributes: versions with the time each was valid.

Every observation is a unit interval ``[seq, seq + 1)`` of its entity. In
logarithmic rounds the interval runs of neighbouring blocks are merged
pairwise: two runs that meet and carry the same payload become one. The
lower rounds are spread by entity and block, so that an entity with very many
observations is shared by many tasks; what reaches the upper rounds is
coalesced already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds whose blocks stay in one task: a task's group holds at most 2**10 unit intervals of an entity.
LOCAL_ROUNDS = 10


def _join_runs(a: Column, b: Column, meet: bool) -> Column:
    last, first = F.element_at(a, -1), F.element_at(b, 1)
    same = last["p"].eqNullSafe(first["p"])
    if meet:
        same = same & (last["e"] == first["s"])
    fused = F.concat(
        F.slice(a, F.lit(1), F.size(a) - 1),
        F.array(F.struct(last["s"].alias("s"), first["e"].alias("e"), last["p"].alias("p"))),
        F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0))),
    )
    return F.when(a.isNull(), b).when(b.isNull(), a).when(same, fused).otherwise(F.concat(a, b))


def coalesce_runs(units: DataFrame, entity: Sequence[str], seq: str, payload: str, length: int, meet: bool = True) -> DataFrame:
    """Maximal runs ``(entity..., start, end, payload)`` of equal payload per entity.

    ``units`` has a row per entity and ``seq`` (0 <= seq < ``length``). With
    ``meet`` only runs without a gap are merged (snapshots: an absence ends a
    version); without it successive observations are merged however far they
    are apart (updates: a value holds until the next one). ``end`` is exclusive. Repeated rows
    count once; of different payloads at one ``seq`` the largest counts.
    Rows with a null ``seq`` have no time and are left out; a null entity is an entity like any other. An empty table gives no runs.
    """
    keys = list(entity)
    at = F.col(seq).cast("long")
    nodes = (
        units.where(F.col(seq).isNotNull())
        .groupBy(*keys, at.alias("_node"))
        .agg(F.max(F.col(payload)).alias("_p"))
        .select(*keys, "_node", F.array(F.struct(F.col("_node").alias("s"), (F.col("_node") + 1).alias("e"), F.col("_p").alias("p"))).alias("_runs"))
    )
    rounds = max(1, (max(length, 2) - 1).bit_length())
    for r in range(rounds):
        if r % LOCAL_ROUNDS == 0:  # spread by entity and the block that these rounds fill
            ahead = min(LOCAL_ROUNDS, rounds - r)
            nodes = nodes.withColumn("_block", F.shiftright("_node", ahead)).repartition(*keys, "_block")
        nodes = (
            nodes.groupBy(*keys, "_block", F.shiftright("_node", 1).alias("_up"))
            .agg(F.first(F.when(F.col("_node") % 2 == 0, F.col("_runs")), ignorenulls=True).alias("_a"), F.first(F.when(F.col("_node") % 2 == 1, F.col("_runs")), ignorenulls=True).alias("_b"))
            .select(*keys, "_block", F.col("_up").alias("_node"), _join_runs(F.col("_a"), F.col("_b"), meet).alias("_runs"))
        )
    return nodes.select(*keys, F.explode("_runs").alias("_r")).select(*keys, F.col("_r.s").alias("start"), F.col("_r.e").alias("end"), F.col("_r.p").alias(payload))
