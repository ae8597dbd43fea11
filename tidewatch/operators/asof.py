"""Attributes as known at an event's time.

Validity intervals come from successive change times. Each interval is
exploded into time buckets, and events are equi-joined by entity and bucket,
then held against the half-open interval. No inequality join is planned, and a
hot entity's events are spread over its buckets; a bucket with very many
events is split further, and its few intervals are sent to every part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.storage import fresh, settle

#: Width of a time bucket in microseconds: one day.
BUCKET_US = 86_400_000_000
#: Events of one entity and bucket that stay together.
HOT_ROWS = 200_000


def known_lists(runs: DataFrame) -> DataFrame:
    """The lists that ever count, as ``(collector_run_id, eff, known_from, known_to)`` in microseconds.

    At a time counts, of the runs ingested by then, the one collected last. A
    run that becomes known after a later collected one never counts. ``known_to``
    is null for the list that still counts.
    """
    r = runs.where(F.col("ingested_at").isNotNull()).select("collector_run_id", "collected_at", "snapshot_no", F.unix_micros("ingested_at").alias("known_from"))
    at_once = Window.partitionBy("known_from").orderBy(F.desc("collected_at"), F.desc_nulls_last("snapshot_no"), F.desc("collector_run_id"))
    best = r.withColumn("n", F.row_number().over(at_once)).where("n = 1")
    before = Window.orderBy("known_from").rowsBetween(Window.unboundedPreceding, -1)  # a row per delivery, not per record
    rising = best.withColumn("top", F.max(F.struct("collected_at", "snapshot_no")).over(before)).where(F.col("top").isNull() | (F.struct("collected_at", "snapshot_no") > F.col("top")))
    order = Window.orderBy("known_from")
    return rising.select("collector_run_id", (F.row_number().over(order) - 1).alias("eff"), "known_from", F.lead("known_from").over(order).alias("known_to"))


def valid_at(events: DataFrame, intervals: DataFrame, entity: str, at: str, bucket_us: int = BUCKET_US) -> DataFrame:
    """Events joined with the interval of their entity that holds their time.

    ``intervals``: ``(entity, valid_from, valid_to, ...)`` in microseconds,
    half-open, ``valid_to`` null while open; ``at``: microseconds. Inner: events
    without entity, time or matching interval are left out; where intervals of
    an entity overlap, an event comes out once for each. Columns of
    ``intervals`` come after those of ``events`` and must not share their names.
    """
    horizon = events.agg(F.max(at).alias("_end"))  # one row; it bounds the buckets of open intervals
    upper = F.least(F.coalesce(F.col("valid_to"), F.col("_end") + 1), F.col("_end") + 1)
    cut = (
        intervals.where(F.col(entity).isNotNull() & F.col("valid_from").isNotNull()).crossJoin(horizon)
        .where(F.col("valid_from") < upper)
        .withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("valid_from") / F.lit(bucket_us)), F.floor((upper - 1) / F.lit(bucket_us)))))
        .drop("_end")
    )
    part, parts = fresh([*events.columns, *intervals.columns], "_tw_part"), fresh([*events.columns, *intervals.columns], "_tw_parts")
    keyed = events.where(F.col(entity).isNotNull() & F.col(at).isNotNull()).withColumn("_bucket", F.floor(F.col(at) / F.lit(bucket_us)))
    hot = settle(keyed.groupBy(entity, "_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(entity, "_bucket", F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias(parts)), "hot")
    if hot.isEmpty():
        keyed, cut = keyed.withColumn(part, F.lit(0)), cut.withColumn(part, F.lit(0))
    else:  # a row for at least HOT_ROWS events
        one = F.coalesce(F.col(parts), F.lit(1))
        keyed = keyed.join(hot, [entity, "_bucket"], "left").withColumn(part, F.pmod(F.xxhash64(*events.columns), one).cast("int")).drop(parts)
        cut = cut.join(hot, [entity, "_bucket"], "left").withColumn(part, F.explode(F.sequence(F.lit(0), one - 1))).drop(parts)
    return keyed.join(cut, [entity, "_bucket", part]).where((F.col("valid_from") <= F.col(at)) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))).drop("_bucket", part)
