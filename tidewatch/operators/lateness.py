"""Per-period counts by event time that late events correct, up to a cut-off.

Two views of one log. The fast layer only adds: what arrives after the last scheduled batch increments
the provisional counts of its periods. The batch layer recomputes, from the full log up to its moment, the periods
that are still open, replaces their provisional counts and
freezes a period once its cut-off has passed; what arrives later is refused and changes nothing.
Which periods were corrected or refused something is read from these views: what was published first, what is served, what the log holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.storage import settle


@dataclass(frozen=True)
class Periods:
    """Seconds: a period's length, how long after its end it is first published, and how long it stays open."""

    length: int = 3600
    publish_after: int = 900
    cut_off: int = 72 * 3600


def first_arrivals(rows: DataFrame, identifier: Column, group: str, occurred: str, arrived: str) -> DataFrame:
    """``(grp, occurred_us, arrived_us)`` of each event once, at its smallest arrival.

    The event's group and time are those of its earliest copy that has them. Rows without an
    identifier, and events that have no time or arrival in any copy, are left out; a null group is a group of its own.
    """
    t, a = F.unix_micros(occurred), F.unix_micros(arrived)
    one = rows.select(identifier.alias("_id"), F.col(group).alias("_g"), t.alias("_t"), a.alias("_a")).where("_id is not null")
    return (
        one.groupBy("_id")
        .agg(F.min("_a").alias("arrived_us"), F.min(F.when(F.col("_g").isNotNull(), F.struct("_a", "_g")))["_g"].alias("grp"), F.min(F.when(F.col("_t").isNotNull(), F.struct("_a", "_t")))["_t"].alias("occurred_us"))
        .where("arrived_us is not null and occurred_us is not null")
        .select("grp", "occurred_us", "arrived_us")
    )


def increments(events: DataFrame, p: Periods, *by: str) -> DataFrame:
    """Increments ``(grp, period_start, stage, by..., n)`` of a slice of arrivals.

    ``period_start``: epoch seconds. ``stage`` says when the events arrived:
    ``provisional`` before the first publication, ``corrected`` up to the cut-off, ``cut_off`` after it.
    """
    length = p.length * 1_000_000
    start = F.expr(f"occurred_us - pmod(occurred_us, {length}L)")
    late = F.col("arrived_us") - F.col("_start") - F.lit(length)
    stage = F.when(late < p.publish_after * 1_000_000, "provisional").when(late < p.cut_off * 1_000_000, "corrected").otherwise("cut_off")
    return events.withColumn("_start", start).groupBy("grp", F.expr("_start div 1000000L").alias("period_start"), stage.alias("stage"), *by).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Views:
    """``frozen`` and ``base`` by the batch of ``batch_us``, ``fast`` since then, each ``(grp, period_start, n)``; ``published``: the counts first given; ``logged``: all events of the log."""

    frozen: DataFrame
    base: DataFrame
    fast: DataFrame
    published: DataFrame
    logged: DataFrame
    batch_us: int


def is_open(batch_us: int, p: Periods) -> Column:
    """Whether the batch of that moment left a period open."""
    return F.col("period_start") > F.lit(batch_us // 1_000_000 - p.length - p.cut_off)


def build_views(events: DataFrame, p: Periods, batch_us: int) -> Views:
    """The layers over a log of first arrivals: the batch at ``batch_us`` counts from all of the log before it, the fast layer adds the rest.

    The log is aggregated once; every view is a selection of its increments.
    """
    counted = settle(increments(events.withColumn("_batch", F.col("arrived_us") < F.lit(batch_us)), p, "_batch"), "increments")
    kept = counted.where("stage <> 'cut_off'")
    n = lambda df: df.groupBy("grp", "period_start").agg(F.sum("n").alias("n"))
    batch = n(kept.where("_batch"))
    still = is_open(batch_us, p)
    return Views(batch.where(~still), batch.where(still), n(kept.where(~F.col("_batch") & still)), n(counted.where("stage = 'provisional'")), n(counted), batch_us)


def serve(frozen: DataFrame, base: DataFrame, fast: DataFrame, batch_us: int, p: Periods) -> DataFrame:
    """The counts to read: what the batch of ``batch_us`` froze as it is, all else as recomputed plus what the fast layer added since.

    All three: ``(grp, period_start, n)``. Increments of frozen periods are ignored; a period whose cut-off has
    passed since the batch is served from base and fast until the next batch freezes it.
    """
    still = is_open(batch_us, p)
    live = base.where(still).select("grp", "period_start", "n").unionByName(fast.where(still).select("grp", "period_start", "n")).groupBy("grp", "period_start").agg(F.sum("n").alias("n"))
    return frozen.where(~still).select("grp", "period_start", "n").unionByName(live)


def reconciled(v: Views, p: Periods) -> DataFrame:
    """``(grp, period_start, provisional, final, late, cut_off)`` per period of the log.

    ``provisional``: the count first published; ``final``: the count served; ``late``: the
    difference; ``cut_off``: events of the log that came too late to be counted.
    """
    named = lambda df, name: df.select("grp", "period_start", F.lit(name).alias("view"), "n")
    every = named(v.published, "provisional").unionByName(named(serve(v.frozen, v.base, v.fast, v.batch_us, p), "final")).unionByName(named(v.logged, "logged"))
    of = lambda name: F.coalesce(F.sum(F.when(F.col("view") == name, F.col("n"))), F.lit(0)).cast("long").alias(name)
    wide = every.groupBy("grp", "period_start").agg(of("provisional"), of("final"), of("logged"))
    return wide.select("grp", "period_start", "provisional", "final", (F.col("final") - F.col("provisional")).alias("late"), (F.col("logged") - F.col("final")).alias("cut_off"))


def late_kinds(view: DataFrame) -> DataFrame:
    """``(grp, period_start, late_kind)``: periods that late events corrected, or came too late for."""
    kinds = F.filter(F.array(F.when(F.col("late") > 0, F.lit("corrected")), F.when(F.col("cut_off") > 0, F.lit("cut_off"))), lambda k: k.isNotNull())
    return view.select("grp", "period_start", F.explode(kinds).alias("late_kind"))
