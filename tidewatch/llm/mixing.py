"""Mixing sources to target weights.

A record's place is a hash of its key. Tokens are summed by source and hash
bucket; the budget of each source becomes a threshold: buckets below it are
taken, those above aren't, and only the one bucket on the boundary is split
further. Budgets of several mixes are nested thresholds on one order. Nothing
is sorted, and no source is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.tokens import sizes
from tidewatch.storage import settle, tasks

#: Bits of each of the three levels; 48 of the 63 bits of a place decide.
LEVEL_BITS, LEVELS = 16, 3
_TOP = LEVEL_BITS * LEVELS


def plain_source(c: Column) -> Column:
    """A source's name without blanks at the ends, in lower case, ``-`` as ``_``."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), "-", "_"), F.lit(""))


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df``, marked for broadcast if it is proved to have ``most`` rows at the most; else as it is."""
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df


def spread(sized: DataFrame, plan: DataFrame, most: int = 10_000) -> DataFrame:
    """``sized`` joined with ``plan`` by source: broadcast if the plan is proved small; else in parts, so that no source's records meet in one task."""
    if plan.limit(most + 1).count() <= most:
        return sized.join(F.broadcast(plan), "source")
    n = tasks(sized.sparkSession)
    parted = plan.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return sized.withColumn("_part", F.pmod("place", F.lit(n)).cast("int")).join(parted, ["source", "_part"]).drop("_part")


def place(*keys: Column) -> Column:
    """48 bits that order the records of a source as if at random, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(977)), 64 - _TOP)


def budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(mix_name, source, share, budget, total, full, rest)`` per mix and source.

    The size wanted of a mix is the total of all records of its sources; a
    source's budget is its share of it. ``full``: how often the whole source is
    used; ``rest``: tokens still wanted from one more, partial use. A source
    whose cap (or lack of records) doesn't allow its budget falls short; the others keep theirs.
    Weights that are null or not positive name nothing; repeated targets of a source add up, under the lowest cap.
    """
    t = targets.select("mix_name", plain_source(F.col("source")).alias("source"), "target_weight", "max_repeats").where("mix_name is not null and source is not null and target_weight > 0")
    t = t.groupBy("mix_name", "source").agg(F.sum("target_weight").alias("w"), F.min("max_repeats").alias("cap"))
    totals = sized.groupBy("source").agg(F.sum("tokens").alias("total"))
    mix = Window.partitionBy("mix_name")  # a row per target
    b = t.join(totals, "source", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    b = b.withColumn("share", F.col("w") / F.sum("w").over(mix)).withColumn("budget", F.round(F.col("share") * F.sum("total").over(mix)).cast("long"))
    whole = F.when(F.col("total") > 0, F.expr("budget div total")).otherwise(F.lit(0).cast("long"))
    full = F.greatest(F.least(whole, F.coalesce(F.col("cap").cast("long"), whole)), F.lit(0).cast("long"))
    b = b.withColumn("full", full)
    rest = F.when((F.col("total") > 0) & (F.col("cap").isNull() | (F.col("full") < F.col("cap"))), F.col("budget") - F.col("full") * F.col("total")).otherwise(F.lit(0).cast("long"))
    return b.withColumn("rest", rest).select("mix_name", "source", "share", "budget", "total", "full", "rest")


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``below``: records whose place is less are used once more than ``full``.

    The sum below the threshold is as close to ``rest`` as whole buckets of the last level allow.
    """
    state = wanted.withColumn("prefix", F.lit(0).cast("long")).withColumn("need", F.col("rest"))
    for level in range(1, LEVELS + 1):
        shift = _TOP - LEVEL_BITS * level
        s = small(state.where("need > 0").select("mix_name", "source", "prefix", "need"))
        deep = sized
        if level > 1:  # only the boundary buckets are looked into
            deep = sized.withColumn("prefix", F.shiftrightunsigned("place", shift + LEVEL_BITS)).join(small(state.where("need > 0").select("source", "prefix").distinct()), ["source", "prefix"])
        hist = deep.groupBy("source", F.shiftrightunsigned("place", shift).alias("bucket")).agg(F.sum("tokens").alias("n"))
        hist = hist.withColumn("prefix", F.shiftrightunsigned("bucket", LEVEL_BITS))
        up_to = Window.partitionBy("mix_name", "source").orderBy("bucket")  # at most 2**LEVEL_BITS rows
        run = hist.join(s, ["source", "prefix"]).withColumn("cum", F.sum("n").over(up_to))
        edge = run.where("cum > need").groupBy("mix_name", "source").agg(F.min(F.struct("bucket", "cum", "n")).alias("e"))
        # what is met exactly has no edge any more: its prefix stands for the first bucket of the next level
        state = state.join(edge, ["mix_name", "source"], "left").select(
            *wanted.columns,
            F.coalesce("e.bucket", F.shiftleft("prefix", LEVEL_BITS)).cast("long").alias("prefix"),
            F.when(F.col("e").isNotNull(), F.col("need") - (F.col("e.cum") - F.col("e.n"))).otherwise(F.lit(0)).cast("long").alias("need"),
            F.coalesce("e.n", F.lit(0)).alias("at_edge"),
        )
        state = small(state)
    closer = (F.col("at_edge") > 0) & (F.col("at_edge") - F.col("need") < F.col("need"))
    return state.select(*wanted.columns, F.when(closer, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("below"))


def mix(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(mix_name, source, key columns..., tokens, times)``: the records used and how often.

    ``sized``: ``(source, tokens, place, ...)``. Rows with a null source or of
    a source that no mix names are not used. Rows of one place stand or fall together.
    """
    plan = thresholds(sized, small(budgets(sized, targets))).select("mix_name", "source", "full", "below")
    used = spread(sized, plan).withColumn("times", F.col("full") + F.when(F.col("place") < F.col("below"), 1).otherwise(0)).where("times > 0")
    return used.drop("full", "below", "place")


def shares(used: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per mix and source: target and reached share, tokens and records used, and the budget."""
    got = used.groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("times")).alias("tokens"), F.count(F.lit(1)).alias("records"), F.max("times").alias("most_times"))
    j = wanted.join(got, ["mix_name", "source"], "left").na.fill(0, ["tokens", "records", "most_times"])
    return j.withColumn("reached_share", F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy("mix_name")), F.lit(0))).select("mix_name", "source", F.col("share").alias("target_share"), "reached_share", "budget", "tokens", "records", "most_times")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``(source, doc_id, tokens, place)`` of the documents that have a source, written once; sizes from the table of distinct words."""
    named = docs.select(plain_source(F.col("source")).alias("source"), "doc_id", "text", place(F.col("doc_id"), F.col("text")).alias("place")).where("source is not null")
    return settle(sizes(named, ["source", "doc_id", "place"], "text").select("source", "doc_id", "tokens", "place"), "sized")
