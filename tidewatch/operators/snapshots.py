"""What changed between full snapshots.

Keys get persistent ordinals, in blocks, which a versioned table keeps from run to run (``Ordinals``). A snapshot is, per block, a bitmap of
its ordinals and a vector of row signatures aligned to them; a block that outgrows
one bitmap goes on in the next page, and no ordinal ever changes. Consecutive
snapshots are paired page by page: AND-NOT of the bitmaps gives the added
and the removed ordinals, and the vectors, aligned over the common ordinals, the
changed ones. Only changed ordinals are turned back into keys. No row of a
snapshot is joined with a row of another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.lake.table import Conflict, Table

#: Keys a block holds on average when it is laid out.
BLOCK_KEYS = 4096
#: Ordinals of a page: the bits of one bitmap of Spark's.
BLOCK_BITS = 32768

_DIFF = "source string, block long, page long, pair int, ordinal long, change_kind string"
KEPT = T.StructType([T.StructField("source", T.StringType()), T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("ordinal", T.LongType()), T.StructField("blocks", T.IntegerType()), T.StructField("numbered_at", T.TimestampType())])


def signature(*columns: Column) -> Column:
    """64 bits over the given values; null is a value of its own."""
    return F.xxhash64(*(F.coalesce(c.cast("string"), F.lit("\x00null")) for c in columns))


def extend_ordinals(keys: DataFrame, known: DataFrame | None = None, blocks: int | None = None) -> DataFrame:
    """``(source, key, block, ordinal)`` of all keys; those of ``known`` keep their ordinals, new ones go after them.

    ``keys``: ``(source, key)``, repeats allowed, null keys left out. ``blocks``
    must be that of ``known``; it defaults to a block per ``BLOCK_KEYS`` keys.
    """
    distinct = keys.where("key is not null").distinct()
    if blocks is None:
        blocks = max(1, -(-distinct.count() // BLOCK_KEYS))
    block = F.pmod(F.xxhash64("source", "key"), F.lit(blocks)).alias("block")
    new = distinct if known is None else distinct.join(known, ["source", "key"], "left_anti")
    numbered = new.select("source", "key", block).withColumn("ordinal", F.row_number().over(Window.partitionBy("source", "block").orderBy("key")).cast("long") - 1)
    if known is None:
        return numbered
    tops = known.groupBy("source", "block").agg(F.max("ordinal").alias("_top"))
    shifted = numbered.join(tops, ["source", "block"], "left").select("source", "key", "block", (F.col("ordinal") + F.coalesce(F.col("_top") + 1, F.lit(0))).alias("ordinal"))
    return known.select("source", "key", "block", "ordinal").unionByName(shifted)


class Ordinals:
    """The ordinals of all keys ever seen, in a versioned table; a run adds the new ones in one commit.

    The number of blocks is laid down by the first run and kept; later keys fill the blocks' further pages.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.table = Table(spark, folder, KEPT, "numbered_at")

    def read(self) -> DataFrame:
        return self.table.read().select("source", "key", "block", "ordinal")

    def extend(self, keys: DataFrame, blocks: int | None = None) -> DataFrame:
        """All ordinals, those of ``keys`` that had none among them; if another run has numbered keys meanwhile, its ordinals stand and the rest is numbered anew."""
        while True:
            version = self.table.version()
            laid = self.table.read().select("blocks").first() if version else None
            known = self.read() if laid else None
            n = laid["blocks"] if laid else blocks or max(1, -(-keys.where("key is not null").distinct().count() // BLOCK_KEYS))
            new = extend_ordinals(keys, known, n)
            fresh = new if known is None else new.join(known.select("source", "key"), ["source", "key"], "left_anti")
            try:
                self.table.append(fresh.withColumns({"blocks": F.lit(n), "numbered_at": F.current_timestamp()}), expected=version)
                return self.read()
            except Conflict:
                continue


def encode(records: DataFrame, ordinals: DataFrame) -> DataFrame:
    """Pages ``(source, block, page, seq, bits, sigs)`` of ``records`` ``(source, key, seq, sig)``, a row per key and ``seq``."""
    placed = records.join(ordinals, ["source", "key"]).withColumn("page", F.expr(f"ordinal div {BLOCK_BITS}")).withColumn("at", F.expr(f"ordinal % {BLOCK_BITS}"))
    return placed.groupBy("source", "block", "page", "seq").agg(
        F.bitmap_construct_agg("at").alias("bits"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "sig"))), lambda x: x["sig"]).alias("sigs"),
    )


def _bits(b: bytes | None) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little").view(bool) if b is not None else np.zeros(BLOCK_BITS, bool)


def _diff(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        parts = []
        for source, block, page, pair, old, old_sigs, new, new_sigs in pdf.itertuples(index=False):
            a, b = _bits(old), _bits(new)
            both = a & b
            kinds = {"added": np.flatnonzero(b & ~a), "removed": np.flatnonzero(a & ~b)}
            common = np.flatnonzero(both)
            if len(common):
                va, vb = np.asarray(old_sigs, np.int64), np.asarray(new_sigs, np.int64)
                kinds["changed"] = common[va[both[a]] != vb[both[b]]]
            for kind, at in kinds.items():
                if len(at):
                    parts.append(pd.DataFrame({"source": source, "block": block, "page": page, "pair": pair, "ordinal": at + page * BLOCK_BITS, "change_kind": kind}))
        if parts:
            yield pd.concat(parts)


def differences(encoded: DataFrame, runs: DataFrame) -> DataFrame:
    """``(source, block, page, pair, ordinal, change_kind)``; pair ``n`` compares snapshot ``n - 1`` with ``n``.

    ``runs``: ``(source, seq)`` of all snapshots, so that an empty one counts too.
    """
    last = runs.groupBy("source").agg(F.max("seq").alias("_last"))
    b = encoded.join(last, "source")
    old = b.where(F.col("seq") < F.col("_last")).select("source", "block", "page", (F.col("seq") + 1).alias("pair"), F.lit(0).alias("role"), "bits", "sigs")
    new = b.where("seq > 0").select("source", "block", "page", F.col("seq").alias("pair"), F.lit(1).alias("role"), "bits", "sigs")
    pick = lambda role, c: F.first(F.when(F.col("role") == role, F.col(c)), ignorenulls=True)
    pairs = old.unionByName(new).groupBy("source", "block", "page", F.col("pair").cast("int").alias("pair")).agg(pick(0, "bits").alias("old"), pick(0, "sigs").alias("old_sigs"), pick(1, "bits").alias("new"), pick(1, "sigs").alias("new_sigs"))
    return pairs.mapInPandas(_diff, _DIFF)


def snapshot_changes(records: DataFrame, runs: DataFrame, ordinals: DataFrame) -> DataFrame:
    """``(source, seq, key, change_kind)`` of each snapshot against the one before; the first has none.

    ``records``: ``(source, key, seq, sig)`` with a row per key and snapshot.
    Empty tables give no changes.
    """
    found = differences(encode(records, ordinals), runs)
    return found.join(ordinals, ["source", "block", "ordinal"]).select("source", F.col("pair").alias("seq"), "key", "change_kind")
