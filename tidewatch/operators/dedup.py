"""Messages delivered more than once: exactly one copy of each stays.

Identifiers are split by their aggregated frequency. Only identifiers are
counted (partial counts before the shuffle). Rows whose identifier is single pass on
without being ranked or moved; only the repeated groups are ranked, and the top-1 rank
is taken per partition before it is shuffled, so a hot identifier sends a row
per task. Both results are united.

Which way a row goes is decided by 64 bits of its identifier. A single row
that shares them with a repeated identifier is ranked too, alone in its group, and stays. Up to
``BROADCAST_IDS`` repeated identifiers are broadcast, after they were counted; more are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.storage import fresh, settle

#: Repeated identifiers that may be broadcast: 8 bytes each, some 32 MB as a hash table.
BROADCAST_IDS = 1_000_000


def repeated(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """The identifiers of more than one row, once each, with the rows' number ``copies``. Null identifies nothing."""
    return df.select(key.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def exactly_once(stored: DataFrame, key: Column, order: Sequence[Column], new: DataFrame | None = None) -> DataFrame:
    """One row of each identifier among ``stored`` and ``new``, the first by ``order``.

    ``order`` should end in a full tie-break; rows equal in all of it are
    interchangeable. Rows whose identifier is null identify nothing and all
    stay. An empty table gives an empty table. ``new`` may lack columns of
    ``stored`` or have others (null where missing). Columns keep their names, whatever they are.
    """
    rows = stored if new is None else stored.unionByName(new, allowMissingColumns=True)
    k, h, rank = (fresh(rows.columns, n) for n in ("_tw_key", "_tw_hash", "_tw_rank"))
    keyed = rows.withColumn(k, key).withColumn(h, F.when(F.col(k).isNotNull(), F.xxhash64(k)))
    many = settle(repeated(rows, key, k).select(F.xxhash64(k).alias(h)).distinct(), "repeated")
    if many.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        many = F.broadcast(many)
        single = keyed.join(many, h, "left_anti")  # a null matches nothing and stays
        again = keyed.join(many, h, "left_semi")
    else:  # both parts read one shuffle of the rows that have an identifier
        flag = fresh([*keyed.columns], "_tw_again")
        marked = keyed.where(F.col(h).isNotNull()).join(many.withColumn(flag, F.lit(True)), h, "left")
        single = marked.where(F.col(flag).isNull()).drop(flag).unionByName(keyed.where(F.col(h).isNull()))
        again = marked.where(F.col(flag).isNotNull()).drop(flag)
    ranked = again.withColumn(rank, F.row_number().over(Window.partitionBy(k).orderBy(*order))).where(F.col(rank) == 1)
    return single.drop(k, h).select(*rows.columns).unionByName(ranked.drop(k, h, rank).select(*rows.columns))
