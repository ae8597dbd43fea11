"""Honest evaluation: splits by time, stratified folds, ranking quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ranking import numbered
from tidewatch.storage import fresh


def split_by_date(df: DataFrame, day: str, cutoff: str) -> DataFrame:
    """``side``: ``train`` before the cutoff, ``test`` from that day on; rows without a date are on neither side."""
    return df.where(F.col(day).isNotNull()).withColumn("side", F.when(F.col(day) < F.lit(cutoff).cast("date"), "train").otherwise("test"))


def require_both_classes(split: DataFrame, label: str) -> None:
    """An error unless either side has both classes."""
    seen = {(r["side"], r[label]) for r in split.select("side", label).distinct().collect()}  # four rows at most
    for side in ("train", "test"):
        if {y for s, y in seen if s == side} != {0, 1}:
            raise ValueError(f"the {side} side needs both classes")


def folds(df: DataFrame, label: str, order: Sequence[Column], k: int) -> DataFrame:
    """``fold`` 0 to k - 1, as even as can be within each class; ``order`` should end in a full tie-break. A class isn't gathered in one task."""
    at = fresh(df.columns, "_tw_place")
    placed = numbered(df, [F.asc_nulls_first(label), *order], at)
    first = placed.groupBy(F.col(label).alias("_tw_label")).agg(F.min(at).alias("_tw_first"))  # a row per class
    return placed.join(F.broadcast(first), F.col(label).eqNullSafe(F.col("_tw_label"))).withColumn("fold", (F.col(at) - F.col("_tw_first")) % k).drop(at, "_tw_label", "_tw_first")


def fold_count(minority: int) -> int:
    return max(2, min(5, minority))


def ranking_quality(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``(average_precision, roc_auc, positives)``; equal scores stand together.

    Rows are counted per distinct score first, so the order is one of scores, not of rows.
    """
    g = df.groupBy(score).agg(F.sum(F.col(label).cast("double")).alias("p"), F.count(F.lit(1)).cast("double").alias("c"))
    w, all_ = Window.orderBy(F.desc(score)), Window.partitionBy()
    r = g.select("p", "c", F.sum("p").over(w).alias("tp"), F.sum("c").over(w).alias("n"), F.sum("p").over(all_).alias("np"), F.sum("c").over(all_).alias("total"))
    neg = F.col("c") - F.col("p")
    return r.agg(
        F.round(F.sum(F.col("p") / F.nullif(F.col("np"), F.lit(0.0)) * F.col("tp") / F.col("n")), 6).alias("average_precision"),
        F.round(F.sum(neg * (F.col("tp") - F.col("p")) + neg * F.col("p") / 2) / F.nullif(F.max("np") * (F.max("total") - F.max("np")), F.lit(0.0)), 6).alias("roc_auc"),
        F.max("np").cast("long").alias("positives"),
    )
