"""Class-balanced logistic regression on text, trained on the past and scored on the future."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import words
from tidewatch.ml.metrics import folds, ranking_quality, require_both_classes, split_by_date
from tidewatch.operators.ranking import numbered
from tidewatch.storage import fresh, settle, settled_as


class TextModel:
    """Sublinear TF-IDF over words and pairs in at least two training texts, of unit length; L2-regularised with balanced classes.

    The terms and their frequencies come from the training side alone; every such term counts, however many they are.
    Weights are joined in, not sent to the driver. A text without known terms has a vector of zeros.
    """

    def __init__(self, text: str, label: str, rounds: int = 300):
        self.text, self.label, self.rounds = text, label, rounds

    def _terms(self, df: DataFrame, row: str) -> DataFrame:
        w = words(F.col(self.text))
        pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        return df.select(row, F.explode(F.concat(w, pairs)).alias("_t")).groupBy(row, "_t").agg(F.count(F.lit(1)).alias("_c"))

    def _features(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_x``: sparse vectors, put together by Spark itself."""
        row = fresh(df.columns, "_tw_row")
        rows = settle(df.withColumn(row, F.monotonically_increasing_id()), "texts")
        weighted = self._terms(rows, row).join(self.vocabulary, "_t").select(row, F.struct("_i", ((F.log("_c") + 1) * F.col("_idf")).alias("w")).alias("e"))
        packed = weighted.groupBy(row).agg(F.array_sort(F.collect_list("e")).alias("e"), F.sqrt(F.sum(F.col("e.w") * F.col("e.w"))).alias("l"))
        held = F.coalesce("e", F.array().cast("array<struct<_i: int, w: double>>"))
        vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"), F.transform(held, lambda e: e["_i"]).alias("indices"), F.transform(held, lambda e: e["w"] / F.col("l")).alias("values"))
        made = rows.join(packed, row, "left").select(*df.columns, vector.alias("_x"))
        return settled_as(made, T.StructType([*df.schema.fields, T.StructField("_x", VectorUDT())]), "vectors")

    def fit(self, train: DataFrame) -> TextModel:
        row = fresh(train.columns, "_tw_row")
        rows = settle(train.withColumn(row, F.monotonically_increasing_id()), "train")
        per = {r[self.label]: r["n"] for r in rows.groupBy(self.label).agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
        n = sum(per.values())
        df = self._terms(rows, row).groupBy("_t").agg(F.count(F.lit(1)).alias("_df")).where("_df >= 2")
        named = numbered(df, [F.col("_t")], "_i").select("_t", (F.col("_i") - 1).cast("int").alias("_i"), (F.log(F.lit(1.0 + n) / (F.col("_df") + 1)) + 1).alias("_idf"))
        self.vocabulary = settle(named, "terms")
        self.size = max(1, self.vocabulary.count())
        balance = F.when(F.col(self.label) == 1, n / (2 * per[1])).otherwise(n / (2 * per[0]))
        x = self._features(train).withColumn("_weight", balance).withColumn("_y", F.col(self.label).cast("double"))
        self.model = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_weight", regParam=1 / n, elasticNetParam=0, standardization=False, maxIter=self.rounds).fit(x)
        return self

    def score(self, df: DataFrame) -> DataFrame:
        """With ``probability`` of the positive class; written once."""
        return settle(self.model.transform(self._features(df)).withColumn("probability", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "prediction"), "probabilities")


def evaluate_temporal(df: DataFrame, text: str, label: str, day: str, cutoff: str) -> tuple[DataFrame, TextModel]:
    """One row: average precision, ROC-AUC, prevalence and lift on what came at or after the cutoff, by a model of what came before."""
    split = split_by_date(df, day, cutoff)
    require_both_classes(split, label)
    model = TextModel(text, label).fit(split.where("side = 'train'"))
    test = model.score(split.where("side = 'test'"))
    q = ranking_quality(test, "probability", label).crossJoin(test.agg(F.avg(F.col(label).cast("double")).alias("prevalence"), F.count("*").alias("n_test")))
    return q.withColumn("lift", F.col("average_precision") / F.col("prevalence")), model


def out_of_fold(df: DataFrame, text: str, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Every row scored by a model that hasn't seen it; ``k`` fits."""
    part = settle(folds(df, label, [F.xxhash64(F.lit(seed), key), F.col(key)], k), "folds")
    out = None
    for i in range(k):
        scored = TextModel(text, label).fit(part.where(F.col("fold") != i)).score(part.where(F.col("fold") == i)).select(key, "fold", "probability")
        out = scored if out is None else out.unionByName(scored)
    return out


def watch_list(scored: DataFrame, label: str, day: str, cutoff: str, key: str) -> DataFrame:
    """``on_watchlist`` and ``watchlist_rank``: unlinked records from the cutoff on, likeliest first; null for all others."""
    on = F.coalesce((F.col(day) >= F.lit(cutoff).cast("date")) & (F.col(label) == 0), F.lit(False))
    marked = scored.withColumn("on_watchlist", on)
    listed = numbered(marked.where("on_watchlist"), [F.desc("probability"), F.col(key)], "watchlist_rank")
    return listed.unionByName(marked.where("not on_watchlist").withColumn("watchlist_rank", F.lit(None).cast("long")))
