"""Vector and keyword search, and the fusion of rankings."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from itertools import islice
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.storage import settle, shared_dir

_WORD = "[a-z0-9]{2,}"
#: A word of any script for keyword search.
TERM = r"[\p{L}\p{N}_]{2,}"
#: English words that say nothing about a text's subject.
STOP_WORDS = tuple(
    """about above after again against all also although always among an and another any are around as at be became because been before being below
    between both but by can cannot could did do does doing done down during each either else ever every few for from further had has have having he her here hers
    him his how however if in into is it its itself just many may me might more most much must my neither no nor not now of off often on once one only or other
    others our ours out over own perhaps rather same she should since so some such than that the their theirs them then there these they this those through
    to together too under until up upon us very was we well were what when where whether which while who whom whose why will with within without would yet you your yours""".split()
)


class Embedder(Protocol):
    """Texts to vectors of one length; a query may be encoded unlike a document."""

    name: str
    size: int

    def documents(self, texts: Sequence[str]) -> np.ndarray: ...

    def query(self, text: str) -> np.ndarray: ...


class HashedWords:
    """A bag of hashed words. It finds shared words, not shared meaning; no model is available offline."""

    def __init__(self, size: int = 384):
        self.name, self.size = f"hashed-words-{size}", size

    def documents(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for i, t in enumerate(texts):
            for w in re.findall(_WORD, (t or "").lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                out[i, h % self.size] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)

    def query(self, text: str) -> np.ndarray:
        return self.documents([text])[0]


def unit(v: Column) -> Column:
    """A vector of length one; a zero vector stays as it is."""
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.coalesce(F.nullif(size, F.lit(0.0)), F.lit(1.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine_topk(vectors: DataFrame, key: str, vector: str, wanted: Sequence[float], k: int) -> DataFrame:
    """``(key, score)`` of the ``k`` nearest by cosine, ties by key; ``k`` of zero or less, or no vectors, give none.

    Every executor keeps its own best ``k``; only those reach the driver.
    """
    q = np.asarray(wanted, float)
    n = float(np.linalg.norm(q)) or 1.0
    score = F.round(dot(unit(F.col(vector)), F.array(*(F.lit(float(x / n)) for x in q))), 6)
    return vectors.select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(max(k, 0))


def _best(ids: list, q: np.ndarray, key: str, vector: str, k: int, digits: int, own: bool):
    """A function over batches of vectors that gives the ``k`` nearest of each query in its task."""

    def best(batches):
        held = [(np.empty(0, "int64"), np.empty(0)) for _ in ids]
        for pdf in batches:
            if pdf.empty:
                continue
            v = np.asarray(pdf[vector].tolist(), float)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
            scores, keys = np.round(q @ v.T, digits), pdf[key].to_numpy()
            for i, query_id in enumerate(ids):
                s = scores[i]
                at = np.flatnonzero(s >= np.partition(s, -k - 1)[-k - 1]) if len(s) > k + 1 else np.arange(len(s))  # k, and the query itself
                if not own:
                    at = at[keys[at] != query_id]
                hits, of = np.concatenate((held[i][0], keys[at])), np.concatenate((held[i][1], s[at]))
                order = np.lexsort((hits, -of))[:k]
                held[i] = hits[order], of[order]
        found = [pd.DataFrame({"query_id": query_id, "hit_id": h, "score": s}) for query_id, (h, s) in zip(ids, held) if len(h)]
        if found:
            yield pd.concat(found)

    return best


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, digits: int = 9, own: bool = False, block: int = 1000) -> DataFrame:
    """``(query_id, hit_id, place, score)``: the ``k`` nearest of each query among all vectors, ties of the rounded score by key.

    Queries are sent to all vectors in blocks, so that neither the driver nor a task holds more than one;
    each task keeps the best ``k`` per query of the block. ``own``: whether a query may find itself.
    """
    kind = "query_id long, hit_id long, score double"
    rows, found, folder = queries.select(key, vector).toLocalIterator(), None, None
    part = list(islice(rows, block))
    while part:
        following = list(islice(rows, block))
        q = np.asarray([r[1] for r in part], float)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        found = vectors.select(key, vector).mapInPandas(_best([r[0] for r in part], q, key, vector, k, digits, own), kind)
        if following or folder:  # one block is left to the caller's plan
            folder = folder or f"{shared_dir(vectors.sparkSession)}/nearest-{uuid.uuid4().hex}"
            found.write.mode("append").parquet(folder)
        part = following
    if folder:
        found = vectors.sparkSession.read.schema(kind).parquet(folder)
    if found is None or k <= 0:
        found = vectors.sparkSession.createDataFrame([], kind)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("query_id", "hit_id", "place", "score")


def tfidf(docs: DataFrame, key: str, terms: Column, sublinear: bool = True, binary: bool = False, min_df: int = 1) -> DataFrame:
    """``(key, term, weight)`` with smooth idf and unit length: ln((1 + n) / (1 + df)) + 1; tf is 1 + ln(tf), tf or 1."""
    long = docs.select(F.col(key), F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("c"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))  # one row
    df = long.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    tf = F.lit(1.0) if binary else F.log("c") + 1 if sublinear else F.col("c").cast("double")
    w = long.join(df, "term").crossJoin(F.broadcast(n)).select(key, "term", (tf * (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1)).alias("w"))
    size = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    return w.join(size, key).select(key, "term", (F.col("w") / F.col("l")).alias("weight"))


def keyword_terms(text: Column) -> Column:
    """Lower-case words of any script without stop words, and the pairs of those that then follow one another."""
    w = F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0)), lambda t: ~t.isin(*STOP_WORDS))
    rest = F.greatest(F.size(w) - 1, F.lit(0))
    return F.concat(w, F.zip_with(F.slice(w, 1, rest), F.slice(w, 2, rest), lambda a, b: F.concat_ws(" ", a, b)))


def keyword_scores(docs: DataFrame, key: str, text: str, query: str) -> DataFrame:
    """``(key, score)``: cosine of sublinear TF-IDF vectors over words and pairs with the query's; documents without a term of it are left out."""
    words = docs.where(F.col(text).isNotNull())
    long = settle(words.select(key, F.explode(keyword_terms(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("c")), "postings")
    df = settle(long.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    n = words.count()
    idf = df.select("term", (F.log(F.lit(1.0 + n) / (F.col("df") + 1)) + 1).alias("idf"))
    asked = docs.sparkSession.createDataFrame([(query,)], "q string").select(F.explode(keyword_terms(F.col("q"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("qc"))
    wanted = F.broadcast(idf.join(F.broadcast(asked), "term").select("term", ((F.log("qc") + 1) * F.col("idf")).alias("q")))  # a row per term of the query
    size = wanted.agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("ql"))  # one row
    weighted = long.join(idf, "term").select(key, "term", ((F.log("c") + 1) * F.col("idf")).alias("w"))
    length = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    agg = weighted.join(wanted, "term").groupBy(key).agg(F.sum(F.col("w") * F.col("q")).alias("d")).join(length, key)
    return agg.crossJoin(F.broadcast(size)).select(key, F.round(F.col("d") / (F.col("l") * F.col("ql")), 6).alias("score"))


def ranked(scores: DataFrame, key: str, score: str, depth: int) -> DataFrame:
    """``(key, place)`` of the best ``depth``."""
    top = scores.orderBy(F.desc_nulls_last(score), key).limit(depth)
    return top.select(key, F.row_number().over(Window.orderBy(F.desc_nulls_last(score), key)).alias("place"))


def fuse(rankings: Sequence[DataFrame], key: str, k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion: ``(key, fused)``, the sum of 1 / (k + place) over the rankings that have the key."""
    every = rankings[0]
    for r in rankings[1:]:
        every = every.unionByName(r)
    return every.groupBy(key).agg(F.sum(F.lit(1.0) / (F.col("place") + k)).alias("fused"))


def refresh(current: DataFrame, indexed: DataFrame | None, key: str, text: str, embedder: Embedder) -> tuple[DataFrame, dict[str, int]]:
    """The index ``(key, text_hash, model, embedding)`` after new and changed texts are embedded and vanished keys dropped.

    What has the same hash and model is kept as it is.
    """
    now = current.select(key, F.coalesce(text, F.lit("")).alias("_t")).withColumns({"text_hash": F.sha2("_t", 256), "model": F.lit(embedder.name)})
    mark = [key, "text_hash", "model"]
    kept = indexed.join(now.select(*mark), mark, "left_semi") if indexed is not None else None
    todo = now.join(kept.select(key), key, "left_anti") if kept is not None else now

    def embed(batches):
        for pdf in batches:
            v = embedder.documents(pdf["_t"].tolist())
            if v.shape[1] != embedder.size:
                raise ValueError(f"{embedder.name} gave vectors of {v.shape[1]}, not {embedder.size}")
            yield pdf[mark].assign(embedding=list(v.astype("float32")))

    kind = dict(current.dtypes)[key]
    made = todo.mapInPandas(embed, f"{key} {kind}, text_hash string, model string, embedding array<float>")
    gone = indexed.join(now.select(key), key, "left_anti").count() if indexed is not None else 0
    stats = {"embedded": todo.count(), "kept": kept.count() if kept is not None else 0, "removed": gone}
    return (kept.select(*mark, "embedding").unionByName(made) if kept is not None else made), stats


def indexed_texts(index: DataFrame, current: DataFrame, key: str, text: str, embedder: Embedder) -> DataFrame:
    """The index of one model beside the current texts: ``(key, text, embedding)``; vectors of other models and of keys that are gone are left out.

    No vectors of this model is an error: the index must be built first.
    """
    own = index.where(F.col("model") == embedder.name)
    if own.isEmpty():
        raise LookupError(f"no vectors of {embedder.name}: build the index first")
    return own.select(key, "embedding").join(current.select(key, text), key)


def ask(index: DataFrame, current: DataFrame, key: str, text: str, embedder: Embedder, question: str, k: int = 10) -> DataFrame:
    """``(key, text, score)`` of the ``k`` records nearest to a question, best first; a blank question or ``k`` below one finds nothing."""
    have = indexed_texts(index, current, key, text, embedder)
    if not question.strip() or k < 1:
        return have.select(key, text, F.lit(0.0).alias("score")).limit(0)
    hits = cosine_topk(have, key, "embedding", list(embedder.query(question)), k)
    return hits.join(have.select(key, text), key).select(key, text, "score").orderBy(F.desc("score"), key)


def leaks(question: str, phrases: Sequence[str]) -> list[str]:
    """The words of an answer's phrases that stand in the question already: such a question tests no search."""
    asked = set(re.findall(_WORD, question.lower()))
    return sorted({w for p in phrases for w in re.findall(_WORD, p.lower())} & asked - set(STOP_WORDS))


def evaluate(rankings: DataFrame, answers: DataFrame, k: int = 5) -> DataFrame:
    """``(question, precision)``: of the first ``k`` hits, the share that belongs to the question's answers.

    ``rankings``: ``(question, key, place)``; ``answers``: ``(question, key)``. Fewer hits than ``k`` count as misses; a question without hits has 0.
    """
    good = rankings.where(F.col("place") <= k).join(answers.select("question", "key").distinct(), ["question", "key"]).groupBy("question").agg(F.count(F.lit(1)).alias("n"))
    return answers.select("question").distinct().join(good, "question", "left").select("question", (F.coalesce("n", F.lit(0)) / F.lit(k)).alias("precision"))
