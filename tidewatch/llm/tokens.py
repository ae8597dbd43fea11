"""A corpus as ids of a public tokenizer, through a table of its distinct words.

Texts are split into words in the JVM. Every distinct word is encoded once. The ids are
joined back by position: a text's words are looked up among the commonest short ones, which are
sent to every task (a bounded table), and each distinct word that isn't among them is
left as a number; only these rare words, once per text, are joined with the word table by a
shuffle. So no hot word meets in one task, and texts whose words are all common aren't moved. The vocabulary files are read
from a path that every executor must have; they are never copied.

Null, empty and only such texts have no ids: an empty list.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.storage import discard, settle, tasks

#: Where the public vocabularies lie.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern with which this vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that are sent to every task, and the most characters one of them has: at most some 20 MB.
HOT_WORDS, HOT_LENGTH = 50_000, 32


@lru_cache(maxsize=2)
def encoding(path: str):
    """The encoder of a rank file, once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def words_of(text: Column) -> Column:
    """The words of a text, in order; together they are the text.

    A text with characters that this JVM's Unicode tables don't know is one
    word; the encoder splits it by its own tables.
    """
    split = F.regexp_extract_all(text, F.lit("(?U)" + PATTERN), F.lit(0))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).when(text.rlike(r"\p{Cn}"), F.array(text)).otherwise(split)


def word_ids(words: DataFrame, path: str) -> DataFrame:
    """``(word, n)`` with each word's ids."""

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for pdf in batches:
            yield pdf.assign(ids=[enc.encode_ordinary(w) for w in pdf["word"]])

    return words.repartition(tasks(words.sparkSession), "word").mapInPandas(ids, "word string, n long, ids array<int>")


def _met(batch: pa.RecordBatch, vocabulary: pa.Array) -> tuple[int, np.ndarray, np.ndarray, pa.Array]:
    """Of a batch of texts' words: the number of texts, each word's text, its place in ``vocabulary`` (-1 for rare words), and the rare words."""
    lists = batch.column(batch.schema.get_field_index("_words"))
    doc = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    at = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return len(lists), doc, at, words.filter(pa.array(at < 0))


def _lists(n: int, doc: np.ndarray, values: pa.Array) -> pa.ListArray:
    """``values``, which lie in the order of their texts (``doc``), as a list for each of ``n`` texts."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)), values)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = [(f.name, batch.column(i)) for i, f in enumerate(batch.schema) if f.name != "_words"] + list(columns.items())
    return pa.RecordBatch.from_arrays([c for _, c in kept], names=[n for n, _ in kept])


def _ids_of(hot):
    """Over batches of texts' words: the ids of the hot words, and ``-k`` for the text's ``k``-th distinct other word; whole batches at a time."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sizes, flat = hot.value
        vocabulary, size, ids = pa.array(words, pa.string()), np.append(sizes, 1), np.append(flat, 0)
        start = np.append(np.cumsum(sizes) - sizes, len(flat))
        for batch in batches:
            n, doc, at, rare = _met(batch, vocabulary)
            length = size[at]  # a rare word (-1) is one number
            end = np.cumsum(length)
            total = int(end[-1]) if len(end) else 0
            out = ids[np.repeat(start[at] - (end - length), length) + np.arange(total)].astype(np.int32)
            named = rare.dictionary_encode()
            of = doc[at < 0]
            known, which = np.unique(of * max(len(named.dictionary), 1) + named.indices.to_numpy(zero_copy_only=False), return_inverse=True)
            owner, code = known // max(len(named.dictionary), 1), known % max(len(named.dictionary), 1)
            first = np.cumsum(np.bincount(owner, minlength=n)) - np.bincount(owner, minlength=n)
            number = np.arange(len(known)) - first[owner] + 1 if len(known) else known
            out[(end - length)[at < 0]] = -number[which]
            yield _with(batch, _ids=_lists(n, np.repeat(doc, length), pa.array(out)), _rare=_lists(n, owner, named.dictionary.take(pa.array(code)).cast(pa.string())))

    return look


def _sizes_of(hot):
    """Over batches of texts' words: how many ids the hot words have, and all other words."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sizes, _ = hot.value
        vocabulary, size = pa.array(words, pa.string()), np.append(sizes, 0)
        for batch in batches:
            n, doc, at, rare = _met(batch, vocabulary)
            yield _with(batch, _n=pa.array(np.bincount(doc, weights=size[at], minlength=n).astype(np.int64)), _rare=_lists(n, doc[at < 0], rare))

    return look


def _looked_up(docs: DataFrame, columns: Sequence[str], text: str, path: str, look, kind: str) -> tuple[DataFrame, DataFrame, list[Column]]:
    """What ``look`` makes of each text's words (``kind``) with its row's number and ``columns``; the table of words; the columns by their names."""
    own = {f"_k{i}": F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)}
    kept = docs.select(F.monotonically_increasing_id().alias("_row"), *own.values(), words_of(F.col(text)).alias("_words"))
    split = settle(kept, "words")
    counted = split.select(F.explode("_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    table = settle(word_ids(counted, path), "word-ids")
    hot = table.where(F.length("word") <= HOT_LENGTH).orderBy(F.desc("n"), "word").limit(HOT_WORDS).select("word", "ids").collect()
    table_of = ([r["word"] for r in hot], np.array([len(r["ids"]) for r in hot], np.int64), np.array([i for r in hot for i in r["ids"]], np.int64))
    known = docs.sparkSession.sparkContext.broadcast(table_of)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    coded = settle(split.mapInArrow(look(known), f"{kinds}, {kind}, _rare array<string>"), "coded")
    discard(split)
    return coded, table, [F.col(k).alias(c) for k, c in zip(own, columns)]


def encode(docs: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``(key, ids)`` with a row for every row of ``docs``; repeated and null keys keep their own rows."""
    coded, table, named = _looked_up(docs, [key], text, path, _ids_of, "_ids array<int>")
    some = F.size("_rare") > 0
    asked = coded.where(some).select("_row", F.posexplode("_rare").alias("_at", "word"))
    answered = asked.join(table.select("word", "ids"), "word").groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "ids"))), lambda x: x["ids"]).alias("_found"))
    filled = F.flatten(F.transform("_ids", lambda i: F.when(i < 0, F.element_at("_found", -i)).otherwise(F.array(i))))
    done = coded.where(~some).select(*named, F.col("_ids").alias("ids"))
    return done.unionByName(coded.where(some).drop("_rare").join(answered, "_row").select(*named, filled.alias("ids")))


def sizes(docs: DataFrame, columns: Sequence[str], text: str, path: str = VOCABULARY) -> DataFrame:
    """``(columns..., tokens)`` with a row for every row of ``docs``: how many ids its text has, from the same table of words."""
    coded, table, named = _looked_up(docs, columns, text, path, _sizes_of, "_n long")
    rare = coded.select("_row", F.explode("_rare").alias("word")).join(table.select("word", F.size("ids").alias("_m")), "word").groupBy("_row").agg(F.sum("_m").alias("_m"))
    return coded.drop("_rare").join(rare, "_row", "left").select(*named, (F.col("_n") + F.coalesce("_m", F.lit(0))).alias("tokens"))


def pieces(spark: SparkSession, path: str = VOCABULARY) -> DataFrame:
    """``(id, piece)``: each id's bytes in hexadecimal; as many rows as the vocabulary has."""
    with open(path, "rb") as f:
        rows = [(int(b), base64.b64decode(a).hex()) for a, b in (line.split() for line in f if line.strip())]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["id", "piece"]).astype({"id": "int32"}), "id int, piece string")


def decode(encoded: DataFrame, key: str, path: str = VOCABULARY) -> DataFrame:
    """``(key, text)`` of ``(key, ids)`` through a join of ids with their pieces; no ids give the empty text."""
    rows = settle(encoded.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), "ids"), "ids")
    at = rows.select("_row", "_key", F.posexplode_outer("ids").alias("_pos", "id"))
    joined = at.join(F.broadcast(pieces(encoded.sparkSession, path)), "id", "left")
    hexed = joined.groupBy("_row", "_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "piece"))), lambda p: F.coalesce(p["piece"], F.lit(""))), "").alias("_hex"))
    return hexed.select(F.col("_key").alias(key), F.decode(F.unhex("_hex"), "UTF-8").alias("text"))
