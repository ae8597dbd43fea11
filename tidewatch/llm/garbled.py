"""Texts read in the wrong character encoding: found, and restored where nothing was lost.

The form table: every distinct clean word of the corpus with a character beyond
ASCII, and every character of those words that two documents have, is put through all chains
of wrong readings. The distinct tokens of the documents are joined with it by
hash, whole, or cut into the characters that a chain would have made (``encodings.readings``);
documents meet only the few garbled ones. Words are compared with every run of
digits as one ``0``.

A form and its original both stand in the corpus; which of them is the wrong one is decided by what they look like
(``encodings.oddness``): wrong readings leave signs, mixed scripts and rows of accented letters. A form by a chain that starts
from UTF-8 and loses nothing counts at any length and frequency if it looks odder than its original, or is a whole word;
by any other chain, each point that it looks odder outweighs a factor of two in frequency.
A form that looks no odder counts if its chain has given odd forms elsewhere in the corpus, its reverse hasn't, and the original is no rarer; or
if the original stands in ``RATIO`` times as many documents. U+FFFD is always evidence.
Null and empty texts aren't garbled; repeated documents are found each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import encodings as enc
from tidewatch.storage import settle, tasks

#: How many times as common the original of a form must be that neither its looks nor its chain decides.
RATIO = 2
#: Odd forms that a chain must have given before it decides about forms that look as plain as their originals.
VOTES = 3
_TOKENS = r"(?<![0-9A-Za-z\x{80}-\x{10ffff}])[0-9A-Za-z]*+[\x{80}-\x{10ffff}][0-9A-Za-z\x{80}-\x{10ffff}]*+"
_LOOKS = "tok string, n long, odd int, scripts string, clean boolean, read array<struct<text: string, odd: int, chain: string, pieces: array<string>>>"
_FORMS = "tok string, original string, n_original long, odd_original int, scripts_original string, is_char boolean, chain string, lossless boolean"


def document_tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, h, tok)``: each document's distinct tokens beyond ASCII; ``h`` tells its text."""
    t = F.col(text)
    toks = F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(_TOKENS), F.lit(0)), lambda x: F.regexp_replace(x, "[0-9]+", "0")))
    return docs.where(t.rlike(r"[^\x00-\x7f]")).select(F.col(key).alias("key"), F.xxhash64(t, F.length(t)).alias("h"), F.explode(toks).alias("tok"))


def _read_back(tok: str, odd: int) -> list[dict]:
    """What a token may have been, chain by chain, with the forms of the characters that each would have garbled."""
    runs = set(enc.BEYOND.findall(tok))
    by_chain: dict[str, dict[str, str]] = {}
    for run in runs:
        for text, chain in enc.readings(run):
            by_chain.setdefault(chain, {})[run] = text
    out = []
    for chain, back in by_chain.items():
        text = enc.BEYOND.sub(lambda m, back=back: back.get(m.group(), m.group()), tok)
        pieces = {enc.forward(c, chain) for t in back.values() for c in t}
        if None not in pieces and (looks := enc.oddness(text)) < odd:
            out.append({"text": text, "odd": looks, "chain": chain, "pieces": sorted(pieces)})
    return out


def _looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for tok, n in zip(pdf["tok"], pdf["n"]):
            odd = enc.oddness(tok)
            read = _read_back(tok, odd) if "�" not in tok and odd else []
            rows.append((tok, n, odd, enc.scripts(tok), "�" not in tok and not any(r["chain"].startswith("utf-8>") for r in read), read))
        yield pd.DataFrame(rows, columns=["tok", "n", "odd", "scripts", "clean", "read"])


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(form, *src, chain, ok) for src in pdf.itertuples(index=False, name=None) for form, chain, ok in enc.garbled_forms(src[0])]
        yield pd.DataFrame(rows, columns=["tok", "original", "n_original", "odd_original", "scripts_original", "is_char", "chain", "lossless"])


def form_table(words: DataFrame) -> DataFrame:
    """The forms of all clean ``words`` and of the characters that stand in at least two documents."""
    clean = words.where("clean")
    whole = clean.select(F.col("tok").alias("original"), F.col("n").alias("n_original"), F.col("odd").alias("odd_original"), F.col("scripts").alias("scripts_original"), F.lit(False).alias("is_char"))
    chars = clean.select("n", "scripts", F.explode(F.array_distinct(F.split("tok", ""))).alias("original")).where(r"original rlike '[^\\x00-\\x7f]'")
    chars = chars.groupBy("original").agg(F.sum("n").alias("n_original"), F.min(F.when(~F.col("scripts").contains(" "), F.col("scripts"))).alias("_s")).where("n_original > 1")
    sources = whole.unionByName(chars.select("original", "n_original", F.lit(0).alias("odd_original"), F.coalesce("_s", F.lit("")).alias("scripts_original"), F.lit(True).alias("is_char")))
    return sources.repartition(tasks(words.sparkSession), "original").mapInPandas(_forms, _FORMS)


def _strong(hits: DataFrame) -> DataFrame:
    """``hits`` with ``strong``: whether the form alone shows that its document is garbled."""
    utf8 = F.col("chain").startswith("utf-8>") & F.col("lossless")
    long_enough = (F.length("tok") > 2) | ((F.length("tok") == 2) & F.col("tok").rlike("[\\x00-\\x7f]"))
    boxes = F.col("tok").rlike("^[\\x{2500}-\\x{259f}]+$")  # lines of tables and bars
    odder, level = F.col("odd") > F.col("odd_original"), F.col("odd") == F.col("odd_original")
    pair = F.split("chain", ">")
    # a row per chain: as many as the chains are
    votes = hits.where(~utf8 & F.col("lossless") & odder & (F.length("tok") > 3)).groupBy("chain").agg(F.count(F.lit(1)).alias("votes"))
    against = votes.where("size(split(chain, '>')) = 2").select(F.concat_ws(">", pair[1], pair[0]).alias("chain"), F.col("votes").alias("against"))
    h = hits.join(F.broadcast(votes), "chain", "left").join(F.broadcast(against), "chain", "left").na.fill(0, ["votes", "against"])
    voted = F.col("lossless") & (F.length("tok") > 3) & (F.col("n_original") >= F.col("n")) & (F.col("votes") >= VOTES) & (F.col("votes") > 2 * F.col("against"))
    plain = F.when(utf8, ((~F.col("is_char") | F.col("tok").rlike(r"[^\p{L}]")) & (F.length("tok") > 2)) | (F.col("scripts").isin(F.col("scripts_original"), F.lit("")) & (F.col("n_original") >= F.col("n")))).otherwise(~F.col("is_char") & long_enough & (voted | (F.col("n_original") >= RATIO * F.col("n"))))
    # bytes of another encoding that are valid UTF-8 are a garbled text put right; what loses something counts by frequency
    repaired = F.col("chain").endswith(">utf-8")
    common = ~F.col("is_char") & long_enough & (F.col("n_original") >= RATIO * F.col("n"))
    sure = F.when(repaired, ~odder & common & ~F.col("lossless")).when(odder, utf8 | (~F.col("is_char") & long_enough & (F.col("n_original") * F.pow(F.lit(2.0), F.col("odd") - F.col("odd_original")) >= F.col("n")))).when(level & ~(boxes & (F.length("tok") < 3)), plain).otherwise(F.lit(False))
    return h.withColumn("strong", sure).drop("votes", "against")


def garbled_tokens(tokens: DataFrame) -> DataFrame:
    """``(tok, original, n_original, chain, lossless, strong)`` of the distinct tokens that are garbled forms, the likeliest original of each.

    Not ``strong`` are forms that are only restored, and only in a document that has evidence of the same chain.
    """
    counted = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    words = settle(counted.repartition(tasks(tokens.sparkSession), "tok").mapInPandas(_looks, _LOOKS), "vocabulary")
    # what a token could have been: a form as a whole, or the forms of some characters one after the other
    cut = words.select("tok", F.explode("read").alias("r")).select("tok", "r.text", "r.chain", F.size("r.pieces").alias("need"), F.explode("r.pieces").alias("piece"))
    wanted = words.select("tok", F.col("tok").alias("piece"), F.lit(None).cast("string").alias("by"), F.lit(None).cast("string").alias("text"), F.lit(1).alias("need")).unionByName(cut.select("tok", "piece", F.col("chain").alias("by"), "text", "need"))
    forms = form_table(words).withColumnRenamed("tok", "piece")
    # the forms are some hundred times what their size is guessed from: never broadcast
    met = settle(forms.hint("merge").join(wanted.hint("merge"), "piece").where("by is null or (is_char and lossless and by = chain)"), "forms-met")
    looks = words.select("tok", "n", "odd", "scripts")
    whole = _strong(met.where("by is null").drop("piece", "by", "text", "need").join(looks, "tok"))
    parts = met.where("by is not null").groupBy("tok", "text", "chain", "need").agg(F.countDistinct("piece").alias("got"), F.min("n_original").alias("n_original")).where("got = need")
    parts = parts.select("tok", F.col("text").alias("original"), "n_original", "chain", F.lit(True).alias("lossless"), F.lit(True).alias("strong"), F.lit(0).alias("word"))
    likely = F.col("strong") | (F.col("n_original") >= RATIO * F.col("n"))
    every = whole.where(likely).select("tok", "original", "n_original", "chain", "lossless", "strong", (~F.col("is_char")).cast("int").alias("word")).unionByName(parts)
    best = every.groupBy("tok").agg(F.max(F.struct("strong", "lossless", "word", "n_original", "original", "chain")).alias("b"))
    return settle(best.select("tok", "b.original", "b.n_original", "b.chain", "b.lossless", "b.strong"), "garbled")


def found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The ``key`` of each document that holds garbled text, once."""
    tokens = settle(document_tokens(docs, key, text), "tokens")
    garbled = garbled_tokens(tokens).where("strong").select("tok")
    lost = tokens.where(F.col("tok").contains("�")).select("key")
    return tokens.join(garbled, "tok", "left_semi").select("key").unionByName(lost).distinct().select(F.col("key").alias(key))


def _restore(text: pd.Series, tokens: pd.Series) -> pd.DataFrame:
    rows = []
    for t, pairs in zip(text, tokens):
        table = {p["tok"]: p["original"] for p in pairs if p["lossless"]}
        count = {"restored": 0, "lost": 0}

        def back(m):
            word = m.group()
            digits = enc.DIGITS.findall(word)
            original = table.get(enc.DIGITS.sub("0", word))
            if original is None:
                count["lost"] += "�" in word
                return word
            slots = enc.DIGITS.findall(original)
            if len(slots) != len(digits):
                return word
            count["restored"] += 1
            again = iter(digits)
            return enc.DIGITS.sub(lambda _: next(again), original)

        rows.append((enc.TOKEN.sub(back, t), count["restored"], count["lost"]))
    return pd.DataFrame(rows, columns=["text", "restored", "lost"])


def restored(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each garbled document as ``(key, text, restored, lost, nothing_lost)``.

    Tokens whose chain lost nothing are replaced by their originals (``restored`` counts them); others stay as they are.
    """
    tokens = settle(document_tokens(docs, key, text), "tokens")
    garbled = garbled_tokens(tokens)
    hit = tokens.join(garbled, "tok")
    broken = tokens.where(F.col("tok").contains("�")).select("h", F.lit(None).cast("string").alias("tok"), F.lit(None).cast("string").alias("original"), F.lit(None).cast("string").alias("chain"), F.lit(False).alias("lossless"), F.lit(True).alias("strong"))
    per = (
        hit.select("h", "tok", "original", "chain", "lossless", "strong").unionByName(broken).distinct()
        .groupBy("h").agg(F.collect_list(F.struct("tok", "original", "chain", "lossless", "strong")).alias("all"), F.collect_set(F.when(F.col("strong"), F.col("chain"))).alias("chains"), F.max("strong").alias("any_strong"), F.min("lossless").alias("nothing_lost"))
        .where("any_strong")
        .select("h", "nothing_lost", F.filter("all", lambda x: x["tok"].isNotNull() & (x["strong"] | F.array_contains("chains", x["chain"]))).alias("pairs"))
    )
    restore = F.pandas_udf(_restore, "struct<text: string, restored: long, lost: long>")
    t = F.col(text)
    rows = docs.where(t.isNotNull()).select(F.col(key).alias("key"), t.alias("_text"), F.xxhash64(t, F.length(t)).alias("h")).join(per, "h")
    return rows.select(F.col("key").alias(key), restore("_text", "pairs").alias("r"), "nothing_lost").select(key, "r.text", "r.restored", "r.lost", "nothing_lost")
