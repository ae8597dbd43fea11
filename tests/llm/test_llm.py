"""Tokens, mixes, garbled texts and clusters: exact round trips and plain loops."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import rows_of, rows_of_sql
from pyspark.sql import functions as F

from tidewatch.llm import clusters, encodings, garbled, mixing, queries, tokens

ODD = ["", None, " ", "\n\n\n x", "a  b", "don't  we'll", "1234 56", "é naïve — “quotes”", "日本語 テスト", "  x", "<|endoftext|> is text", "x" * 5000, "= = ==", "\r\n\t\r\n", "🕵️‍♀️ 👍🏽", "a​b", "ا٣٤٥", "'S 'LL", "Ᲊ unassigned \U0001cd00", "tail "]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def reference(text):
    return tokens.encoding(tokens.VOCABULARY).encode_ordinary(text or "")


def test_ids_of_odd_texts(spark):
    df = docs(spark, ODD).unionByName(spark.createDataFrame([(0, ""), (None, "x y"), (None, "x y")], "doc_id long, text string"))
    got = sorted(((r["doc_id"], list(r["ids"])) for r in tokens.encode(df, "doc_id", "text").collect()), key=repr)
    assert got == sorted(((r["doc_id"], reference(r["text"])) for r in df.collect()), key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=40))
def test_ids_of_any_text(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode(docs(spark, texts), "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(texts)}


def test_sizes_are_the_numbers_of_ids(spark, monkeypatch):
    monkeypatch.setattr(tokens, "HOT_WORDS", 3)
    df = docs(spark, [*ODD, "one two two three three three", "two two one"]).withColumn("source", F.lit("s"))
    got = {r["doc_id"]: r["tokens"] for r in tokens.sizes(df, ["source", "doc_id"], "text").collect()}
    assert got == {r["doc_id"]: len(reference(r["text"])) for r in df.collect()}


def test_decoding_gives_the_texts_again(spark):
    back = tokens.decode(tokens.encode(docs(spark, ODD), "doc_id", "text"), "doc_id")
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(ODD)}
    assert tokens.encode(docs(spark, ODD).limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, data, name):
    assert rows_of(queries.QUERIES[name](spark, data)) == rows_of_sql(queries.SQL[name], data)


def test_word_join_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(tokens, "HOT_WORDS", 2)
    texts = ["one two three four", "two two one", "long" * 30]
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode(docs(spark, texts), "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(texts)}


def sized(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("aaaabbc"), i, rng.randrange(1, 400)) for i in range(n)]
    return spark.createDataFrame(rows, "source string, doc_id long, tokens long").withColumn("place", mixing.place(F.col("doc_id")))


def test_shares_and_caps(spark):
    s = sized(spark, 3000)
    total = {r["source"]: r["t"] for r in s.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    targets = spark.createDataFrame([("m", "A ", 1.0, None), ("m", "b", 1.0, 9), ("m", "c", 8.0, 2), ("m", "none", 1.0, 4), ("n", "a", 1.0, 1), ("m", None, 5.0, 1), ("m", "a", None, 1), ("n", "b", -1.0, 1)], "mix_name string, source string, target_weight double, max_repeats int")
    wanted = {(r["mix_name"], r["source"]): r for r in mixing.budgets(s, targets).collect()}
    assert set(wanted) == {("m", "a"), ("m", "b"), ("m", "c"), ("m", "none"), ("n", "a")}
    assert sum(r["share"] for k, r in wanted.items() if k[0] == "m") == pytest.approx(1)
    used = defaultdict(int)
    most = Counter()
    for r in mixing.mix(s, targets).collect():
        used[r["mix_name"], r["source"]] += r["tokens"] * r["times"]
        most[r["mix_name"], r["source"]] = max(most[r["mix_name"], r["source"]], r["times"])
    caps = {("m", "b"): 9, ("m", "c"): 2, ("n", "a"): 1}
    for k, r in wanted.items():
        limit = min(r["budget"], caps.get(k, 10**9) * total.get(k[1], 0))
        assert abs(used[k] - limit) <= 200, k  # half of the longest record
        assert most[k] <= caps.get(k, 10**9)
    assert used["m", "none"] == 0


def test_a_plan_too_large_to_broadcast(spark):
    s = sized(spark, 500)
    plan = spark.createDataFrame([(f"m{i}", x) for i in range(3) for x in "ab"], "mix_name string, source string")
    rows = lambda df: sorted((r["mix_name"], r["source"], r["doc_id"]) for r in df.collect())
    assert rows(mixing.spread(s, plan, most=2)) == rows(mixing.spread(s, plan))


def test_nested_and_repeatable(spark):
    s = sized(spark, 2000, 2)
    t = spark.createDataFrame([("small", "a", 1.0, 1), ("small", "b", 9.0, 1), ("large", "a", 5.0, 1), ("large", "b", 5.0, 1)], "mix_name string, source string, target_weight double, max_repeats int")
    pick = lambda: {(r["mix_name"], r["source"], r["doc_id"]) for r in mixing.mix(s, t).collect()}
    got = pick()
    assert got == pick()
    of = lambda m: {d for x, src, d in got if x == m and src == "a"}
    assert of("small") < of("large")
    assert mixing.mix(s.limit(0), t).count() == 0 and mixing.mix(s, t.limit(0)).count() == 0


@pytest.mark.parametrize("shift", [32, 16, 0])
def test_a_budget_that_ends_on_a_bucket_border(spark, shift):
    """A budget met exactly at any level keeps its records, with and without a whole use of the source."""
    at = lambda n: (5 << 32 if shift < 32 else 0) + (3 << 16 if shift < 16 else 0) + (n << shift)
    rows = [("a", 1, 6, at(1)), ("a", 2, 4, at(2)), ("b", 3, 4, at(1)), ("b", 4, 6, at(7))]
    s = spark.createDataFrame(rows, "source string, doc_id long, tokens long, place long")
    t = spark.createDataFrame([("m", "a", 3.0, None), ("m", "b", 7.0, None)], "mix_name string, source string, target_weight double, max_repeats int")
    got = {(r["source"], r["doc_id"]): r["times"] for r in mixing.mix(s, t).collect()}
    assert got == {("a", 1): 1, ("b", 3): 2, ("b", 4): 1}  # budgets of 6 and 14


CLEAN = ["Die Lücke betrifft Geräte größtenteils", "A vulnerabilidade não é segura após a atualização", "Уязвимость используется после входа", "The owner’s “desk” — 12–15 ms", "Złośliwe oprogramowanie łączyło się", "plain ascii only", "攻击者执行了 命令", "Ο εισβολέας εκτέλεσε την εντολή"]
CHAINS = [[("utf-8", "cp1252")], [("utf-8", "latin-1")], [("utf-8", "cp437")], [("utf-8", "cp1251")], [("utf-8", "mac_roman")], [("utf-8", "koi8_r")], [("utf-8", "cp1252"), ("utf-8", "cp1252")], [("cp1251", "cp1252")], [("cp1252", "mac_roman")], [("cp1250", "cp1252")], [("cp866", "cp1251")], [("iso8859_7", "cp1252")]]


def garble(text, chain):
    for written, read in chain:
        raw = encodings.written_in(text, written)
        if raw is None:
            return None
        text, lost = encodings.read_as(raw, read, encodings.KEEP)
        if lost:
            return None
    return text


def test_planted_garbling_is_found_and_restored(spark):
    rows = [(i, CLEAN[i % len(CLEAN)] + f" ref {i}") for i in range(400)]
    planted = {}
    for chain in CHAINS:
        for t in CLEAN:
            g = garble(t, chain)
            if g and g != t:
                i = 1000 + len(planted)
                planted[i] = (f"{t} 77 and {g} 1{i}", f"{t} 77 and {t} 1{i}")
    rows += [(i, g) for i, (g, _) in planted.items()] + [(5000, None), (5001, ""), (5002, "lost: owner�s"), (5002, "lost: owner�s"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in garbled.found(df, "doc_id", "text").collect()}
    assert got == set(planted) | {5002}
    back = {r["doc_id"]: r for r in garbled.restored(df, "doc_id", "text").collect()}
    whole = [i for i, (_, want) in planted.items() if back[i]["text"] == want and back[i]["nothing_lost"]]
    assert len(whole) >= 0.9 * len(planted)
    assert back[5002]["text"] == "lost: owner�s" and not back[5002]["nothing_lost"]
    assert garbled.found(df.limit(0), "doc_id", "text").count() == 0


def test_a_lossy_form_of_a_rare_word_is_no_evidence(spark):
    """Dropping a control character makes a common, clean word of a rare, garbled one."""
    wrong = garble("SÃO", [("mac_roman", "cp1252")])
    assert ("SÃO", False) in {(f, ok) for f, _, ok in encodings.garbled_forms(wrong)}
    rows = [(i, f"ESTAÇÕES SÃO {i}") for i in range(30)] + [(99, f"ESTAÇÕES {wrong} 99")]
    assert {r["doc_id"] for r in garbled.found(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()} == {99}


def test_digits_and_positions_survive_restoring(spark):
    rows = [(i, "entre 3–7 e 10–12 não") for i in range(20)] + [(99, garble("entre 31–75 e 100–129 não", [("utf-8", "cp1252")]))]
    [r] = garbled.restored(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert (r["doc_id"], r["text"], r["restored"]) == (99, "entre 31–75 e 100–129 não", 3)


def test_reading_back():
    for t in ("é", "naïve", "Привет", "日本"):
        for chain in CHAINS[:3]:
            if wrong := garble(t, chain):
                [run] = encodings.BEYOND.findall(wrong)
                assert encodings.BEYOND.findall(t)[0] in {r for r, _ in encodings.readings(run)}
    assert not list(encodings.readings("é")) and not list(encodings.readings("ção"))
    assert all(encodings.oddness(w) == 0 for w in ("é", "łączyło", "owner’s", "“desk”", "người", "Vault®")) and all(encodings.oddness(w) > 0 for w in ("Ã©", "Â£", "mo¿e", "óÿçâèìîñòü"))


def brute_pairs(features, least):
    sets = {h: frozenset(f) for h, f in features.items()}
    hosts = sorted(sets)
    head = {h: h for h in hosts}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, a in enumerate(hosts):
        for b in hosts[:i]:
            if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b]):
                head[top(a)] = top(b)
    groups = defaultdict(list)
    for h in hosts:
        groups[top(h)].append(h)
    return {(a, b) for g in groups.values() if len(g) >= least for a in g for b in g if a < b}


@pytest.mark.parametrize("seed", [1, 2])
def test_linked_clusters_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    feats = {}
    for f in range(8):
        base = [f"path=f{f}_{i}" for i in range(rng.randrange(2, 40))] + ["port=80", "tag=elf"]
        for h in range(rng.randrange(2, 14)):
            drop = rng.sample(base, rng.randrange(0, max(1, len(base) // 2)))
            feats[f"s{f}-{h}.example"] = (set(base) - set(drop)) | {f"path=r{rng.randrange(60)}" for _ in range(rng.randrange(4))} or {"port=80"}
    for i in range(40):
        feats[f"l{i}.example"] = {"port=80", f"path=r{rng.randrange(60)}", f"tag=t{rng.randrange(5)}"}
    df = spark.createDataFrame([(h, x) for h, s in feats.items() for x in s], "host string, feature string")
    hosts, table = clusters.profiles(df)
    celled = clusters.cells(table, k=6)
    got = [tuple(r) for r in clusters.pairs(clusters.linked(celled, hosts)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(feats, 5)
    elsewhere = celled.withColumn("cell", F.pmod(F.xxhash64("profile", F.lit(5)), F.lit(6)).cast("int"))
    far = lambda c: clusters.visits(c, clusters.prefixes(c)).where("to <> cell").count()
    assert far(celled) < far(elsewhere)  # k-means decides how many visits there are, not which pairs come out
    assert {tuple(r) for r in clusters.links(elsewhere).collect()} == {tuple(r) for r in clusters.links(celled).collect()}
    report = clusters.described(celled, hosts, 3).collect()
    assert sum({r["cell"]: r["members"] for r in report}.values()) == len(feats) and max(r["rank"] for r in report) <= 3


def test_server_features(spark):
    rows = [("http://H.example:8080/a/x.sh?q", None, [" ELF ", None, ""], 1), ("https://h.example", "h.example", None, 1), (None, "g.example", ["t"], 1), ("nonsense", "i.example", [], 1), ("nonsense", None, [], 1)]
    df = spark.createDataFrame(rows, "url string, host string, tags array<string>, feature int")
    got = defaultdict(set)
    for r in clusters.server_features(df).collect():
        got[r["host"]].add(r["feature"])
    assert got == {"h.example": {"path=x.sh", "path=(root)", "port=8080", "port=443", "tag=elf"}, "i.example": {"path=(root)"}}
    hosts, table = clusters.profiles(clusters.server_features(df.limit(0)))
    celled = clusters.cells(table)
    assert clusters.pairs(clusters.linked(celled, hosts)).count() == 0 and clusters.described(celled, hosts).count() == 0


def test_large_cluster_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(clusters, "PAIR_BLOCK", 8)
    df = spark.range(50).select(F.concat(F.lit("h"), F.col("id")).alias("host"), F.lit(1).alias("cluster"), F.lit(50).cast("long").alias("size"))
    got = [tuple(r) for r in clusters.pairs(df).collect()]
    assert len(got) == len(set(got)) == 50 * 49 // 2 and all(a < b for a, b in got)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0


def test_typical_members_of_linked_clusters(spark, data):
    """Sizes and nearest members of the clusters of p4_found, by plain loops."""
    sets = defaultdict(set)
    for r in clusters.server_features(spark.read.parquet(f"{data}/urlhaus_urls.parquet")).collect():
        sets[r["host"]].add(r["feature"])
    groups = defaultdict(set)
    for r in queries.p4_found(spark, data).collect():
        groups[r["host_a"]] |= {r["host_a"], r["host_b"]}
    groups = {a: g for a, g in groups.items() if a == min(g) and not any(a in other for b, other in groups.items() if b < a)}
    wanted = set()
    for name, g in groups.items():
        w = Counter(f for h in g for f in sets[h])
        far = {h: round(sum(((f in sets[h]) - n / len(g)) ** 2 for f, n in w.items()) ** 0.5, 6) for h in g}
        wanted |= {(name, len(g), i, h) for i, h in enumerate(sorted(g, key=lambda h: (far[h], h))[:5], 1)}
    got = queries.p4_typical(spark, data).collect()
    assert wanted and {(r["cluster"], r["members"], r["rank"], r["host"]) for r in got} == wanted and len(got) == len(wanted)


def test_short_passages_alone(spark):
    """Two characters are enough, and so is one document."""
    lone = ["Ã©", "Â£", "â€™", "cafÃ©", "Ã\xa0", "â€œ", "Ã¯", "Ã©Ã©", "‚Äô", "├⌐"]
    rows = [(i, f"à la carte é costs £{i} — the owner’s “café” is naïve") for i in range(20)] + [(100 + i, f"some {t} here") for i, t in enumerate(lone)]
    assert {r["doc_id"] for r in garbled.found(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()} == set(range(100, 100 + len(lone)))


EVEN = {
    "ru": ["Уязвимость используется после входа", "Вредоносная программа обнаружена", "Система была заражена"],
    "el": ["Ο εισβολέας εκτέλεσε την εντολή", "κακόβουλο λογισμικό βρέθηκε", "η ευπάθεια αυτή"],
    "pt": ["A vulnerabilidade não é segura após a atualização", "informação do usuário está disponível", "a invasão já começou"],
    "pl": ["Złośliwe oprogramowanie łączyło się z siecią", "może będzie wiadomość później", "użytkownik wysłał żądanie"],
    "zh": ["攻击者执行了 命令", "恶意软件 被发现", "服务器已经被感染"],
}


@pytest.mark.parametrize("lang, chain", [("pl", ("cp1250", "cp1252")), ("pl", ("iso8859_2", "cp1252")), ("ru", ("cp1251", "cp1252")), ("ru", ("cp1251", "koi8_r")), ("ru", ("koi8_r", "cp1251")), ("ru", ("cp866", "cp1251")), ("el", ("iso8859_7", "cp1252")), ("pt", ("cp1252", "mac_roman")), ("pt", ("mac_roman", "cp1252")), ("pt", ("cp1252", "cp437")), ("zh", ("gbk", "cp1252")), ("pt", ("utf-8", "gbk")), ("ru", ("utf-8", "cp1251"))])
def test_a_corpus_garbled_by_half(spark, lang, chain):
    """As many wrong copies as right ones: looks decide, not frequency."""
    rows = list(enumerate(EVEN[lang])) + [(100 + i, garble(t, [chain])) for i, t in enumerate(EVEN[lang])]
    assert {r["doc_id"] for r in garbled.found(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()} == {100, 101, 102}


def test_words_that_no_clean_text_has(spark):
    """A garbled word without a clean copy is cut into the forms of known characters."""
    rows = [(1, "não ação"), (2, "são lições"), (3, "攻击者执行了命令"), (4, "命令执行者攻击了"), (9, garble("poção", [("utf-8", "cp1252")])), (10, garble("执行命令者", [("gbk", "cp1252")])), (11, garble("poção", [("utf-8", "cp1252"), ("utf-8", "cp1252")]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in garbled.found(df, "doc_id", "text").collect()} == {9, 10, 11}
    assert {r["doc_id"]: r["text"] for r in garbled.restored(df, "doc_id", "text").collect()} == {9: "poção", 10: "执行命令者", 11: "poção"}


def test_common_clean_words_stay_clean(spark):
    """A reverse chain makes a common, clean word of a rare, garbled one; box drawing is no text."""
    rows = [(i, f"the week… of “the header” takes 5µs at ├┤ with ô and Windows® {i}") for i in range(60)] + [(100 + i, garble("week… “the header” 5µs", [("cp1252", "cp850")])) for i in range(2)]
    got = {r["doc_id"] for r in garbled.found(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert not {d for d in got if d < 100}
