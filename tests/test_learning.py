"""Clusters, classifier, anomalies, search: planted cases and plain numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.ml import dbscan, logit, metrics, runs, search, sessions
from tidewatch.operators import ranking
from tidewatch.operators.components import components
from tidewatch.plans import relational


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    head = {}

    def top(x):
        while head.setdefault(x, x) != x:
            x = head[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        head[y] = x
    want = {}
    for x in head:
        want.setdefault(top(x), set()).add(x)
    got = {}
    for r in components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect():
        got.setdefault(r["component"], set()).add(r["node"])
    assert got == {min(v): v for v in want.values()}


def brute_dbscan(sets, eps, least):
    keys = sorted(sets)
    terms = sorted({t for s in sets.values() for t in s})
    n = len(keys)
    df = {t: sum(t in s for s in sets.values()) for t in terms}
    m = np.array([[(np.log((1 + n) / (1 + df[t])) + 1) if t in sets[k] else 0.0 for t in terms] for k in keys])
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    near = m @ m.T >= 1 - eps - 1e-12
    core = near.sum(1) >= least
    label, todo = {}, 0
    for i in range(n):
        if core[i] and i not in label:
            todo += 1
            stack = [i]
            while stack:
                j = stack.pop()
                if j not in label:
                    label[j] = todo
                    stack += [k for k in range(n) if core[k] and near[j, k] and k not in label]
    for i in range(n):
        if i not in label:
            cores = [j for j in range(n) if core[j] and near[i, j]]
            label[i] = label[min(cores, key=lambda j: keys[j])] if cores else -1
    groups = {}
    for i, c in label.items():
        if c != -1:
            groups.setdefault(c, []).append(keys[i])
    ranked = sorted(groups.values(), key=lambda g: (-len(g), min(g)))
    out = {k: -1 for k in keys}
    for c, g in enumerate(ranked, 1):
        out |= {k: c for k in g}
    return out


def test_dbscan_against_numpy(spark):
    rng = random.Random(4)
    sets = {}
    for f in range(6):
        base = [f"p{f}_{i}" for i in range(5)] + ["port=80"]
        for h in range(rng.randrange(3, 9)):
            sets[f"f{f}h{h}"] = sorted(set(base) - {rng.choice(base)} | ({f"x{rng.randrange(40)}"} if rng.random() < 0.5 else set()))
    for i in range(20):
        sets[f"lone{i:02}"] = ["port=80", f"y{rng.randrange(30)}", f"z{rng.randrange(30)}"]
    df = spark.createDataFrame(list(sets.items()), "host string, tokens array<string>")
    assert {r["host"]: r["cluster"] for r in dbscan.dbscan(df).collect()} == brute_dbscan(sets, dbscan.EPS, dbscan.LEAST)
    assert {r["cluster"] for r in dbscan.dbscan(df.limit(4)).collect()} == {-1}


def test_classifier_and_watch_list(spark):
    rows = [(f"c{i}", f"2024-01-{1 + i % 28:02}" if i < 60 else f"2025-01-{1 + i % 28:02}", ("ransom locker encrypts files" if i % 3 == 0 else "browser memory bug crash") + f" w{i % 4}", int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, day string, text string, y int").withColumn("day", F.to_date("day"))
    q, model = logit.evaluate_temporal(df, "text", "y", "day", "2025-01-01")
    r = q.first()
    assert r["average_precision"] == r["roc_auc"] == 1.0 and abs(r["lift"] - 3) < 1e-6 and r["n_test"] == 30
    oof = logit.out_of_fold(df, "text", "y", "id", k=3)
    assert oof.count() == 90
    watch = logit.watch_list(model.score(df), "y", "day", "2025-01-01", "id")
    assert watch.where("on_watchlist").count() == 20 and watch.where("watchlist_rank is null").count() == 70
    try:
        logit.evaluate_temporal(df.where("y = 0"), "text", "y", "day", "2025-01-01")
        raise AssertionError
    except ValueError:
        pass
    assert metrics.fold_count(1) == 2 and metrics.fold_count(3) == 3 and metrics.fold_count(50) == 5


def test_planted_sessions_rank_first(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        rows.append((f"b{i:03}", "100.64.0.1", None, "telnet" if rng.random() < 0.2 else "ssh", True, int(rng.poisson(3)) + 1, 1, 1, 0, 0, float(rng.uniform(2, 10)), False, "common", None))
    for i in range(5):
        rows.append((f"x{i}", "100.64.0.2", None, "ssh", True, 200, 50, 90, 60 + i, 9, 4000.0, True, f"rare{i}", f"cmd{i}"))
    rows.append(("open", "100.64.0.3", None, "ssh", False, 900, 90, 90, 90, 90, 90.0, True, "r", "c"))
    df = spark.createDataFrame(rows, "session_id string, src_ip string, started_at timestamp, protocol string, is_closed boolean, login_attempts int, distinct_usernames int, distinct_passwords int, commands_run int, downloads int, duration_seconds double, login_succeeded boolean, hassh string, first_command string")
    got = sessions.anomalies(df, trees=100).orderBy("anomaly_rank").collect()
    assert [r["anomaly_rank"] for r in got] == list(range(1, 406)) and {r["session_id"] for r in got[:5]} == {f"x{i}" for i in range(5)}
    flagged = [r for r in got if r["is_flagged"]]
    assert 1 <= len(flagged) <= 8 and all(r["reasons"] for r in flagged) and not any(r["reasons"] for r in got if not r["is_flagged"])
    assert sessions.anomalies(df.limit(150), trees=10) is None
    assert all("usual" in r["reasons"] or "of all sessions" in r["reasons"] for r in flagged) and all(r["reasons"].count(";") < 3 for r in got)
    assert sessions.stability(sessions.features(df), k=5) >= 0.9  # five seeds, all trees


def test_incremental_index(spark):
    e = search.HashedWords(64)
    df = lambda *r: spark.createDataFrame(list(r), "id string, t string")
    one, stats = search.refresh(df(("a", "exchange server flaw"), ("b", "vpn gateway"), ("c", None)), None, "id", "t", e)
    one = spark.createDataFrame(one.collect(), one.schema)
    assert stats == {"embedded": 3, "kept": 0, "removed": 0}
    same, stats = search.refresh(df(("a", "exchange server flaw"), ("b", "vpn gateway"), ("c", None)), one, "id", "t", e)
    assert stats == {"embedded": 0, "kept": 3, "removed": 0} and same.count() == 3
    two, stats = search.refresh(df(("a", "exchange server flaw"), ("b", "another text")), one, "id", "t", e)
    assert stats == {"embedded": 1, "kept": 1, "removed": 1} and two.count() == 2
    _, stats = search.refresh(df(("a", "exchange server flaw")), one, "id", "t", search.HashedWords(32))
    assert stats["embedded"] == 1
    hits = search.cosine_topk(one, "id", "embedding", list(e.query("server exchange")), 2).collect()
    assert hits[0]["id"] == "a" and search.cosine_topk(one, "id", "embedding", list(e.query("x")), 0).count() == 0


def test_runs(spark, tmp_path):
    r = runs.Runs(spark, str(tmp_path / "runs"))
    with r.run("e") as x:
        x.param(k=1)
        x.metric(a=0.5, b=None, c=float("nan"))
    try:
        with r.run("e"):
            raise RuntimeError("no")
    except RuntimeError:
        pass
    [row] = r.newest().collect()
    assert row["metrics"] == {"a": 0.5} and r.table.read().count() == 2


def test_nearest_in_blocks(spark):
    """Several blocks of queries and several tasks give what plain numpy gives, ties by key."""
    v = np.random.default_rng(5).integers(-2, 3, (300, 4)).astype(float)  # few directions: many ties
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    queries = vectors.where("id % 10 = 0")
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    for own in (False, True):
        wanted = set()
        for q in range(0, 300, 10):
            scores = np.round(u @ u[q], 9)
            hits = [i for i in np.lexsort((np.arange(300), -scores)) if own or i != q][:5]
            wanted |= {(q, int(i), place) for place, i in enumerate(hits, 1)}
        for block in (7, 1000):
            got = search.nearest(queries, vectors, "id", "v", 5, own=own, block=block).collect()
            assert {(r["query_id"], r["hit_id"], r["place"]) for r in got} == wanted and len(got) == 150
    assert search.nearest(queries.where("id < 0"), vectors, "id", "v", 5).count() == 0


def test_searches_take_every_hundredth_vector(spark, data):
    n = spark.read.parquet(f"{data}/embeddings.parquet").where("vec_id % 100 = 0").count()
    assert relational.QUERIES["precision_at_k"](spark, data).count() == n
    assert relational.QUERIES["vector_topk"](spark, data).groupBy("query_id").count().where("count = 10").count() == n


def test_asking_the_index_and_judging_it(spark):
    e = search.HashedWords(64)
    current = spark.createDataFrame([("a", "exchange server flaw"), ("b", "vpn gateway")], "id string, t string")
    index, _ = search.refresh(spark.createDataFrame([("a", "exchange server flaw"), ("b", "vpn gateway"), ("gone", "exchange")], "id string, t string"), None, "id", "t", e)
    assert [(r["id"], r["t"]) for r in search.ask(index, current, "id", "t", e, "exchange server", 1).collect()] == [("a", "exchange server flaw")]
    assert search.ask(index, current, "id", "t", e, "  ").count() == 0
    with pytest.raises(LookupError):
        search.indexed_texts(index, current, "id", "t", search.HashedWords(32))
    assert search.leaks("Which mail server is broken?", ["exchange server"]) == ["server"]
    ranks = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "question string, key string, place int")
    answers = spark.createDataFrame([("q", "a"), ("q", "c"), ("none", "x")], "question string, key string")
    assert {tuple(r) for r in search.evaluate(ranks, answers, 2).collect()} == {("q", 0.5), ("none", 0.0)}


def test_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(v)) for v in rng.integers(0, 50, 300)] + [("b", 1.5), ("c", None), (None, 2.0), (None, 4.0)]
    got = {r["g"]: r["values"] for r in ranking.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", (0.0, 0.25, 0.5, 0.99, 1.0)).collect()}
    assert set(got) == {"a", "b", None} and got["b"] == [1.5] * 5 and got[None][2] == 3.0
    assert np.allclose(got["a"], np.quantile([v for g, v in rows if g == "a"], (0, 0.25, 0.5, 0.99, 1)))
    one = ranking.quantiles(spark.createDataFrame(rows, "g string, v double"), [], "v", (0.5,)).first()["values"][0]
    assert one == np.median([v for _, v in rows if v is not None])


def test_numbers_over_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.lit(1).alias("_tw_at"))  # a column that clashes with the operator's own
    got = [(r["k"], r["id"]) for r in ranking.numbered(df, [F.desc("k"), F.col("id")], "n").orderBy("n").collect()]
    assert got == sorted(((i % 7, i) for i in range(1000)), key=lambda r: (-r[0], r[1])) and ranking.numbered(df.limit(0), [F.col("id")], "n").count() == 0


def plain_probabilities(train, test):
    """The classifier by plain numpy: terms of two texts and more, sublinear TF-IDF of unit length, Newton's method on the same objective."""
    import re

    def terms(t):
        w = re.findall(r"\b\w\w+\b", t.lower())
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    df = {}
    for t, _ in train:
        for g in set(terms(t)):
            df[g] = df.get(g, 0) + 1
    names = sorted(g for g, n in df.items() if n >= 2)
    at, n = {g: i for i, g in enumerate(names)}, len(train)
    idf = np.array([np.log((1 + n) / (1 + df[g])) + 1 for g in names])

    def matrix(rows):
        x = np.zeros((len(rows), len(names)))
        for i, (t, _) in enumerate(rows):
            for g in terms(t):
                if g in at:
                    x[i, at[g]] += 1
        x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * idf
        return np.hstack([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.ones((len(rows), 1))])

    x, y = matrix(train), np.array([v for _, v in train], float)
    s = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    w, ridge = np.zeros(x.shape[1]), np.append(np.full(len(names), 1 / n), 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (s * (p - y)) / s.sum() + ridge * w
        hess = (x * (s * p * (1 - p))[:, None]).T @ x / s.sum() + np.diag(ridge + 1e-12)
        w -= np.linalg.solve(hess, grad)
    return 1 / (1 + np.exp(-matrix(test) @ w))


def test_classifier_against_numpy(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(" ".join(rng.choices(words[: 20 if i % 4 else 30], k=rng.randrange(0, 12)) + (["lock"] if i % 4 == 0 and rng.random() < 0.7 else [])), int(i % 4 == 0)) for i in range(120)]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "id int, t string, y int")
    got = {r["id"]: r["probability"] for r in logit.TextModel("t", "y").fit(df.where("id < 80")).score(df.where("id >= 80")).collect()}
    want = plain_probabilities(rows[:80], rows[80:])
    assert np.abs(np.array([got[i] for i in range(80, 120)]) - want).max() < 2e-3


def test_forest_depths_against_a_loop():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    tree = sessions.grow(x[:64], rng)

    def depth(row):
        node, d = 0, 0
        while tree[node][0] >= 0:
            f, cut, left, right, _ = tree[node]
            node, d = (left if row[f] < cut else right), d + 1
        return d + tree[node][4]

    assert np.allclose(sessions.depths(tree, x), [depth(r) for r in x])
    assert max(sessions.depths(tree, x)) <= 6 + sessions.average_path(64) and sessions.average_path(2) == 1.0
