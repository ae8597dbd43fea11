"""Snapshots, histories, as-of and late events on small fixtures, against plain loops."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidewatch.operators import asof, dedup, history, lateness, snapshots
from tidewatch.operators.runs import complete_runs

T0 = datetime(2026, 9, 1, tzinfo=timezone.utc)


def test_snapshot_changes_against_sets(spark):
    rng = random.Random(3)
    snaps = [{k: rng.randrange(3) for k in rng.sample([f"k{i}" for i in range(60)], 40)} for _ in range(5)]
    snaps[3] = {}  # a complete but empty list
    rows = [("s", k, n, v) for n, m in enumerate(snaps) for k, v in m.items()]
    df = spark.createDataFrame(rows, "source string, key string, seq int, sig long")
    runs = spark.createDataFrame([("s", n) for n in range(5)], "source string, seq int")
    got = {tuple(r)[1:] for r in snapshots.snapshot_changes(df, runs, snapshots.extend_ordinals(df, blocks=3)).collect()}
    want = set()
    for n in range(1, 5):
        a, b = snaps[n - 1], snaps[n]
        want |= {(n, k, "added") for k in b.keys() - a.keys()} | {(n, k, "removed") for k in a.keys() - b.keys()} | {(n, k, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    assert got == want


def test_ordinals_persist(spark):
    first = snapshots.extend_ordinals(spark.createDataFrame([("s", "a"), ("s", "b"), ("s", None), ("s", "a")], "source string, key string"), blocks=2)
    more = snapshots.extend_ordinals(spark.createDataFrame([("s", c) for c in "abcdef"], "source string, key string"), first, blocks=2)
    old, new = {r["key"]: (r["block"], r["ordinal"]) for r in first.collect()}, {r["key"]: (r["block"], r["ordinal"]) for r in more.collect()}
    assert old.items() <= new.items() and len(set(new.values())) == len(new) == 6


def test_no_snapshots(spark):
    empty = spark.createDataFrame([], "source string, key string, seq int, sig long")
    runs = spark.createDataFrame([], "source string, seq int")
    assert snapshots.snapshot_changes(empty, runs, snapshots.extend_ordinals(empty)).count() == 0


def test_runs_once_in_order(spark):
    rows = [("r2", "s", 2, T0 + timedelta(2), T0, "success", None), ("r1", "s", 1, T0 + timedelta(1), T0, "success", "h"), ("r1", "s", 1, T0 + timedelta(1), T0, "success", "g"), ("r3", "s", 3, T0 + timedelta(3), T0, "partial", "h"), (None, "s", 4, T0, T0, "success", "h"), ("r5", "s", 5, None, T0, "success", "h")]
    df = spark.createDataFrame(rows, "collector_run_id string, source string, snapshot_no int, collected_at timestamp, ingested_at timestamp, run_status string, collector_host string")
    assert [(r["collector_run_id"], r["seq"]) for r in complete_runs(df).orderBy("seq").collect()] == [("r1", 0), ("r2", 1)]


def brute_runs(seqs, meet):
    out = []
    for s, p in sorted(seqs.items()):
        if out and out[-1][2] == p and (not meet or out[-1][1] == s):
            out[-1] = (out[-1][0], s + 1, p)
        else:
            out.append((s, s + 1, p))
    return out


def test_coalescing_against_a_loop(spark):
    rng = random.Random(5)
    seen = {e: {s: rng.randrange(2) for s in rng.sample(range(40), rng.randrange(1, 40))} for e in "abcdef"}
    rows = [(e, s, p) for e, m in seen.items() for s, p in m.items()]
    df = spark.createDataFrame(rows + rows[:9] + [("z", None, 1)], "e string, seq int, p int")
    for meet in (True, False):
        got = sorted(tuple(r) for r in history.coalesce_runs(df, ["e"], "seq", "p", 40, meet).collect())
        assert got == sorted((e, *r) for e, m in seen.items() for r in brute_runs(m, meet))
    assert history.coalesce_runs(df.limit(0), ["e"], "seq", "p", 40).count() == 0


def test_coalescing_above_the_local_rounds(spark):
    """More observations of one entity than one task's block holds."""
    n = (1 << history.LOCAL_ROUNDS) * 2 + 5
    df = spark.range(n).where("id <> 1500").select(F.lit("hot").alias("e"), F.col("id").alias("seq"), F.lit(1).alias("p"))
    assert [tuple(r)[1:3] for r in history.coalesce_runs(df, ["e"], "seq", "p", n).orderBy("start").collect()] == [(0, 1500), (1501, n)]


def test_known_lists_and_half_open_intervals(spark, monkeypatch):
    us = lambda t: int(t.timestamp() * 1e6)
    rows = [("a", 1, T0, T0), ("b", 2, T0 + timedelta(1), T0 + timedelta(5)), ("c", 3, T0 + timedelta(2), T0 + timedelta(3)), ("d", 4, T0 + timedelta(4), T0 + timedelta(6))]
    runs = spark.createDataFrame(rows, "collector_run_id string, snapshot_no int, collected_at timestamp, ingested_at timestamp")
    lists = {r["collector_run_id"]: (r["known_from"], r["known_to"]) for r in asof.known_lists(runs).collect()}
    assert lists == {"a": (us(T0), us(T0 + timedelta(3))), "c": (us(T0 + timedelta(3)), us(T0 + timedelta(6))), "d": (us(T0 + timedelta(6)), None)}  # b came after c was known
    spans = spark.createDataFrame([("x", us(T0), us(T0 + timedelta(3))), ("x", us(T0 + timedelta(6)), None), (None, us(T0), None)], "k string, valid_from long, valid_to long")
    at = [T0 - timedelta(seconds=1), T0, T0 + timedelta(3) - timedelta(microseconds=1), T0 + timedelta(3), T0 + timedelta(6), T0 + timedelta(9)]
    events = spark.createDataFrame([(i, "x", us(t)) for i, t in enumerate(at)] + [(9, None, us(T0)), (10, "x", None)], "id int, k string, t long")
    assert {r["id"] for r in asof.valid_at(events, spans, "k", "t").collect()} == {1, 2, 4, 5}
    assert asof.valid_at(events.limit(0), spans, "k", "t").count() == 0
    monkeypatch.setattr(asof, "HOT_ROWS", 1)  # every bucket of more than one event is split
    many = events.unionByName(events)
    assert sorted(r["id"] for r in asof.valid_at(many, spans, "k", "t").collect()) == [1, 1, 2, 2, 4, 4, 5, 5]


def test_exactly_once(spark, monkeypatch):
    rows = [("A", 2, "x"), ("a ", 1, "y"), ("b", 1, "z"), (None, 1, "n1"), (None, 1, "n2"), ("c", 1, "same"), ("c", 1, "same")]
    df = spark.createDataFrame(rows, "id string, _tw_rank int, _tw_key string")  # names that clash with the operator's own
    key = F.lower(F.trim("id"))
    got = sorted(tuple(r) for r in dedup.exactly_once(df, key, [F.col("_tw_rank"), F.col("_tw_key")]).collect() if r[0])
    assert got == [("a ", 1, "y"), ("b", 1, "z"), ("c", 1, "same")]
    assert dedup.exactly_once(df, key, [F.col("_tw_rank")]).count() == 5  # both rows without an identifier stay
    with monkeypatch.context() as m:
        m.setattr(dedup, "BROADCAST_IDS", 0)  # too many repeated identifiers to broadcast
        assert sorted(tuple(r) for r in dedup.exactly_once(df, key, [F.col("_tw_rank"), F.col("_tw_key")]).collect() if r[0]) == got
        assert dedup.exactly_once(df, key, [F.col("_tw_rank")]).count() == 5
    new = spark.createDataFrame([("B", "more"), ("d", "more")], "id string, extra string")
    both = dedup.exactly_once(df, key, [F.asc_nulls_last("_tw_rank")], new)
    assert sorted((r["id"], r["_tw_key"]) for r in both.where("lower(id) in ('b', 'd')").collect()) == [("b", "z"), ("d", None)]
    assert dedup.exactly_once(df.limit(0), key, [F.col("_tw_rank")]).count() == 0


def test_late_events(spark):
    p = lateness.Periods()
    end = T0 + timedelta(hours=1)
    at = {"on time": end + timedelta(minutes=15) - timedelta(microseconds=1), "corrected": end + timedelta(minutes=15), "last": end + timedelta(hours=72) - timedelta(microseconds=1), "cut off": end + timedelta(hours=72)}
    rows = [(k, "h", T0 + timedelta(minutes=5), t) for k, t in at.items()] + [("on time", "h", T0 + timedelta(minutes=5), end + timedelta(hours=99)), (None, "h", T0, T0), ("no time", "h", None, T0), ("ahead", None, T0 + timedelta(hours=2), T0)]
    df = spark.createDataFrame(rows, "id string, host string, occurred_at timestamp, ingested_at timestamp")
    events = lateness.first_arrivals(df, F.col("id"), "host", "occurred_at", "ingested_at")
    us = lambda t: int(t.timestamp() * 1e6)
    # whenever the batch ran, before anything, in between or after everything, the served counts are the same
    views = [lateness.reconciled(lateness.build_views(events, p, us(t)), p) for t in (T0 - timedelta(days=9), end + timedelta(minutes=16), end + timedelta(hours=72), end + timedelta(hours=80))]
    results = [sorted(map(str, v.collect())) for v in views]
    assert all(r == results[0] for r in results)
    view = views[1]
    got = {r["grp"]: (r["provisional"], r["final"], r["late"], r["cut_off"]) for r in view.collect()}
    assert got == {"h": (1, 3, 2, 1), None: (1, 1, 0, 0)}
    assert {(r["grp"], r["late_kind"]) for r in lateness.late_kinds(view).collect()} == {("h", "corrected"), ("h", "cut_off")}


def test_what_is_served_comes_from_the_layers(spark):
    """Bypassing a layer changes the counts: frozen periods stand, open ones are base plus fast."""
    p = lateness.Periods()
    batch = 1_000_000 * 3600 * 1000
    rows = lambda *r: spark.createDataFrame(list(r), "grp string, period_start long, n long")
    old, new = 3600 * 900, 3600 * 990
    got = lateness.serve(rows(("h", old, 5)), rows(("h", old, 7), ("h", new, 2)), rows(("h", new, 1), ("h", old, 9), ("g", new, 4)), batch, p)
    assert {tuple(r) for r in got.collect()} == {("h", old, 5), ("h", new, 3), ("g", new, 4)}


def test_lambda_view_recomputes_in_one_commit(spark, tmp_path):
    from tidewatch.streaming.lambda_view import LambdaView

    at = lambda h: T0 + timedelta(hours=h)
    us = lambda t: int(t.timestamp() * 1e6)
    df = lambda *r: spark.createDataFrame([(i, "h", o, a) for i, o, a in r], "id string, host string, occurred_at timestamp, ingested_at timestamp")
    first, second, third = df(("a", at(0), at(0)), ("b", at(1), at(1))), df(("a", at(0), at(2)), ("c", at(0), at(2))), df(("d", at(1), at(3)))
    v = LambdaView(spark, str(tmp_path), F.col("id"), "host", "occurred_at", "ingested_at")
    counts = lambda: {r["period_start"] - int(T0.timestamp()): r["n"] for r in v.read().collect()}
    v.add(first, 0)
    v.add(first, 0)  # the batch comes again
    v.add(second, 1)
    assert counts() == {0: 3, 3600: 1}  # the copy of a is counted again until the batch corrects it
    versions = v.state.version()
    v.add(third, 2)  # arrives while the recomputation of the first two runs
    v.recompute(first.unionByName(second), us(at(4)), seen=1)
    assert counts() == {0: 2, 3600: 2} and v.state.version() == versions + 2
    v.recompute(first.unionByName(second).unionByName(third), us(at(80)), seen=2)
    v.recompute(df(("z", at(0), at(0))), us(at(90)), seen=2)  # frozen periods stay as they were
    assert counts() == {0: 2, 3600: 2}


def test_ordinals_are_kept_between_runs(spark, tmp_path):
    keys = lambda *k: spark.createDataFrame([("s", x) for x in k], "source string, key string")
    kept = lambda df: {r["key"]: (r["block"], r["ordinal"]) for r in df.collect()}
    first = kept(snapshots.Ordinals(spark, str(tmp_path)).extend(keys("a", "b", None)))
    later = kept(snapshots.Ordinals(spark, str(tmp_path)).extend(keys("b", "c", "d")))  # another run finds them
    assert first.items() <= later.items() and set(later) == set("abcd") and len(set(later.values())) == 4
    assert kept(snapshots.Ordinals(spark, str(tmp_path)).extend(keys("a"))) == later


def test_a_block_grows_beyond_one_bitmap(spark):
    n = snapshots.BLOCK_BITS + 5000
    old = spark.range(2000).select(F.lit("s").alias("source"), F.format_string("k%07d", "id").alias("key"))
    new = spark.range(n).select(F.lit("s").alias("source"), F.format_string("k%07d", "id").alias("key"))
    ordinals = snapshots.extend_ordinals(new, snapshots.extend_ordinals(old, blocks=1), blocks=1)
    records = old.select("*", F.lit(0).alias("seq"), F.lit(1).cast("long").alias("sig")).unionByName(new.where("key > 'k0000009'").select("*", F.lit(1).alias("seq"), F.when(F.col("key") == "k0000100", 2).otherwise(1).cast("long").alias("sig")))
    runs = spark.createDataFrame([("s", 0), ("s", 1)], "source string, seq int")
    got = {r["change_kind"]: r["count"] for r in snapshots.snapshot_changes(records, runs, ordinals).groupBy("change_kind").count().collect()}
    assert got == {"added": n - 2000, "removed": 10, "changed": 1}
