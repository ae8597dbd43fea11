"""Sources, tables, streams, checks, graph, governance."""

import gzip
import hashlib
import hmac
import ipaddress
import json
import os
import re
import sys
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch import export, quality
from tidewatch.dag import Graph, Model
from tidewatch.functions import text as tx
from tidewatch.functions import urls
from tidewatch.functions.keys import plain_cve, plain_ip, plain_uuid
from tidewatch.lake.table import Conflict, Lake, Table, commit_together
from tidewatch.plans import streams
from tidewatch.schemas import BRONZE, DEAD_LETTER, Field, is_full_compatible
from tidewatch.sources import envelope, feeds, rotating_log, sinks
from tidewatch.streaming import bronze, topics
from tidewatch.streaming.topics import TopicLog, TopicSpec, topic_name
from tidewatch.warehouse import Warehouse


def col(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_keys(spark):
    assert col(spark, [" 100.64.1.2\t", "::FFFF:100.64.1.2", "# list", "", None, "::1"], plain_ip) == ["100.64.1.2", "100.64.1.2", None, None, None, "::1"]
    assert col(spark, [" cve-2020-1 ", " ", None], plain_cve) == ["CVE-2020-1", None, None]
    u = "01a05a44-7e9b-75a9-91d7-7949a8cd5fd2"
    assert col(spark, [u.upper(), "{" + u + "}", f" {u} ", u.replace("-", ""), " Odd ", "", None], plain_uuid) == [u, u, u, u, "odd", None, None]


def test_urls(spark):
    cases = ["http://h.example:8080/a/bin.sh?x=/y#z", "HTTPS://U:p@H.example", "http://h.example/", "http://h.example?id=1", "ftp://h/x", "nothing", None]
    assert col(spark, cases, urls.url_host) == ["h.example", "h.example", "h.example", "h.example", "h", None, None]
    assert col(spark, cases, urls.url_port, "string") == [8080, 443, 80, 80, None, None, None]
    assert col(spark, cases, urls.url_last_segment)[:5] == ["bin.sh", "(root)", "(root)", "(root)", "x"]
    assert col(spark, ["10.1.2.3", "h.example", None], urls.ipv4_24) == ["10.1.2", None, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.from_regex(r"\A([a-z]{0,3}[0-9]{1,3}\.){2,4}[0-9]{1,3}[ a-z.]{0,2}\Z"), min_size=1, max_size=20))
def test_redaction_like_python(spark, texts):
    shape = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])")

    def ok(m):
        try:
            ipaddress.IPv4Address(m.group())
            return "[ip]"
        except ValueError:
            return m.group()

    assert col(spark, texts, tx.redact_ipv4) == [shape.sub(ok, t) for t in texts]


def test_pseudonyms(spark):
    key = b"k" * 40
    want = ["anon-" + hmac.new(key, v.encode(), hashlib.sha256).hexdigest()[:16] for v in ("100.64.0.1", "é")]
    assert col(spark, ["100.64.0.1", "é", None], lambda c: tx.pseudonym(c, key)) == [*want, None]
    assert tx.load_key({}) is None and tx.load_key({"TIDEWATCH_PSEUDONYM_KEY": "x" * 32}) == b"x" * 32
    with pytest.raises(tx.KeyTooShort):
        tx.load_key({"TIDEWATCH_PSEUDONYM_KEY": "short"})


def test_guards():
    assert tx.guarded_name("gold.tags") == "gold.tags"
    for bad in ("gold.tags;", "bronze.x", "gold.Tags", "gold.t--", "gold"):
        with pytest.raises(ValueError):
            tx.guarded_name(bad)
    assert tx.guarded_query("SELECT 1;") == "SELECT 1"
    for bad in ("DROP TABLE x", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) DELETE FROM x", "/* */ insert into x values (1)"):
        with pytest.raises(ValueError):
            tx.guarded_query(bad)


def test_feeds(spark, tmp_path):
    p = lambda name, body: (tmp_path / name).write_text(body) and str(tmp_path / name)
    csv = p("u.csv", '# banner\n"1","2026-09-01 00:00:00","http://a.example/x","online","","t","elf, mirai,","l","r"\n"2","2026-09-01 00:00:01","http://b.example/y","online","","t","","l","r"\n"3","bad","http://c.example/","online","","t","","l","r"\n')
    got = [json.loads(r["payload"]) for r in feeds.url_feed(spark, csv).collect()]
    assert [g["tags"] for g in got] == [["elf", "mirai"], []]
    kev = p("k.json", json.dumps({"catalogVersion": "7", "vulnerabilities": [{"cveID": "C1", "dateAdded": "2024-01-02", "cwes": ["CWE-1"]}, {"cveID": "C2", "dateAdded": "bad-date"}]}))
    rows = feeds.kev_catalogue(spark, kev).collect()
    assert [json.loads(r["payload"])["catalog_version"] for r in rows] == ["7", "7"] and all(r["occurred_at"] for r in rows) and json.loads(rows[1]["payload"])["cwes"] == []
    assert feeds.c2_list(spark, p("c.json", '[{"ip_address": "100.64.0.1", "port": 443, "first_seen": "2026-01-01 00:00:00"}]')).count() == 1
    assert feeds.c2_list(spark, p("o.json", '{"a": 1}')).count() == 0 and feeds.c2_list(spark, p("h.json", "<html>")).count() == 0
    tor = feeds.exit_list(spark, p("t.txt", "100.64.0.1\n\n# note\n 100.64.0.2 \n")).collect()
    assert len(tor) == 2 and len({r["occurred_at"] for r in tor}) == 1


def test_honeypot_lines(spark):
    good = '{"eventid": "cowrie.command.input", "timestamp": "2026-09-01T00:00:00.5Z", "session": "s"}'
    rows = [good, '{"eventid": "other", "timestamp": "2026-09-01T00:00:00Z"}', '{"eventid": "cowrie.x", "timestamp": "2026-09-01T00:00:00"}', "{half", "", None]
    ok, bad = feeds.honeypot_lines(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert [r["event_type"] for r in ok.collect()] == ["session.command"] and bad.count() == 5


@settings(max_examples=20, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=3), c, max_size=3), max_leaves=8))
def test_canonical_json_ignores_key_order(value):
    assert envelope.canonical_json(json.loads(json.dumps(value))) == envelope.canonical_json(value)


def test_envelopes(spark):
    rows = spark.createDataFrame([(datetime(2026, 9, 1, tzinfo=timezone.utc), '{"b": 1, "a": "é"}'), (datetime(2026, 9, 1, tzinfo=timezone.utc), '{"a":"é","b":1}')], "occurred_at timestamp, payload string")
    e = envelope.envelope(rows, "urlhaus", "ioc.url").collect()
    assert e[0]["content_hash"] == e[1]["content_hash"] == hashlib.sha256(b'{"a":"\\u00e9","b":1}').hexdigest()
    make = envelope.Uuid7()
    ids = [make() for _ in range(9000)]
    assert ids == sorted(ids) and len(set(ids)) == 9000 and ids[0][14] == "7"
    with pytest.raises(ValueError):
        envelope.utc(datetime(2026, 1, 1))


def test_contracts():
    old = [Field("a", "string"), Field("b", "string", True)]
    assert is_full_compatible(old, [*old, Field("c", "string", True)])[0]
    assert not is_full_compatible(old, [*old, Field("c", "string")])[0]
    assert not is_full_compatible(old, old[1:])[0] and is_full_compatible(old, old[:1])[0]
    assert not is_full_compatible(old, [Field("a", "int"), old[1]])[0]


def bronze_rows(spark, n, day=1, tag="e"):
    at = datetime(2026, 9, day, tzinfo=timezone.utc)
    rows = [(f"{tag}{i}", "urlhaus", "ioc.url", 1, at, at, json.dumps({"url": f"http://h{i}.example"}), f"c{i}", None, None, "t", 0, i, at) for i in range(n)]
    return spark.createDataFrame(rows, BRONZE)


def test_table_versions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), BRONZE)
    assert t.create(dry_run=True) == "would create" and t.create() == "created" and t.create() == "exists"
    assert t.read().count() == 0
    t.append(bronze_rows(spark, 3), once=("q", 0))
    again = t.append(bronze_rows(spark, 3), once=("q", 0))  # the batch comes again
    t.append(bronze_rows(spark, 2, day=2, tag="f"))
    assert again["version"] == 1 and t.read().count() == 5 and t.read(version=1).count() == 3
    assert t.append(bronze_rows(spark, 0)) is None
    assert t.read(since=datetime(2026, 9, 2, tzinfo=timezone.utc)).count() == 2
    assert t.stats()["rows"] == 5 and [r["is_current"] for r in t.history().collect()] == [True, False]
    t.upsert(bronze_rows(spark, 1, day=3), ["event_id"])
    assert t.read().count() == 5 and t.read(version=2).count() == 5
    with pytest.raises(KeyError):
        t.read(version=99)
    assert t.expire(keep=1) == 0  # too young
    assert t.expire(keep=1, older_than=timedelta(0)) == 2 and t.read().count() == 5


def test_topic_to_bronze_with_dead_letters(spark, tmp_path):
    log = TopicLog(spark, str(tmp_path / "log"))
    topic = topic_name("urlhaus")
    assert log.create(TopicSpec(topic)) == "created" and log.reconcile(TopicSpec(topic)) == "in sync" and log.reconcile(TopicSpec("none")) == "missing"
    events = bronze_rows(spark, 8).drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_bronze_written_at")
    bad = events.limit(1).withColumn("source", F.lit("nobody"))
    log.produce(topic, events.unionByName(bad))
    assert sum(log.counts(topic).values()) == 9 and sum(log.lag(topic, {}).values()) == 9
    go = lambda checkpoint: bronze.sync(spark, log, topic, str(tmp_path / "b"), str(tmp_path / "dlq"), str(tmp_path / checkpoint))
    assert go("c1") == {"written": 8, "dead_lettered": 1} and go("c1") == {"written": 0, "dead_lettered": 0}
    log.produce(topic, bronze_rows(spark, 4, tag="g").drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_bronze_written_at"))
    assert go("c1")["written"] == 4
    rows = Table(spark, str(tmp_path / "b"), BRONZE).read()
    assert rows.count() == 12 and rows.select("_kafka_partition", "_kafka_offset").distinct().count() == 12
    assert go("replay")["written"] == 12  # a new checkpoint reads all again, by design
    with pytest.raises(ValueError):
        log.reconcile(TopicSpec(topic, partitions=7), apply=True)
    assert log.delete(topic, dry_run=True) == "would delete" and log.delete(topic) == "deleted"


def test_offsets_over_several_ranges(spark, tmp_path, monkeypatch):
    """Offsets are dense and in order though no task sorts a whole partition, and go on at the next call."""
    monkeypatch.setattr(topics, "CHUNK", 7)
    log, topic = TopicLog(spark, str(tmp_path / "log")), topic_name("urlhaus")
    log.create(TopicSpec(topic))
    events = [bronze_rows(spark, 60, tag=tag).drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_bronze_written_at") for tag in "gh"]
    events[0] = events[0].withColumn("payload", F.lit('{"url": "http://hot.example/"}'))  # one entity: all in one partition
    for e in events:
        assert log.produce(topic, e) == {"produced": 60, "delivered": 60, "failed": 0, "dead_lettered": 0}
    data = tmp_path / "log" / topic / "data"
    rows = spark.read.parquet(str(data)).select("_partition", "_offset", "_appended_at", "ingested_at", "event_id").collect()
    assert len({r["event_id"] for r in rows}) == 120
    for p in {r["_partition"] for r in rows}:
        mine = sorted((r for r in rows if r["_partition"] == p), key=lambda r: r["_offset"])
        assert [r["_offset"] for r in mine] == list(range(len(mine)))
        for call in {r["_appended_at"] for r in mine}:
            placed = [(r["ingested_at"], r["event_id"]) for r in mine if r["_appended_at"] == call]
            assert placed == sorted(placed)
    hot = max({r["_partition"] for r in rows}, key=lambda p: sum(r["_partition"] == p for r in rows))
    assert len(list((data / f"_partition={hot}").glob("*.parquet"))) > 2 and sum(log.counts(topic).values()) == 120


@pytest.mark.parametrize("name", ["stream_bronze", "time_travel"])
def test_streams_and_versions_hold_every_source(spark, data, name):
    every = {r["source"]: r["count"] for r in spark.read.parquet(f"{data}/bronze_events.parquet").groupBy("source").count().collect()}
    rows = streams.QUERIES[name](spark, data).collect()
    last = max((r["version"] for r in rows), default=0) if name.startswith("time") else None
    got = {}
    for r in rows:
        if last is None or r["version"] == last:
            got[r["source"]] = got.get(r["source"], 0) + r["n"]
    assert got == every and "cowrie" in got


def test_a_crash_between_write_and_checkpoint(spark, tmp_path):
    """The batch is committed but the checkpoint isn't: it comes again, and is there once."""
    table = Table(spark, str(tmp_path / "b"), BRONZE)
    for _ in range(2):
        table.append(bronze_rows(spark, 3), once=("checkpoint", 7))
    assert table.read().count() == 3


def test_two_writers_lose_nothing(spark, tmp_path):
    """A reads, B appends, A replaces: A's change is refused, or done again from what B left."""
    a, b = (Table(spark, str(tmp_path / "t"), BRONZE) for _ in range(2))
    a.append(bronze_rows(spark, 2))
    version, seen = a.version(), a.read()
    b.append(bronze_rows(spark, 1, tag="b"))
    with pytest.raises(Conflict):
        a.replace(seen.unionByName(bronze_rows(spark, 1, tag="a")), expected=version)
    tries = []

    def change(old):
        if not tries.append(1) and len(tries) == 1:
            b.append(bronze_rows(spark, 1, tag="c"))  # again while A is at work
        return old.unionByName(bronze_rows(spark, 1, tag="a"))

    a.update(change)
    assert len(tries) == 2 and {r["event_id"] for r in b.read().collect()} == {"e0", "e1", "b0", "c0", "a0"}


def test_tables_replaced_together(spark, tmp_path, monkeypatch):
    one, two = (Table(spark, str(tmp_path / n), BRONZE) for n in ("one", "two"))
    for t in (one, two):
        t.append(bronze_rows(spark, 1))
    with monkeypatch.context() as m:
        m.setattr("tidewatch.storage.Files.make_folder", lambda *_: (_ for _ in ()).throw(OSError("dies before the transaction is there")))
        with pytest.raises(OSError):
            commit_together({one: bronze_rows(spark, 5), two: bronze_rows(spark, 6)}, str(tmp_path))
    assert (one.read().count(), two.read().count(), one.version()) == (1, 1, 1)
    commit_together({one: bronze_rows(spark, 2), two: bronze_rows(spark, 3)}, str(tmp_path))
    one.append(bronze_rows(spark, 1, tag="x"))
    assert (one.read().count(), two.read().count()) == (3, 3)


def test_a_long_log_is_read_from_its_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidewatch.lake.table.CHECKPOINT", 3)
    t = Table(spark, str(tmp_path / "t"), BRONZE)
    for i in range(7):
        t.append(bronze_rows(spark, 1, tag=f"t{i}"), once=("s", i))
    read = []
    whole = t.files.read
    monkeypatch.setattr(t.files, "read", lambda p: read.append(p) or whole(p))
    assert t.read().count() == 7 and len(read) <= 3
    assert t.append(bronze_rows(spark, 1), once=("s", 2))["repeated"] and t.read(version=4).count() == 4
    t.compact()
    assert t.read().count() == 7 and t.stats()["files"] == 1
    lake = Lake(spark, str(tmp_path))
    assert lake.create_namespace("bronze") == "created" and lake.create_namespace("bronze") == "exists"
    lake.table("bronze", "x", BRONZE).create()
    assert lake.tables("bronze") == ["x"] and "bronze" in lake.namespaces()


def test_producing_again_adds_nothing(spark, tmp_path, monkeypatch):
    log, topic = TopicLog(spark, str(tmp_path / "log")), topic_name("urlhaus")
    log.create(TopicSpec(topic))
    events = bronze_rows(spark, 6).drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_bronze_written_at")
    with monkeypatch.context() as m:
        m.setattr(TopicLog, "_move_in", lambda *_: (_ for _ in ()).throw(OSError("dies after the offsets are reserved")))
        with pytest.raises(OSError):
            log.produce(topic, events, batch="run 1")
    for _ in range(2):
        assert log.produce(topic, events, batch="run 1")["delivered"] == 6
    rows = spark.read.parquet(str(tmp_path / "log" / topic / "data"))
    assert rows.count() == 6 and rows.select("_partition", "_offset").distinct().count() == 6 and sum(log.counts(topic).values()) == 6
    letters = Table(spark, str(tmp_path / "letters"), DEAD_LETTER, "failed_at")
    bad = events.limit(2).withColumn("source", F.lit("nobody"))
    assert log.produce(topic, events.unionByName(bad), dead=letters) == {"produced": 8, "delivered": 6, "failed": 2, "dead_lettered": 2}
    assert letters.read().count() == 2 and rows.sparkSession.read.parquet(str(tmp_path / "log" / topic / "data")).count() == 12


def test_raw_messages_are_read_by_the_consumer(spark, tmp_path):
    """Texts that can't be read, deletions and invalid envelopes become dead letters; newer writers' fields are passed over."""
    log, topic = TopicLog(spark, str(tmp_path / "log")), topic_name("urlhaus")
    log.create(TopicSpec(topic))
    ok = {"event_id": "e", "source": "urlhaus", "event_type": "ioc.url", "schema_version": 2, "occurred_at": "2026-09-01T10:00:00Z", "ingested_at": "2026-09-01T10:00:00Z", "payload": "{}", "content_hash": "c", "field_of_tomorrow": 1}
    texts = [json.dumps(ok), "{broken", None, json.dumps(ok | {"source": "nobody"}), json.dumps({k: v for k, v in ok.items() if k != "content_hash"})]
    log.produce(topic, topics.raw_messages(spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "key string, value string")))
    assert bronze.sync(spark, log, topic, str(tmp_path / "b"), str(tmp_path / "dlq"), str(tmp_path / "cp")) == {"written": 1, "dead_lettered": 4}
    [r] = Table(spark, str(tmp_path / "b"), BRONZE).read().collect()
    assert (r["event_id"], r["schema_version"], r["collector_host"]) == ("e", 2, None)
    assert {r["error_class"]: r["n"] for r in bronze.letters(spark, str(tmp_path / "dlq"), topic).collect()} == {"DecodeError": 1, "Tombstone": 1, "InvalidEnvelope": 2}


def test_rows_in_a_stated_order(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), BRONZE, order=["event_id"])
    t.append(bronze_rows(spark, 20).coalesce(1).orderBy(F.desc("event_id")))
    ids = [r["event_id"] for r in t.read().collect()]
    assert ids == sorted(ids)


def test_lines_of_all_shapes_in_one_table(spark, tmp_path):
    for day, rows in (("2026-09-01", [{"a": 1}]), ("2026-09-02", [{"b": "x"}, {"a": 2, "c": [1]}])):
        d = tmp_path / "source=urlhaus" / f"date={day}"
        d.mkdir(parents=True)
        (d / "x.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    got = feeds.jsonl(spark, str(tmp_path))
    assert {"a", "b", "c", "source", "date"} == set(got.columns) and got.count() == 3 and got.where("a is null").count() == 1


def test_retention_lag_and_unknown_sources(spark, tmp_path):
    with pytest.raises(KeyError):
        topics.spec_of("nobody")
    log, spec = TopicLog(spark, str(tmp_path / "log")), topics.spec_of("urlhaus")
    log.create(spec)
    events = bronze_rows(spark, 6).drop("_kafka_topic", "_kafka_partition", "_kafka_offset", "_bronze_written_at")
    log.produce(spec.name, events)
    assert sum(log.lag(spec.name, str(tmp_path / "cp")).values()) == 6  # never read
    bronze.sync(spark, log, spec.name, str(tmp_path / "b"), str(tmp_path / "dlq"), str(tmp_path / "cp"))
    assert sum(log.lag(spec.name, str(tmp_path / "cp")).values()) == 0
    assert log.retain(spec.name) == 0
    assert log.retain(spec.name, datetime.now(timezone.utc) + timedelta(hours=spec.retention_hours + 1)) > 0
    assert sum(log.counts(spec.name).values()) == 6 and sum(log.lag(spec.name, {}).values()) == 0  # gone, and offsets go on
    log.produce(spec.name, events.limit(1))
    assert sum(log.counts(spec.name).values()) == 7


def test_rotating_log(spark, tmp_path):
    live = tmp_path / "logs" / "cowrie.json"
    live.parent.mkdir()
    live.write_bytes(b"one\ntwo\nhal")
    spark.dataSource.register(rotating_log.RotatingLog)

    def read(name="r"):
        q = spark.readStream.format("rotating_log").load(str(live.parent)).writeStream.format("json").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        return sorted(r["line"] for r in spark.read.schema("line string").json(str(tmp_path / "out")).collect())

    assert read() == ["one", "two"]
    os.rename(live, live.parent / "cowrie.json.1")  # rotated: the same file under another name
    with open(live.parent / "cowrie.json.1", "ab") as f:
        f.write(b"f\n")
    live.write_bytes(b"new\n")
    assert read() == ["half", "new", "one", "two"]
    assert read() == ["half", "new", "one", "two"]


def test_long_lines_of_a_rotating_log(spark, tmp_path):
    """Lines of up to 8 MiB are kept; a longer one is a rejected row with its file and offset."""
    live = tmp_path / "cowrie.json"
    lines = [b"one", b"x" * (2 << 20), b"y" * (8 << 20), b"z" * (17 << 20), b"last"]
    live.write_bytes(b"".join(x + b"\n" for x in lines))
    spark.dataSource.register(rotating_log.RotatingLog)
    q = spark.readStream.format("rotating_log").load(str(tmp_path)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(F.length("line").alias("n"), "inode", "offset", "rejected").orderBy("offset").collect()
    ends = [sum(len(x) + 1 for x in lines[: i + 1]) for i in range(len(lines))]
    wanted = [None if len(x) > 8 << 20 else len(x) for x in lines]
    assert [tuple(r) for r in got] == [(n, live.stat().st_ino, end, n is None) for n, end in zip(wanted, ends)]
    for chunk in (1, 3, 100):
        small = tmp_path / "small"
        small.write_bytes(b"ab\n\nabcde\nabcd\n")
        assert list(rotating_log.whole_lines(str(small), 0, 16, chunk, most=4)) == [(b"ab", 3), (None, 10), (b"abcd", 15)]


def test_listing_parser():
    text = "7 10 cowrie.json\n5 20 cowrie.json.2026-09-01\n7\t10\tx\n8 10 ../x\nx 1 a\n1 2 3 4\n\n"
    assert [(f.inode, f.name) for f in rotating_log.parse_listing(text, "cowrie.json")] == [(5, "cowrie.json.2026-09-01"), (7, "cowrie.json")]


def test_logs_of_another_machine(tmp_path):
    """Copies grow by what is new; rotation moves nothing; a reader that fails is an error."""
    far = tmp_path / "far"
    far.mkdir()
    reader = tmp_path / "reader.py"
    reader.write_text("import os, sys\nd = sys.argv[1]\nf = {os.stat(os.path.join(d, n)).st_ino: n for n in os.listdir(d)}\n" "if sys.argv[2] == 'list':\n    [print(i, os.path.getsize(os.path.join(d, n)), n) for i, n in f.items()]\n" "else:\n    h = open(os.path.join(d, f[int(sys.argv[3])]), 'rb'); h.seek(int(sys.argv[4])); sys.stdout.buffer.write(h.read(int(sys.argv[5])))\n")
    (far / "cowrie.json").write_bytes(b"one\ntwo\n")
    logs = rotating_log.RemoteLogs([sys.executable, str(reader), str(far)], "cowrie.json")
    near = tmp_path / "near"
    assert logs.fetch(str(near), chunk=3) == 8 and logs.fetch(str(near)) == 0
    os.rename(far / "cowrie.json", far / "cowrie.json.2026-09-01")
    (far / "cowrie.json").write_bytes(b"three\n")
    assert logs.fetch(str(near)) == 6 and sorted(f.read_bytes() for f in near.iterdir()) == [b"one\ntwo\n", b"three\n"]
    with pytest.raises(ConnectionError):
        rotating_log.RemoteLogs([sys.executable, "-c", "raise SystemExit(3)"], "cowrie.json").files()


def test_a_log_file_that_goes_away_is_an_error(tmp_path):
    reader = rotating_log.RotatingLogReader(str(tmp_path), "cowrie.json", 100)
    with pytest.raises(FileNotFoundError):
        list(reader.read(rotating_log.Span(12345, 0, 10)))


def test_sinks(spark, tmp_path):
    rows = bronze_rows(spark, 3)
    s = sinks.JsonlSink(str(tmp_path / "j"))
    assert s.write(rows.limit(0)) == 0 and not (tmp_path / "j").exists()
    assert s.write(rows.coalesce(1)) == 3
    [f] = [os.path.join(a, n) for a, _, names in os.walk(tmp_path / "j") for n in names if n.endswith(".json.gz")]
    assert "source=urlhaus/date=2026-09-01" in f and len(gzip.open(f).readlines()) == 3
    assert feeds.jsonl(spark, str(tmp_path / "j")).where("source = 'urlhaus'").count() == 3
    out = []
    c = sinks.ConsoleSink(1, 40, out.append)
    c.write(rows)
    c.close()
    c.close()
    assert len(out) == 2 and len(out[0]) <= 40 and out[1] == "3 rows"


def test_graph_blocks_descendants(spark):
    one = lambda *_: spark.range(1)
    broken = lambda *_: 1 / 0
    bad = lambda df: [quality.Check("empty", df.limit(1))]
    warn = lambda df: [quality.Check("empty", df.limit(1), quality.WARN)]
    g = Graph([Model("silver.a", one, checks=warn), Model("silver.b", one, checks=bad), Model("gold.x", one, ("silver.a",)), Model("gold.y", one, ("silver.b",)), Model("ml.z", broken, ("silver.a",))])
    r = g.run()
    assert {k: v.status for k, v in r.items()} == {"silver.a": "built", "silver.b": "failed", "gold.x": "built", "gold.y": "skipped", "ml.z": "failed"}
    assert g.select("silver.a+") == {"silver.a", "gold.x", "ml.z"} and g.select("gold") == {"gold.x", "gold.y"} and g.select("+gold.x") == {"gold.x", "silver.a"}
    with pytest.raises(ValueError):
        Graph([Model("a", one, ("b",)), Model("b", one, ("a",))]).order()
    with pytest.raises(KeyError):
        Graph([Model("a", one, ("none",))])


def test_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, None), (2, "192.0.2.7")], "k int, v string")
    assert [quality.not_null(df, "k").count(), quality.unique(df, "k").count(), quality.accepted_values(df, "v", ["x", "y"]).count(), quality.no_documentation_addresses(df, "v").count(), quality.has_rows(df).count(), quality.has_rows(df.limit(0)).count()] == [1, 1, 1, 1, 0, 1]
    assert quality.same_total(df.agg(F.count("*")), df.agg(F.count("k"))).count() == 1 and quality.same_total(df.agg(F.count("*")), df.agg(F.count("*"))).isEmpty()
    assert [quality.freshness(h) for h in (1, 9, 15, None)] == ["pass", "warn", "fail", "fail"]


def test_export_is_all_or_nothing(spark, tmp_path):
    at = datetime(2026, 9, 1, tzinfo=timezone.utc)
    sessions = spark.createDataFrame([("s1", "100.64.0.9", at, "ssh", True, 2, 0, "wget http://100.64.0.9/x"), ("s2", "100.64.0.8", at, None, False, 0, 0, None)], "session_id string, src_ip string, started_at timestamp, protocol string, login_succeeded boolean, commands_run long, downloads long, first_command string")
    events = spark.createDataFrame([("cowrie.login.failed", "root", "100.64.0.9")], "eventid string, username string, password string")
    flagged = spark.createDataFrame([(1, "100.64.0.9", at, "ssh", "from 100.64.0.9", 2, 0, True)], "anomaly_rank long, src_ip string, started_at timestamp, protocol string, reasons string, commands_run long, downloads long, is_flagged boolean")
    with pytest.raises(export.ExportRefused):
        export.honeypot(sessions, events, flagged, None)
    payload = export.honeypot(sessions, events, flagged, b"k" * 32)
    assert payload["top_first_commands"] == [{"value": "wget http://[ip]/x", "sessions": 1}] and payload["flagged_sessions"][0]["source"].startswith("anon-")
    out = str(tmp_path / "site")
    c2 = [{"ip_address": "100.64.0.9"}]  # published on purpose
    assert export.publish(spark, out, {"honeypot": payload, "c2": c2, "summary": {"c2_servers": 1}}, sessions.select("src_ip"), revision="r") == ["c2", "honeypot", "summary"]
    before = export.published(spark, out)
    assert before["c2"]["data"] == c2 and before["summary"]["counts"] == {"c2_servers": 1} and before["summary"]["revision"] == "r" and before["summary"]["schema_version"] == 1
    for leak in ({"ip": "100.64.0.8"}, {"x": ["wget http://100.64.1.9/a"]}):
        with pytest.raises(export.ExportRefused):  # scanned without being asked
            export.publish(spark, out, {"honeypot": leak, "c2": []})
    with pytest.raises(export.ExportRefused):
        export.publish(spark, out, {"honeypot": {"x": "from fe80::7"}}, spark.createDataFrame([("fe80::7",), (None,), (" ",)], "v string"))
    assert export.published(spark, out) == before
    assert export.honeypot(None, None, None, None) == {"available": False}


def test_seven_files_from_a_small_warehouse(spark, tmp_path):
    day = datetime(2026, 9, 1).date()
    w = Warehouse(spark, str(tmp_path))
    w.save("silver.kev_vulnerabilities", spark.createDataFrame([("c1", "Microsoft", True), ("c2", "Microsoft", False), ("c3", "Fortinet", None)], "cve_id string, vendor string, is_ransomware_linked boolean"))
    w.save("silver.urlhaus_urls", spark.createDataFrame([("u1", "h", True), ("u2", "h", False)], "url string, host string, is_online boolean"))
    w.save("gold.vendor_exploitation", spark.createDataFrame([(f"v{i}", i, 1, Decimal("4.0"), 2, day) for i in range(30)], "vendor string, exploited_cves int, ransomware_linked_cves int, ransomware_share_pct decimal(4,1), products_affected int, most_recently_added date"))
    w.save("ml.kev_ransomware_scores", spark.createDataFrame([(1, "c1", "v", "p", "n", day, 0.5, True), (None, "c2", "v", "p", "n", day, 0.9, False)], "watchlist_rank long, cve_id string, vendor string, product string, vulnerability_name string, date_added date, ransomware_probability double, on_watchlist boolean"))
    payloads = export.build(w.read, None)
    assert sorted(payloads) == ["c2", "campaigns", "honeypot", "malware_tags", "summary", "vendors", "watchlist"]
    s = payloads["summary"]
    assert len(s) == 11 and (s["exploited_cves"], s["ransomware_linked_cves"], s["vendors"], s["malware_hosts"], s["c2_servers"], s["url_campaigns"]) == (3, 1, 2, 1, None, None)
    assert len(payloads["vendors"]) == 25 and payloads["vendors"][0]["vendor"] == "v29" and payloads["c2"] == [] and [r["cve_id"] for r in payloads["watchlist"]] == ["c1"]
    export.publish(spark, str(tmp_path / "site"), payloads)
    assert export.published(spark, str(tmp_path / "site"))["vendors"]["data"][0] == {"vendor": "v29", "exploited_cves": 29, "ransomware_linked_cves": 1, "ransomware_share_pct": 4.0, "products_affected": 2, "most_recently_added": "2026-09-01"}
    assert w.save("silver.urlhaus_urls", spark.createDataFrame([("u3",)], "url string")).columns == ["url"] and sorted(w.names())[0] == "gold.vendor_exploitation"
    with pytest.raises(ValueError):
        w.read("silver.x; drop")


def test_pseudonyms_of_addresses(spark):
    key = b"k" * 32
    of = lambda *v: [r[0] for r in spark.createDataFrame([(x,) for x in v], "v string").select(tx.address_pseudonym(F.col("v"), key)).collect()]
    a, b, c, d, none = of("2001:DB8:0:0::1", "2001:db8::1", "100.64.0.1", " ::ffff:100.64.0.1", None)
    assert a == b and c == d and a != c and none is None
    for bad in ("300.1.1.1", "host.example", "1.2.3"):
        with pytest.raises(Exception, match="isn't an address"):
            of(bad)


def test_settings_refuse_development_secrets():
    from tidewatch.settings import SCHEDULE, Settings, UnsafeSettings

    assert Settings.load({}).environment == "local" and Settings.load({"TIDEWATCH_PSEUDONYM_KEY": "dev-only-secret-xxxxxxxxxxxxxxxxxxx"}).shown()["pseudonym_key"] == "set"
    with pytest.raises(UnsafeSettings):
        Settings.load({"TIDEWATCH_ENVIRONMENT": "production", "TIDEWATCH_PSEUDONYM_KEY": "dev-only-secret-xxxxxxxxxxxxxxxxxxx"})
    assert Settings.load({"TIDEWATCH_HONEYPOT": "yes"}).honeypot and not SCHEDULE["enabled"]


def test_lambda_view_on_a_stream(spark, tmp_path):
    from tidewatch.streaming.lambda_view import LambdaView

    hour = 3600
    t0 = 1_788_220_800  # the start of an hour
    ts = lambda s: datetime.fromtimestamp(s, timezone.utc)
    rows = lambda *r: spark.createDataFrame([(i, g, ts(o), ts(a)) for i, g, o, a in r], "id string, g string, o timestamp, a timestamp")
    v = LambdaView(spark, str(tmp_path / "v"), F.col("id"), "g", "o", "a")
    first = rows(("a", "h", t0 + 5, t0 + 60), ("b", "h", t0 + 6, t0 + 70))
    late = rows(("a", "h", t0 + 5, t0 + 2 * hour), ("c", "h", t0 + 9, t0 + 3 * hour))
    too_late = rows(("d", "h", t0 + 9, t0 + 80 * hour))
    v.add(first, 0)
    v.add(first, 0)  # the batch comes again
    got = lambda now: {(r["grp"], r["period_start"]): r["n"] for r in v.read().collect()}
    assert got(t0 + hour) == {("h", t0): 2}
    v.add(late, 1)
    assert got(t0 + 4 * hour) == {("h", t0): 4}  # a second copy of a, until the recomputation
    v.recompute(first.unionByName(late), (t0 + 5 * hour) * 1_000_000, seen=1)
    assert got(t0 + 5 * hour) == {("h", t0): 3}
    log = first.unionByName(late).unionByName(too_late)
    v.add(too_late, 2)
    v.recompute(log, (t0 + 90 * hour) * 1_000_000, seen=2)
    v.recompute(log, (t0 + 91 * hour) * 1_000_000, seen=2)
    assert got(t0 + 91 * hour) == {("h", t0): 3}  # frozen
