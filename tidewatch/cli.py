"""Commands: ``python -m tidewatch.cli <command>``; ``--root`` names the folder of topics, tables and models."""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from dataclasses import asdict
from datetime import date

from tidewatch import __version__
from tidewatch.functions.text import load_key, preview
from tidewatch.schemas import BRONZE, DEAD_LETTER, SOURCES
from tidewatch.settings import SCHEDULE, Settings

#: Characters of a payload that a listing shows, and of a previewed row.
PAYLOAD, ROW = 260, 300


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewatch")
    p.add_argument("--root", default=None)
    top = p.add_subparsers(dest="command", required=True)
    for name in ("version", "sources", "config", "doctor"):
        top.add_parser(name)
    c = top.add_parser("collect", help="a delivered file into a topic, a folder or nowhere")
    c.add_argument("source", choices=SOURCES)
    c.add_argument("path")
    c.add_argument("--limit", type=int)
    c.add_argument("--to", choices=["topic", "files", "console"], default="topic")
    c.add_argument("--dry-run", action="store_true")

    def group(name: str, **actions):
        g = top.add_parser(name).add_subparsers(dest="action", required=True)
        return {a: g.add_parser(a, help=h) for a, h in actions.items()}

    t = group("topics", init="create all topics", describe="declared settings", counts="rows per partition", reconcile="declared against stored settings", retain="drop rows that are older than the topic keeps", delete="remove a topic")
    for a in ("init", "reconcile", "delete"):
        t[a].add_argument("--dry-run", action="store_true")
    t["delete"].add_argument("source", choices=SOURCES)
    for name in ("tail", "lag"):
        c = top.add_parser(name)
        c.add_argument("source", choices=SOURCES)
        c.add_argument("--rows", type=int, default=5)
    lake = group("lake", init="create Bronze tables", sync="topics into Bronze", tables="all tables", history="versions of a table", sample="rows of a table", compact="larger files", expire="drop what no kept version reads", letters="dead letters", sql="a reading statement over Bronze")
    lake["sync"].add_argument("source", nargs="?", choices=SOURCES)
    lake["sync"].add_argument("--replay", action="store_true")
    for a in ("history", "sample", "compact", "expire"):
        lake[a].add_argument("source", choices=SOURCES)
    for a in ("history", "sample", "letters"):
        lake[a].add_argument("--rows", type=int, default=5)
    lake["sample"].add_argument("--version-no", type=int)
    lake["sql"].add_argument("statement")
    model = group("model", build="build models and check them", test="check models as they stand", docs="what depends on what", show="rows of a model", sql="a reading statement over models")
    model["build"].add_argument("--job", choices=["all", "models", "ml"], default="models")
    for a in ("build", "test"):
        model[a].add_argument("--select")
    model["build"].add_argument("--as-of", default=date.today().isoformat())
    model["show"].add_argument("name")
    model["show"].add_argument("--rows", type=int, default=10)
    model["sql"].add_argument("statement")
    ml = group("ml", campaigns="cluster servers", ransomware="score vulnerabilities", embed="bring the index up to date", ask="search the index", sessions="unusual sessions", runs="newest run of each experiment")
    ml["ask"].add_argument("question")
    ml["ask"].add_argument("--top", type=int, default=10)
    e = group("publish", export="the seven files")["export"]
    e.add_argument("folder")
    h = group("honeypot", files="the log's files", fetch="copy the log from the sensor", collect="new log lines into the topic")
    for a in h.values():
        a.add_argument("folder", nargs="?")
    h["collect"].add_argument("--dry-run", action="store_true")
    return p


def _rows(df, most: int) -> None:
    """One line per row; payloads are cut."""
    for r in df.limit(most).collect():
        row = r.asDict(recursive=True)
        if isinstance(row.get("payload"), str):
            row["payload"] = preview(row["payload"], PAYLOAD)
        print(preview(json.dumps(row, default=str, ensure_ascii=False), PAYLOAD + ROW))


def _outcomes(report) -> int:
    for name, o in report.items():
        failing = {c: n for c, n in o.checks.items() if n}
        print(f"{o.status:9} {name} {o.seconds:.1f} s {failing or ''} {o.error[:200]}".rstrip())
    return int(any(o.status in ("failed", "skipped") for o in report.values()))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    settings = Settings.load()
    root = (args.root or settings.root).rstrip("/")
    if args.command == "version":
        print(__version__)
        return 0
    if args.command == "sources":
        print("\n".join(SOURCES))
        return 0
    if args.command == "config":
        print(json.dumps(settings.shown() | {"schedule": SCHEDULE}, indent=1))
        return 0
    if args.command == "doctor":
        return _doctor(root)

    from tidewatch.pipeline import Pipeline
    from tidewatch.session import local_session

    spark = local_session()
    pipe = Pipeline(spark, root, getattr(args, "as_of", None), settings.honeypot)
    return globals()[f"_{args.command}"](args, spark, pipe, settings)


def _doctor(root: str) -> int:
    found = {"python": sys.version.split()[0], "java": shutil.which("java") or os.environ.get("JAVA_HOME"), "root": "writable" if os.access(root if os.path.isdir(root) else os.path.dirname(os.path.abspath(root)) or ".", os.W_OK) else None}
    try:
        import pyspark

        found["pyspark"] = pyspark.__version__
    except ImportError:
        found["pyspark"] = None
    print(json.dumps(found, indent=1))
    return int(not all(found.values()))


def _collect(args, spark, pipe, settings) -> int:
    from tidewatch.sources.collect import collect, from_file
    from tidewatch.sources.sinks import ConsoleSink, CountingSink, JsonlSink

    sink = CountingSink() if args.dry_run else ConsoleSink() if args.to == "console" else JsonlSink(f"{pipe.root}/landed") if args.to == "files" else _topic_sink(pipe, args.source)
    done = collect(args.source, from_file(spark, args.source, args.path), sink, args.limit)
    print(json.dumps(asdict(done)))
    return int(done.status != "success")


def _topic_sink(pipe, source: str):
    from tidewatch.lake.table import Table
    from tidewatch.streaming.topics import spec_of

    class TopicSink:
        def write(self, df) -> int:
            pipe.log.create(spec_of(source))
            return pipe.log.produce(spec_of(source).name, df, dead=Table(pipe.spark, f"{pipe.root}/dead_letters", DEAD_LETTER, "failed_at"))["delivered"]

        def close(self) -> None:
            pass

    return TopicSink()


def _topics(args, spark, pipe, settings) -> int:
    from tidewatch.streaming.topics import spec_of

    for s in [args.source] if args.action == "delete" else SOURCES:
        spec, log = spec_of(s), pipe.log
        there = log.exists(spec.name)
        said = {
            "init": lambda: log.create(spec, args.dry_run),
            "describe": lambda: log.describe(spec.name) if there else "missing",
            "counts": lambda: log.counts(spec.name) if there else "missing",
            "reconcile": lambda: log.reconcile(spec, apply=not args.dry_run),
            "retain": lambda: f"{log.retain(spec.name)} files dropped" if there else "missing",
            "delete": lambda: log.delete(spec.name, args.dry_run),
        }[args.action]()
        print(spec.name, said)
    return 0


def _tail(args, spark, pipe, settings) -> int:
    from pyspark.sql import functions as F

    from tidewatch.streaming.bronze import WIRE_SCHEMA
    from tidewatch.streaming.topics import spec_of

    name = spec_of(args.source).name
    if pipe.log.counts(name):
        _rows(spark.read.schema(WIRE_SCHEMA).parquet(f"{pipe.root}/topics/{name}/data").orderBy(F.desc("_appended_at"), F.desc("_offset")), args.rows)
    return 0


def _lag(args, spark, pipe, settings) -> int:
    from tidewatch.streaming.topics import spec_of

    behind = pipe.log.lag(spec_of(args.source).name, pipe.checkpoint(args.source))
    print(json.dumps({"partitions": behind, "total": sum(behind.values())}))
    return 0


def _lake(args, spark, pipe, settings) -> int:
    from tidewatch.lake.table import Table
    from tidewatch.streaming.bronze import sync_all

    table = pipe.bronze(args.source) if getattr(args, "source", None) else None
    if args.action == "init":
        for s in SOURCES:
            print(s, pipe.bronze(s).create())
    elif args.action == "sync":
        print(json.dumps(sync_all(spark, pipe.log, pipe.root, [args.source] if args.source else SOURCES, args.replay)))
    elif args.action == "tables":
        for name, t in {**{f"bronze.{s}": pipe.bronze(s) for s in SOURCES}, "ops.pipeline_run": pipe.ops.runs, "ops.ingestion_watermark": pipe.ops.watermarks}.items():
            print(name, json.dumps(t.stats()))
        print("\n".join(pipe.warehouse.names()))
    elif args.action == "history":
        _rows(table.history(), args.rows)
    elif args.action == "sample":
        _rows(table.read(version=args.version_no), args.rows)
    elif args.action == "compact":
        print(json.dumps(table.compact()))
    elif args.action == "expire":
        print(table.expire(), "folders dropped")
    elif args.action == "letters":
        _rows(Table(spark, f"{pipe.root}/dead_letters", DEAD_LETTER, "failed_at").read(), args.rows)
    else:
        _sql(spark, args.statement, {f"bronze_{s}": (lambda s=s: pipe.bronze(s).read()) for s in SOURCES})
    return 0


def _sql(spark, statement: str, tables) -> None:
    from tidewatch.adhoc import ask, register

    register(spark, tables)
    _rows(ask(spark, statement), 50)


def _model(args, spark, pipe, settings) -> int:
    graph = pipe.graph()
    if args.action == "build":
        return _outcomes(pipe.run(args.job, args.select))
    if args.action == "test":
        bad = 0
        for name in [n for n in graph.order() if n in graph.select(args.select) and graph.models[n].checks and n.split(".")[0] in ("staging", "silver", "gold")]:
            try:
                failing = graph.check(name, pipe.load)
            except LookupError as e:
                failing = {str(e): 1}
            bad += any(failing.values())
            print(name, failing)
        return int(bad > 0)
    if args.action == "docs":
        for before, after in graph.lineage():
            print(f"{before} -> {after}")
    elif args.action == "show":
        df = pipe.load(args.name)
        if df is None:
            print(f"{args.name} was never built")
            return 1
        _rows(df, args.rows)
    else:
        _sql(spark, args.statement, {n.replace(".", "_"): (lambda n=n: pipe.warehouse.read(n)) for n in pipe.warehouse.names()})
    return 0


def _ml(args, spark, pipe, settings) -> int:
    if args.action == "runs":
        _rows(pipe.runs.newest(), 20)
        return 0
    if args.action == "ask":
        from tidewatch.ml import marts, search

        index, kev = pipe.warehouse.read("ml.cve_embeddings"), pipe.warehouse.read("silver.kev_vulnerabilities")
        if index is None or kev is None:
            print("no index: run ml embed first")
            return 1
        _rows(search.ask(index, marts.document(kev), "cve_id", "text", pipe.embedder, args.question, args.top), args.top)
        return 0
    model = {"campaigns": "ml.url_campaigns+", "ransomware": "ml.kev_ransomware_scores+", "embed": "ml.cve_embeddings", "sessions": "ml.honeypot_session_anomalies"}[args.action]
    if args.action == "sessions" and not settings.honeypot:
        print("the honeypot's models are off (TIDEWATCH_HONEYPOT)")
        return 1
    return _outcomes(pipe.run(pattern=model))


def _publish(args, spark, pipe, settings) -> int:
    from tidewatch import export

    read = pipe.warehouse.read
    payloads = export.build(read, load_key(os.environ))
    sessions = read("silver.honeypot_sessions")
    models = {n: at for n in pipe.warehouse.names() if (at := pipe.warehouse.built_at(n))}
    names = export.publish(spark, args.folder, payloads, None if sessions is None else sessions.select("src_ip").distinct(), settings.run_url or None, settings.revision or None, models)
    print("\n".join(names))
    return 0


def _honeypot(args, spark, pipe, settings) -> int:
    import shlex

    from tidewatch.sources import rotating_log as log
    from tidewatch.sources.collect import collect
    from tidewatch.sources.envelope import envelope
    from tidewatch.sources.feeds import honeypot_lines
    from tidewatch.sources.sinks import CountingSink

    folder, live = args.folder or settings.log_folder, "cowrie.json"
    remote = log.RemoteLogs(shlex.split(settings.log_command), live) if settings.log_command else None
    if args.action == "files":
        for f in remote.files() if remote else log.list_logs(folder, live):
            print(f.inode, f.size, f.name)
        return 0
    if remote:
        print(remote.fetch(folder), "bytes fetched")
    if args.action == "fetch":
        return 0
    from pyspark.sql import functions as F

    spark.dataSource.register(log.RotatingLog)
    reports = []

    def write(batch, batch_id: int) -> None:
        good, _ = honeypot_lines(batch.where("not rejected"), "line")
        sink = CountingSink() if args.dry_run else _topic_sink(pipe, "cowrie")
        done = collect("cowrie", lambda run: envelope(good, "cowrie", F.col("event_type"), run), sink)
        reports.append(asdict(done))
        if done.status != "success":
            raise RuntimeError(done.error)  # the place in the log isn't moved on

    place = f"{pipe.root}/checkpoints/honeypot-log"
    if args.dry_run:  # a dry run reads from a place of its own and keeps none
        from tidewatch.storage import shared_dir

        place = f"{shared_dir(spark)}/dry-run-{os.getpid()}"
    q = spark.readStream.format("rotating_log").load(folder).writeStream.foreachBatch(write).option("checkpointLocation", place).trigger(availableNow=True).start()
    q.awaitTermination()
    print(json.dumps(reports))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
