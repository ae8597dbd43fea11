"""The lakehouse's models and their checks as one graph, from the topics to the ML layer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import quality as q
from tidewatch.dag import Graph, Model, Outcome
from tidewatch.lake.ops import Operations
from tidewatch.lake.table import Table
from tidewatch.ml import marts, search
from tidewatch.ml.runs import Runs
from tidewatch.models import layers as m
from tidewatch.schemas import BRONZE, SOURCES
from tidewatch.streaming.bronze import sync
from tidewatch.streaming.topics import TopicLog, spec_of
from tidewatch.warehouse import Warehouse

#: What the graph's jobs build.
JOBS = {"all": None, "models": ("staging", "silver", "gold"), "ml": ("ml",)}
HONEYPOT = ("staging.stg_cowrie", "silver.honeypot_events", "silver.honeypot_sessions", "ml.honeypot_session_anomalies")
# The least lifts that the metrics of campaigns and of the classifier must show.
LEAST_SUBNET_LIFT, LEAST_PRECISION_LIFT = 2.0, 1.5


def lift_at_least(metrics: DataFrame, least: float, lift: str = "lift") -> DataFrame:
    """The row of a one-row metrics table if its lift is too small; an undefined lift passes only with a positive rate within clusters."""
    undefined = F.col(lift).isNull()
    fails = F.col(lift) < least
    if "within_rate" in metrics.columns:
        fails = F.coalesce(fails, undefined & ~(F.col("within_rate") > 0))
    return metrics.where(F.coalesce(fails, F.lit(True)))


def caught_up(lag: Mapping[int, int]) -> bool:
    return not any(lag.values())


def every_key_has_a_vector(records: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Keys without a vector; for no records at all, one row."""
    return records.select(key).join(index.select(key), key, "left_anti").unionByName(q.has_rows(records).select(F.lit("(no records)").alias(key)))


def stale_rows(spark: SparkSession, last: str | None, level: str, now: datetime | None = None) -> DataFrame:
    """One row if a table's age, by its last commit, is at ``level`` (``warn`` or ``fail``)."""
    age = None if last is None else ((now or datetime.now(timezone.utc)) - datetime.fromisoformat(last)).total_seconds() / 3600
    return spark.createDataFrame([(age,)] if q.freshness(age) == level else [], "age_hours double")


def _checks() -> dict[str, Callable[..., list[q.Check]]]:
    """The checks of each model; they get the model and what it was made from. Staging identities may repeat (a warning: deliveries do); silver keys may not."""

    def keyed(key: str, *needed: str):
        return lambda df, *_: [q.Check(f"unique:{key}", q.unique(df, key)), *(q.Check(f"not_null:{c}", q.not_null(df, c)) for c in (key, *needed))]

    def staged(df: DataFrame, *_) -> list[q.Check]:
        return [q.Check("not_null:event_id", q.not_null(df, "event_id")), q.Check("unique:event_id", q.unique(df, "event_id"), q.WARN)]

    def addresses(key: str, *needed: str):
        return lambda df, *_: [*keyed(key, *needed)(df), q.Check(f"no_documentation:{key}", q.no_documentation_addresses(df, key))]

    def kev(df: DataFrame, stg: DataFrame) -> list[q.Check]:
        return [*keyed("cve_id")(df), q.Check("matches_staging", q.same_total(df.agg(F.count(F.lit(1))), stg.agg(F.countDistinct("cve_id"))))]

    def urls(df: DataFrame, *_) -> list[q.Check]:
        return [*keyed("url")(df), q.Check("accepted_values:url_status", q.accepted_values(df, "url_status", ["online", "offline", "unknown"]), q.WARN)]

    def vendors(df: DataFrame, kev: DataFrame) -> list[q.Check]:
        totals = q.same_total(df.agg(F.coalesce(F.sum("exploited_cves"), F.lit(0)).cast("long")), kev.agg(F.count(F.lit(1))))
        return [q.Check("unique:vendor", q.unique(df, "vendor")), q.Check("has_rows", q.has_rows(df)), q.Check("totals_reconcile", totals)]

    def sessions(df: DataFrame, *_) -> list[q.Check]:
        return [*keyed("session_id", "src_ip")(df), q.Check("no_documentation:src_ip", q.no_documentation_addresses(df, "src_ip")), q.Check("accepted_values:protocol", q.accepted_values(df, "protocol", ["ssh", "telnet"]), q.WARN), q.Check("has_rows", q.has_rows(df), q.WARN)]

    return {
        **{f"staging.{n}": staged for n in ("stg_cisa_kev", "stg_urlhaus", "stg_feodo", "stg_tor_exit", "stg_cowrie")},
        "silver.kev_vulnerabilities": kev,
        "silver.urlhaus_urls": urls,
        "silver.feodo_c2_servers": addresses("ip_address"),
        "silver.tor_exit_nodes": addresses("ip_address", "is_current_exit"),
        "silver.honeypot_events": keyed("content_hash", "session_id"),
        "silver.honeypot_sessions": sessions,
        "gold.vendor_exploitation": vendors,
        "gold.malware_url_tags": keyed("tag"),
        "gold.c2_infrastructure": keyed("ip_address", "hosting_type"),
        "ml.url_campaign_metrics": lambda df, *_: [q.Check("subnet_lift", lift_at_least(df, LEAST_SUBNET_LIFT), q.WARN)],
        "ml.kev_ransomware_metrics": lambda df, *_: [q.Check("precision_lift", lift_at_least(df, LEAST_PRECISION_LIFT), q.WARN)],
        "ml.cve_embeddings": lambda df, kev, *_: [q.Check("every_cve_has_a_vector", every_key_has_a_vector(kev, df, "cve_id"))],
    }


def lakehouse(bronze: Callable[[], DataFrame], as_of, with_honeypot: bool = True) -> Graph:
    """Bronze to gold over one table of events."""
    first = [Model("bronze.events", bronze, checks=lambda df: [q.Check("has_rows", q.has_rows(df))])]
    return Graph([*first, *_tables("bronze.events", as_of, with_honeypot)])


def _tables(events: str, as_of, with_honeypot: bool) -> list[Model]:
    checks = _checks()
    made = [
        *((f"staging.{f.__name__}", f, (events,)) for f in (m.stg_cisa_kev, m.stg_urlhaus, m.stg_feodo, m.stg_tor_exit, m.stg_cowrie)),
        ("silver.kev_vulnerabilities", m.kev_vulnerabilities, ("staging.stg_cisa_kev",)),
        ("silver.urlhaus_urls", m.urlhaus_urls, ("staging.stg_urlhaus",)),
        ("silver.feodo_c2_servers", m.feodo_c2_servers, ("staging.stg_feodo",)),
        ("silver.tor_exit_nodes", m.tor_exit_nodes, ("staging.stg_tor_exit",)),
        ("silver.honeypot_events", m.honeypot_events, ("staging.stg_cowrie",)),
        ("silver.honeypot_sessions", m.honeypot_sessions, ("silver.honeypot_events",)),
        ("gold.vendor_exploitation", lambda kev: m.vendor_exploitation(kev, as_of), ("silver.kev_vulnerabilities",)),
        ("gold.malware_url_tags", m.malware_url_tags, ("silver.urlhaus_urls",)),
        ("gold.c2_infrastructure", m.c2_infrastructure, ("silver.feodo_c2_servers", "silver.tor_exit_nodes")),
    ]
    return [Model(n, f, deps, checks.get(n)) for n, f, deps in made if with_honeypot or n not in HONEYPOT]


class Pipeline:
    """The whole graph below one folder: topics, Bronze tables, models in the warehouse, records of runs."""

    def __init__(self, spark: SparkSession, root: str, as_of=None, with_honeypot: bool = False, embedder: search.Embedder | None = None, collect: Callable[[str], object] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.log, self.warehouse = TopicLog(spark, f"{self.root}/topics"), Warehouse(spark, self.root)
        self.ops, self.runs = Operations(spark, f"{self.root}/ops"), Runs(spark, f"{self.root}/ml_runs")
        self.as_of, self.with_honeypot = as_of or date.today().isoformat(), with_honeypot
        self.embedder, self.collect = embedder or search.HashedWords(), collect
        self.sources = [s for s in SOURCES if with_honeypot or s != "cowrie"]

    def bronze(self, source: str) -> Table:
        return Table(self.spark, f"{self.root}/bronze/{source}", BRONZE)

    def checkpoint(self, source: str) -> str:
        return f"{self.root}/checkpoints/{source}/bronze"

    def _raw(self, source: str) -> DataFrame:
        """What a source's topic holds after a collection, if there is a collector: ``(partition, rows)``."""
        spec = spec_of(source)
        self.log.create(spec)
        if self.collect is not None:
            self.collect(source)
        return self.spark.createDataFrame(sorted(self.log.counts(spec.name).items()), "partition int, rows long")

    def _sync(self, source: str) -> DataFrame:
        done = sync(self.spark, self.log, spec_of(source).name, f"{self.root}/bronze/{source}", f"{self.root}/dead_letters", self.checkpoint(source))
        self.ops.advance(source, datetime.now(timezone.utc), done["written"])
        return self.bronze(source).read()

    def _bronze_checks(self, source: str):
        def checks(df: DataFrame, *_) -> list[q.Check]:
            lag = self.log.lag(spec_of(source).name, self.checkpoint(source))
            behind = self.spark.createDataFrame([(p, n) for p, n in lag.items() if n], "partition int, rows long")
            last = self.bronze(source).stats()["last_commit"]
            blocking = q.ERROR if source != "cowrie" and self.log.counts(spec_of(source).name) else q.WARN
            return [q.Check("has_rows", q.has_rows(df), blocking), q.Check("caught_up", behind, q.WARN), q.Check("fresh", stale_rows(self.spark, last, "warn"), q.WARN), *([q.Check("not_stale", stale_rows(self.spark, last, "fail"))] if last else [])]

        return checks

    def _ml(self) -> list[Model]:
        checks, made = _checks(), {}

        def campaigns(urls: DataFrame) -> DataFrame:
            with self.runs.run("url_campaigns") as r:
                made.update(marts.campaigns(urls))
                self.warehouse.save_together({n: made[n] for n in ("ml.url_campaigns", "ml.url_campaign_servers")})
                r.metric(campaigns=self.warehouse.read("ml.url_campaigns").count())
                r.param(eps=marts.dbscan.EPS, least=marts.dbscan.LEAST)
            return self.warehouse.read("ml.url_campaigns")

        def scores(kev: DataFrame) -> DataFrame:
            with self.runs.run("kev_ransomware") as r:
                scored, made["metrics"] = marts.ransomware(kev)
                row = made["metrics"].first().asDict()
                r.param(cutoff=row.pop("cutoff"))
                r.metric(**row)
            return scored

        def vectors(kev: DataFrame) -> DataFrame:
            with self.runs.run("cve_embeddings") as r:
                index, stats = marts.embeddings(kev, self.warehouse.read("ml.cve_embeddings"), self.embedder)
                r.param(model=self.embedder.name)
                r.metric(**stats)
            return index

        def unusual(sessions: DataFrame) -> DataFrame | None:
            with self.runs.run("honeypot_sessions") as r:
                found = marts.anomalies(sessions)
                r.tag(outcome="scored" if found is not None else "insufficient_data")
            return found

        kev, urls = "silver.kev_vulnerabilities", "silver.urlhaus_urls"
        models = [
            Model("ml.url_campaigns", campaigns, (urls,), saves_itself=True),
            Model("ml.url_campaign_metrics", lambda *_: made["ml.url_campaign_metrics"], ("ml.url_campaigns",), checks["ml.url_campaign_metrics"]),
            Model("ml.kev_ransomware_scores", scores, (kev,)),
            Model("ml.kev_ransomware_metrics", lambda *_: made["metrics"], ("ml.kev_ransomware_scores",), checks["ml.kev_ransomware_metrics"]),
            Model("ml.cve_embeddings", vectors, (kev,), checks["ml.cve_embeddings"]),
            Model("ml.honeypot_session_anomalies", unusual, ("silver.honeypot_sessions",)),
        ]
        return [x for x in models if self.with_honeypot or x.name not in HONEYPOT]

    def graph(self) -> Graph:
        raw = [Model(f"raw.{s}", lambda s=s: self._raw(s), retries=3) for s in self.sources]
        bronze = [Model(f"bronze.{s}", lambda _, s=s: self._sync(s), (f"raw.{s}",), self._bronze_checks(s)) for s in self.sources]

        def events(*parts: DataFrame) -> DataFrame:
            every = parts[0]
            for p in parts[1:]:
                every = every.unionByName(p)
            return every

        union = Model("bronze.events", events, tuple(b.name for b in bronze), lambda df, *_: [q.Check("has_rows", q.has_rows(df))], after_failure=True)
        return Graph([*raw, *bronze, union, *_tables("bronze.events", self.as_of, self.with_honeypot), *self._ml()])

    def load(self, name: str) -> DataFrame | None:
        """A model that isn't built now, as it was last built."""
        layer, own = name.split(".", 1)
        if layer == "raw":
            return self.spark.createDataFrame([], "partition int, rows long")
        if name == "bronze.events":
            every = [self.bronze(s).read() for s in self.sources]
            for p in every[1:]:
                every[0] = every[0].unionByName(p)
            return every[0]
        if layer == "bronze":
            return self.bronze(own).read()
        if layer == "staging":
            return getattr(m, own)(self.load("bronze.events"))
        return self.warehouse.read(name)

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Views stay views; models of silver, gold and ML get a new version."""
        return df if name.split(".")[0] in ("raw", "bronze", "staging") else self.warehouse.save(name, df)

    def run(self, job: str = "all", pattern: str | None = None) -> dict[str, Outcome]:
        """Build a job's models or those that ``pattern`` selects, and note how it ended; a failure to note it stops nothing."""
        run_id, report, error = uuid.uuid4().hex, {}, ""
        try:
            report = self.graph().run([pattern] if pattern else JOBS[job], self.save, self.load)
            return report
        except Exception as e:
            error = str(e)[:2000]
            raise
        finally:
            failed = [n for n, o in report.items() if o.status != "built"]
            self.ops.record(run_id, pattern or job, "failed" if failed or error else "success", len(report), failed=json.dumps(failed), error=error)
