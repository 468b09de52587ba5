"""Jobs around the tables: refresh with a status document and a lease, and Markdown reports."""

from __future__ import annotations

import json
import os
import socket
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.privacy import anonymize, map_of, new_salt, save_map, stored_salt
from tidemark.functions.text import strip_signature, subject_and_body, tokens
from tidemark.functions.vector import hashed_embedding
from tidemark.operators.analytics import cluster_labels, cluster_summary, histogram, noise_share, null_shares, recommend, time_range, value_counts_all
from tidemark.operators.density import density_clusters
from tidemark.operators.evaluation import class_report, macro_f1, stratified_split
from tidemark.operators.manifold import embed_manifold
from tidemark.operators.models import TARGETS, enrich_module, impute, save_imputer, save_metrics, train_imputer
from tidemark.operators.series import HORIZON, daily_with_all, evaluate_seasonal, monthly_trend, overall, seasonal_forecast, volume, weekday_means
from tidemark.runtime import checkpoint
from tidemark.sources.files import modules_in, page_records, read_pages, read_processed, sample, write_processed
from tidemark.sources.landing import land_details, land_module, landed_details
from tidemark.sources.rest import MODULES, Settings
from tidemark.sources.storage import Store
from tidemark.sources.tables import build


def set_status(store: Store, name: str, **values) -> dict:
    """Update the status document, which may be missing or damaged."""
    status = (store.read_json(name) or {}) | values | {"updated_at": datetime.now(timezone.utc).isoformat()}
    store.write_json(name, status)
    return status


class Superseded(RuntimeError):
    """Another run has taken the lease over."""


class Lease:
    """A lock that ends by itself, on any filesystem that Spark reads.

    Each holder makes a document of the next number under the folder, which only one can make; the number fences: a
    holder whose number is no longer the last has lost the lease. It lasts ``seconds`` from when it was last renewed, which a
    thread does, so that of a run that died, or that left an empty or damaged document, is taken over once it is over.
    """

    def __init__(self, store: Store, folder: str, seconds: float = 120.0, now: Callable[[], float] = time.time):
        self.store, self.folder, self.seconds, self.now = store, folder, seconds, now
        self.number, self._over = 0, threading.Event()

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:012d}"

    def _last(self) -> int:
        names = Store(self.store.spark, f"{self.store.root}/{self.folder}").names()
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _until(self, number: int) -> float:
        """When the lease of a number ends; that of a document that says nothing, as long after it was written."""
        said = self.store.read_json(self._name(number))
        until = said.get("until") if isinstance(said, dict) else None
        return float(until) if isinstance(until, (int, float)) else self.store.modified(self._name(number)) + self.seconds

    def _document(self, until: float) -> dict:
        return {"owner": f"{socket.gethostname()}:{os.getpid()}", "until": until}

    def acquire(self) -> int:
        """The lease's number; RuntimeError if another run has it."""
        last = self._last()
        if last and self._until(last) > self.now():
            raise RuntimeError("another refresh is running")
        if not self.store.create(self._name(last + 1), json.dumps(self._document(self.now() + self.seconds))):
            raise RuntimeError("another refresh has just begun")
        for n in range(max(1, last - 8), last):  # the last one stays, for its number
            self.store.delete(self._name(n))
        self.number = last + 1
        return self.number

    def check(self) -> None:
        if self._last() != self.number:
            raise Superseded(f"the lease {self.number} has been taken over")

    def renew(self) -> None:
        self.check()
        self.store.write_json(self._name(self.number), self._document(self.now() + self.seconds))

    def release(self) -> None:
        if self._last() == self.number:
            self.store.write_json(self._name(self.number), self._document(0))

    def __enter__(self) -> Lease:
        self.acquire()

        def keep():
            while not self._over.wait(self.seconds / 3):
                try:
                    self.renew()
                except Superseded:
                    return

        self._over.clear()
        self._thread = threading.Thread(target=keep, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._over.set()
        self._thread.join()
        self.release()


def refresh(steps: list[tuple[str, Callable[[], None]]], store: Store, status: str = "status.json", lock: str = "refresh.lock", seconds: float = 120.0) -> dict:
    """Run the steps in order; the status document says which one runs, and what went wrong. A run that has lost its lease stops
    before its next step and writes no status."""
    with Lease(store, lock, seconds) as lease:
        set_status(store, status, state="running", fence=lease.number, error=None)
        for name, step in steps:
            lease.check()
            set_status(store, status, step=name)
            try:
                step()
            except Exception as e:
                lease.check()
                set_status(store, status, state="failed", error=f"{name}: {e}")
                raise
        lease.check()
        return set_status(store, status, state="done", step=None)


def run_modules(modules: list[str], job: Callable[[str], None]) -> dict[str, str | None]:
    """Each module's error, or None; one that fails does not stop the others."""
    out: dict[str, str | None] = {}
    for m in modules:
        try:
            job(m)
            out[m] = None
        except Exception as e:  # noqa: BLE001
            out[m] = str(e)
    return out


@dataclass
class Counters:
    """What an extract has done; ``errors`` says what went wrong with a module, ``failed`` counts records without details."""

    pages: int = 0
    records: int = 0
    details: int = 0
    details_skipped: int = 0
    failed: int = 0
    errors: list[str] = field(default_factory=list)


def extract(spark: SparkSession, settings: Settings, modules: list[str], raw: str, limit: int | None = None, details: bool = True, notes: bool = True) -> dict[str, Counters]:
    """Land the modules' pages, and the details that have not landed yet, by tasks of the executors.

    The ids come from the landed pages. A module that fails has the error among its counters and stops no other; a
    record that fails is counted, and ``failed_details`` says why.
    """
    settings, out = settings.connected(), {}
    for module in modules:
        c = out[module] = Counters()
        try:
            landed = land_module(spark, settings, module, raw, limit)
            c.pages, c.records = landed.pages, landed.records
            if MODULES[module][0] and details and landed.pages:
                rows = page_records(read_pages(spark, f"{raw}/{module}/page_*.json"), module)
                got, c.details_skipped = land_details(rows.select(F.try_variant_get("record", "$.id", "string").alias("id")), settings, module, f"{raw}/details/{module}", notes)
                c.details, c.failed = got.details, got.errors
        except Exception as e:  # noqa: BLE001  one module must not sink the rest
            c.errors.append(f"{module}: {e}")
    return out


def preprocess(spark: SparkSession, raw: str, processed: str, modules: list[str] | None = None, anonymous: bool = False, samples: list[str] = (), as_csv: bool = False) -> list[str]:
    """Flat tables of the landed modules, and their anonymous twins; the names of the modules that had records."""
    done, salt = [], (stored_salt(spark, f"{processed}/anon_map") or new_salt()) if anonymous else None
    jobs = [(m, recs, None) for recs, m in (sample(spark, s) for s in samples)]
    if not samples:
        for m in modules or modules_in(spark, raw):
            folder = f"{raw}/details/{m}"
            known = landed_details(spark, folder)
            known = known and known.select("id", F.try_parse_json("bundle").alias("bundle"))
            if Store(spark, raw).exists(m):
                jobs.append((m, page_records(read_pages(spark, f"{raw}/{m}/page_*.json"), m), known))
    for m, recs, details in jobs:
        if recs.isEmpty():
            continue
        table = build(recs, m, details)
        write_processed(table, processed, m, as_csv)
        if anonymous:
            write_processed(anonymize(table, salt), processed, f"{m}_anon", as_csv)
            if (entries := map_of(table, salt)) is not None:
                save_map(entries, salt, f"{processed}/anon_map")
        done.append(m)
    return done


def train(spark: SparkSession, processed: str, artefacts: str, modules: list[str] | None = None) -> list[dict]:
    """A saved imputer for each target that has enough labelled rows, and its metrics by (module, column)."""
    out = []
    for t in (t for t in TARGETS if modules is None or t.module in modules):
        df = read_processed(spark, processed, t.module, enriched=False)
        if df is None or t.column not in df.columns:
            continue
        known = stratified_split(df.where(F.col(t.column).isNotNull()), t.column, "id")
        model = train_imputer(known.where(~F.col("is_test")), t)
        if model is None:
            continue
        save_imputer(model, t, artefacts)
        test = known.where("is_test").withColumnsRenamed({t.column: "__truth"}).withColumn(t.column, F.lit(None).cast("string"))
        report = class_report(impute(test, t, model), "__truth", t.column)
        row = macro_f1(report).first()
        out.append({"module": t.module, "column": t.column, "macro_f1": row.macro_f1, "n_labels": row.n_labels, "trained_at": datetime.now(timezone.utc).isoformat()})
    save_metrics(spark, out, artefacts)
    return out


def predict(spark: SparkSession, processed: str, artefacts: str, modules: list[str] | None = None, as_csv: bool = False) -> list[str]:
    """The enriched tables of modules that have saved models; their names."""
    done = []
    for m in modules or sorted({t.module for t in TARGETS}):
        df = read_processed(spark, processed, m, enriched=False)
        rich = None if df is None else enrich_module(df, m, artefacts)
        if rich is not None:
            write_processed(rich, processed, f"{m}_enriched", as_csv)
            done.append(m)
    return done


def markdown(df: DataFrame, title: str, rows: int | None = None, said: str = "") -> str:
    """A report of a small result: a title, what is said of it, and a table of all rows, or of the first ``rows``."""
    got = (df if rows is None else df.limit(rows)).collect()
    line = lambda xs: "| " + " | ".join("" if x is None else f"{x:,.4g}" if isinstance(x, float) else str(x).replace("|", "\\|") for x in xs) + " |"
    return "\n".join([f"## {title}", "", *([said, ""] if said else []), line(df.columns), line(["---"] * len(df.columns)), *map(line, got), ""])


def report(spark: SparkSession, folder: str, name: str, title: str, parts: list[tuple[str, str, DataFrame]]) -> None:
    """A Markdown document of several tables (title, what is said of it, result)."""
    made = f"*{datetime.now(timezone.utc):%Y-%m-%d %H:%M} UTC*"
    Store(spark, folder).write(name, [f"# {title}\n\n{made}\n\n", *(markdown(df, t, said=said) + "\n" for t, said, df in parts)])


def explore(spark: SparkSession, processed: str, folder: str, module: str = "requests") -> None:
    """The exploration report of a module: null shares, most frequent values, volumes, fitness of the labels."""
    df = read_processed(spark, processed, module)
    if df is None:
        raise FileNotFoundError(f"no table {module} in {processed}")
    fields = [c for c in ("status", "priority", "group", "template", "site", "category", "technician_name", "lang") if c in df.columns]
    parts = [("Labels without a value", "", null_shares(df, fields)), ("Most frequent values", "", value_counts_all(df, fields, 15).orderBy("field", F.desc("n")))]
    time = next((c for c in ("created_time", "reported_time") if c in df.columns), None)
    if time:
        parts += [("From and to", "", time_range(df, time)), ("By month", "", volume(df, time, "M").orderBy("bucket"))]
    if "resolution_hours" in df.columns:
        parts.append(("Hours to resolution", "", histogram(df, "resolution_hours").orderBy("bin")))
    if {"group", "is_overdue"} <= set(df.columns):
        parts.append(("What can be learnt", "", recommend(df, "group", F.col("is_overdue"))))
    report(spark, folder, f"{module}.md", module, parts)


def cluster(spark: SparkSession, processed: str, folder: str, module: str = "requests", top: int = 10, **how) -> DataFrame | None:
    """Density clusters of a module's texts: ``{module}_clusters`` beside its table, and the report of recurring issues.

    The anonymous table serves if there is one. ``how`` goes to ``density_clusters``.
    """
    df = next((t for n in (f"{module}_anon", module) if (t := read_processed(spark, processed, n, enriched=False)) is not None), None)
    if df is None:
        return None
    column = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    rows = df.withColumn("text", strip_signature(subject_and_body(column("subject"), column("description"))))
    vectors = embed_manifold(rows.withColumn("__embedding", hashed_embedding(F.col("text"))), "id", "__embedding")
    write_processed(density_clusters(vectors, "id", "__embedding", **how).drop("__embedding"), processed, f"{module}_clusters")
    found = read_processed(spark, processed, f"{module}_clusters", enriched=False)
    modes = [c for c in ("group", "priority", "site") if c in df.columns]
    largest = cluster_summary(found, "cluster", modes, top)
    named = largest.join(cluster_labels(found, "cluster", tokens(F.col("text"))), "cluster").orderBy(F.desc("n"), "cluster")
    parts = [("Rows, noise and clusters", "", noise_share(found, "cluster")), ("Largest clusters", "", named)]
    time = next((c for c in ("created_time", "reported_time") if c in df.columns), None)
    if time:
        trend = monthly_trend(found.join(F.broadcast(largest.select("cluster")), "cluster"), time, ["cluster"])
        parts.append(("Trends", "The last three months against those before.", trend.orderBy("cluster")))
    report(spark, folder, f"{module}_clusters.md", f"Recurring issues: {module}", parts)
    return found


def forecast(spark: SparkSession, processed: str, folder: str, module: str = "requests", group: str = "group", horizon: int = HORIZON) -> DataFrame | None:
    """Forecasts of all rows and of the three largest groups: ``{module}_forecast`` beside its table, and the report of how the model does
    against the naive forecast on the last days."""
    df = read_processed(spark, processed, module, enriched=False)
    time = next((c for c in ("created_time", "reported_time") if df is not None and c in df.columns), None)
    if time is None or group not in df.columns:
        return None
    daily = checkpoint(daily_with_all(df, time, group))
    write_processed(seasonal_forecast(daily, "group", horizon), processed, f"{module}_forecast")
    verdicts = checkpoint(evaluate_seasonal(daily, "group", horizon))
    made = read_processed(spark, processed, f"{module}_forecast", enriched=False)
    totals = made.groupBy("group").agg(*[F.sum(c).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")]).orderBy("group")
    weekdays = weekday_means(daily.where("group = 'ALL'")).select("weekday", (F.col("total") / F.col("days")).alias("mean")).orderBy("weekday")
    parts = [("Model against naive", f"The last {horizon} days held out.", verdicts.orderBy("group")), ("Recommendation", "", overall(verdicts)), (f"Next {horizon} days", "", totals), ("By weekday (Monday is 0)", "", weekdays)]
    report(spark, folder, f"{module}_forecast.md", f"Forecast: {module}", parts)
    return made
