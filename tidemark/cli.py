"""Command lines: ``python -m tidemark.cli extract|preprocess|train|predict|explore|cluster|forecast|refresh``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--data", default="data", help="folder (any filesystem) of raw, processed, models and reports")
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("extract", help="land pages and details of the ticket system")
    e.add_argument("--modules", default="all")
    e.add_argument("--limit", type=int)
    e.add_argument("--skip-details", action="store_true")
    e.add_argument("--skip-notes", action="store_true")
    e.add_argument("--settings", help="a file of TICKETS_... variables; those of the environment win")
    f = sub.add_parser("preprocess", help="flat tables of what has landed")
    f.add_argument("--modules", nargs="*")
    f.add_argument("--anonymize", action="store_true")
    f.add_argument("--sample", action="append", default=[], help="path:module, instead of what has landed")
    for name, text in (("train", "models for missing labels"), ("predict", "enriched tables")):
        sub.add_parser(name, help=text).add_argument("--modules", nargs="*")
    for name, text in (("explore", "a Markdown report of a module"), ("cluster", "recurring issues: labels and a report"), ("forecast", "forecasts of all and the largest groups, and a report")):
        sub.add_parser(name, help=text).add_argument("--module", default="requests")
    sub.add_parser("refresh", help="extract, preprocess and predict, one run at a time").add_argument("--settings")
    for command in sub.choices.values():
        command.add_argument("--csv", action="store_true", help="write CSV files too")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from tidemark.operators import jobs
    from tidemark.runtime import session, ship
    from tidemark.sources.landing import failed_details
    from tidemark.sources.rest import Settings, parse_modules
    from tidemark.sources.storage import Store

    a = parser().parse_args(argv)
    raw, processed, models = (f"{a.data}/{x}" for x in ("raw", "processed", "models"))
    spark = spark or session("tidemark")
    ship(spark)

    def extract(modules: str = "all", limit=None, details=True, notes=True) -> int:
        got = jobs.extract(spark, Settings.from_env(file=a.settings), parse_modules(modules), raw, limit, details, notes)
        for m, c in got.items():
            print(f"{m}: {c.pages} pages, {c.records} records, {c.details} details ({c.details_skipped} skipped, {c.failed} failed), {len(c.errors)} errors")
            for e in c.errors:
                print(f"  {e}", file=sys.stderr)
            if c.failed:
                failed_details(spark, f"{raw}/details/{m}").orderBy("run", "id").show(20, truncate=False)
        return int(any(c.errors or c.failed for c in got.values()))

    if a.command == "extract":
        return extract(a.modules, a.limit, not a.skip_details, not a.skip_notes)
    if a.command == "preprocess":
        print("tables:", ", ".join(jobs.preprocess(spark, raw, processed, a.modules, a.anonymize, a.sample, a.csv)))
    elif a.command == "train":
        for m in jobs.train(spark, processed, models, a.modules):
            print(f"{m['module']}.{m['column']}: macro F1 {m['macro_f1']:.3f} over {m['n_labels']} labels")
    elif a.command == "predict":
        print("enriched:", ", ".join(jobs.predict(spark, processed, models, a.modules, a.csv)))
    elif a.command == "explore":
        jobs.explore(spark, processed, f"{a.data}/reports", a.module)
    elif a.command in ("cluster", "forecast"):
        if getattr(jobs, a.command)(spark, processed, f"{a.data}/reports", a.module) is None:
            print(f"no table {a.module} with what {a.command} needs", file=sys.stderr)
            return 1
    else:
        steps = [("extract", extract), ("preprocess", lambda: jobs.preprocess(spark, raw, processed, as_csv=a.csv)), ("predict", lambda: jobs.predict(spark, processed, models, as_csv=a.csv))]
        jobs.refresh(steps, Store(spark, a.data))
    return 0


if __name__ == "__main__":
    sys.exit(main())
