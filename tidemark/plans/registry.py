"""Named queries over the driver tables and the SQL that states what each must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.runtime import ship

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return keep


def _load() -> None:
    from tidemark.plans import analytics, ingest, models, series, texts  # noqa: F401  they register their queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
