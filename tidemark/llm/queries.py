"""The queries opN_<name> of this subpackage, each a thin digest of its operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("webp", "chat", "token_file", "piece_counts", "pii", "decontaminate", "stream_bpe", "simhash", "quality", "toxicity", "periodic", "repair", "suffix")


def _modules():
    import importlib

    return [importlib.import_module(f"tidemark.llm.{m}") for m in _MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.QUERY: m.query for m in _modules()}


def oracle_sql() -> dict[str, str]:
    return {m.QUERY: m.ORACLE_SQL for m in _modules() if getattr(m, "ORACLE_SQL", None)}
