"""Landed pages, processed tables and small documents."""

from __future__ import annotations

import csv
import io
import json
import logging
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.analytics import first_per_key
from tidemark.sources.storage import Store

log = logging.getLogger(__name__)
BYTE_ORDER_MARK = "\ufeff"


def land_pages(spark: SparkSession, pages: Iterable[dict], folder: str, module: str) -> list[str]:
    """Write pages as ``page_0001.json`` and on, and return the records' ids.

    They go to a folder of their own, which takes the place of the module's folder once the last page
    is there: an extract that fails leaves the last good one as it was.
    """
    from tidemark.sources.rest import records

    store, new = Store(spark, folder), f".landing-{module}-{uuid.uuid4().hex}"
    landing, ids = Store(spark, f"{folder}/{new}"), []
    landing.write_json(".started", {"module": module})
    try:
        for n, page in enumerate(pages, 1):
            landing.write_json(f"page_{n:04d}.json", page)
            ids += [str(r["id"]) for r in records(page, module) if r.get("id") is not None]
        landing.delete(".started")
        store.replace(new, module)
    except BaseException:
        store.delete(new)
        raise
    return ids


def write_json(value, path) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def read_json(path) -> dict | None:
    """A JSON document, or None if there is none or it is damaged."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None


def modules_in(spark: SparkSession, folder: str) -> list[str]:
    """Module folders, without that of the details and hidden ones."""
    return [m for m in Store(spark, folder).folders() if m != "details" and not m.startswith(".")]


def sample(spark: SparkSession, spec: str) -> tuple[DataFrame, str]:
    """(page records, module) of a single page given as ``path:module``."""
    path, _, module = spec.rpartition(":")
    if not path or not module:
        raise ValueError(f"a sample is given as path:module, not {spec!r}")
    return page_records(read_pages(spark, path), module), module


def locate(page: Column, module: str) -> Column:
    """The records of a page held as a variant: the module's own list, else the first list of objects, else none."""
    own = F.try_variant_get(page, f"$.{module}", "array<variant>")
    fields = F.map_values(F.try_variant_get(page, "$", "map<string,variant>"))
    lists = F.transform(fields, lambda v: F.try_variant_get(v, "$", "array<variant>"))
    objects = F.filter(lists, lambda xs: F.coalesce(F.size(xs) > 0, F.lit(False)) & F.forall(xs, lambda x: F.schema_of_variant(x).startswith("OBJECT")))
    return F.coalesce(own, F.get(objects, F.lit(0)), F.array().cast("array<variant>"))


def page_records(pages: DataFrame, module: str) -> DataFrame:
    """(file, position, record): the records of pages (file, value) in their order, as variants."""
    rows = pages.select("file", F.try_parse_json("value").alias("p"))
    return rows.select("file", F.posexplode(locate(F.col("p"), module)).alias("position", "record"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of each JSON page under a path."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """(id, bundle): detail files, named by their records' ids."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("id"), F.try_parse_json("value").alias("bundle"))


def dedup(records: DataFrame) -> DataFrame:
    """Of records with the same id the first by page and position."""
    return first_per_key(records.withColumn("id", F.try_variant_get("record", "$.id", "string")), ["id"], ["file", "position"])


def read_processed(spark: SparkSession, folder: str, name: str, enriched: bool = True) -> DataFrame | None:
    """The enriched table, else the plain one, as Parquet, else CSV, else None; on any filesystem."""
    store = Store(spark, folder)
    for table in (f"{name}_enriched", name) if enriched else (name,):
        if store.exists(f"{table}.parquet"):
            return spark.read.parquet(f"{folder}/{table}.parquet")
        if store.exists(f"{table}.csv"):
            rows = spark.read.option("multiLine", True).option("escape", '"').csv(f"{folder}/{table}.csv", header=True)
            return rows.toDF(*[c.removeprefix(BYTE_ORDER_MARK) for c in rows.columns])
    return None


def write_processed(df: DataFrame, folder: str, name: str, as_csv: bool = False) -> str | None:
    """The table as Parquet and, if asked, as one CSV file with a byte order mark.

    With a CSV file to fall back on, a Parquet write that fails is logged and its message returned.
    """
    if not as_csv:
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        return None
    export_csv(df, folder, f"{name}.csv")
    try:
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    except Exception as e:  # noqa: BLE001  the CSV file is there
        log.warning("no Parquet table %s: %s", name, e)
        return str(e)
    return None


def csv_lines(df: DataFrame) -> Iterator[str]:
    """The table as CSV text with a byte order mark, a partition at a time on the driver."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    out.write(BYTE_ORDER_MARK)
    writer.writerow(df.columns)
    for row in df.toLocalIterator():
        writer.writerow(row)
        if out.tell() > 1 << 20:
            yield out.getvalue()
            out.seek(0)
            out.truncate()
    yield out.getvalue()


def export_csv(df: DataFrame, folder: str, name: str) -> None:
    """All rows as one CSV file for spreadsheets; the driver holds a partition at most."""
    Store(df.sparkSession, folder).write(name, csv_lines(df))
