"""Landing of what a ticket system says, by tasks, so that a run that dies keeps what it has.

``ticket_pages`` reads whole pages of a module and writes pages as files; ``ticket_details`` takes ids and
lands each record's bundle. Both write through ``pyarrow.fs``, so the folder is on a filesystem that it opens
(local, HDFS, S3, GCS). A file appears whole under its name or not at all: bundles in files of ``per_file``, as they are
fetched, errors in files of their own. Each task tells the driver what it has landed, and the commit leaves the sums in
a document of the run; an abort says so there, and leaves what has landed, which the next run doesn't fetch again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

from tidemark.runtime import ship
from tidemark.sources.rest import Client, Settings, _Range, _Reader, records, settings_of
from tidemark.sources.storage import Store

#: Bundles of a file, and ids of a task.
PER_FILE, PER_TASK = 25, 500


def _place(uri: str):
    """The filesystem of a folder and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri.removeprefix("file:")))


class Folder:
    """Whole files under a folder that tasks share."""

    def __init__(self, uri: str):
        self.fs, self.path = _place(uri)
        self.fs.create_dir(self.path, recursive=True)

    def put(self, name: str, write) -> None:
        """``write`` gets a stream; hidden until it is done."""
        hidden = f"{self.path}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(hidden) as out:
            write(out)
        self.fs.move(hidden, f"{self.path}/{name}")

    def rows(self, columns: dict[str, list]) -> None:
        self.put(f"part-{uuid.uuid4().hex}.parquet", lambda out: pq.write_table(pa.table({k: pa.array(v, pa.string()) for k, v in columns.items()}), out))

    def document(self, name: str, value: dict) -> None:
        self.put(name, lambda out: out.write(json.dumps(value, indent=1).encode()))


@dataclass
class Landed(WriterCommitMessage):
    """What a task has landed."""

    pages: int = 0
    records: int = 0
    details: int = 0
    errors: int = 0


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.options, self.folder, self.run = dict(options), options["folder"], options["run"]

    def _ended(self, how: str, messages) -> None:
        total = asdict(Landed())
        for m in messages:
            total |= {k: total[k] + v for k, v in asdict(m).items()} if m is not None else {}
        Folder(f"{self.folder}/_runs").document(f"{self.run}.json", total | {"ended": how})

    def commit(self, messages):
        self._ended("committed", messages)

    def abort(self, messages):
        self._ended("aborted", messages)


class _DetailWriter(_Writer):
    def write(self, iterator: Iterator) -> Landed:
        client, module = Client(settings_of(self.options)), self.options["module"]
        notes, most = str(self.options.get("notes", "true")).lower() == "true", int(self.options.get("per_file", PER_FILE))
        good, bad = Folder(self.folder), Folder(f"{self.folder}/_errors")
        landed, ids, bundles, failed, why = Landed(), [], [], [], []

        def flush():
            nonlocal ids, bundles, failed, why
            if ids:
                good.rows({"id": ids, "bundle": bundles})
            if failed:
                bad.rows({"run": [self.run] * len(failed), "id": failed, "error": why})
            landed.details, landed.errors = landed.details + len(ids), landed.errors + len(failed)
            ids, bundles, failed, why = [], [], [], []

        for row in iterator:
            try:
                bundles.append(json.dumps(client.bundle(module, row.id, notes), ensure_ascii=False))
                ids.append(row.id)
            except Exception as e:  # noqa: BLE001  one record must not sink the rest
                failed.append(row.id)
                why.append(f"{type(e).__name__}: {e}")
            if len(ids) + len(failed) >= most:
                flush()
        flush()
        return landed


class TicketDetails(DataSource):
    """``df.write.format("ticket_details")`` of a column ``id``, with the options of ``tickets``, and folder, run, notes and per_file."""

    @classmethod
    def name(cls):
        return "ticket_details"

    def schema(self):
        return "id string"

    def writer(self, schema, overwrite):
        return _DetailWriter(self.options)


class _PageReader(_Reader):
    def read(self, partition: _Range):
        for first, got in self.pages(partition):
            yield first, len(records(got, self.module)), json.dumps(got, ensure_ascii=False)


class _PageWriter(_Writer):
    def write(self, iterator: Iterator) -> Landed:
        folder, landed = Folder(self.folder), Landed()
        for row in iterator:
            folder.put(f"page_{row.start:010d}.json", lambda out, row=row: out.write(row.value.encode("utf-8", "surrogatepass")))
            landed.pages, landed.records = landed.pages + 1, landed.records + row.n
        return landed


class TicketPages(DataSource):
    """Whole pages (start, n, value): where a page starts, how many records it has, and its JSON."""

    @classmethod
    def name(cls):
        return "ticket_pages"

    def schema(self):
        return "start long, n int, value string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)

    def writer(self, schema, overwrite):
        return _PageWriter(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    for source in (TicketPages, TicketDetails):
        spark.dataSource.register(source)


def _run_of(spark: SparkSession, folder: str, run: str) -> Landed:
    said = Store(spark, f"{folder}/_runs").read_json(f"{run}.json") or {}
    return Landed(**{k: said.get(k, 0) for k in asdict(Landed())})


def _options(settings: Settings, module: str, folder: str) -> dict[str, str]:
    said = {"url": settings.url, "key": settings.key, "page_size": settings.page_size, "max_retries": settings.max_retries, "wait": settings.wait, "verify": settings.verify, "timeout": settings.timeout}
    return {k: str(v) for k, v in said.items()} | {"module": module, "folder": folder, "run": uuid.uuid4().hex}


def land_module(spark: SparkSession, settings: Settings, module: str, raw: str, limit: int | None = None, pages_per_task: int = 10) -> Landed:
    """Land all pages of a module by tasks, each a range of pages. They take the place of the module's folder once all are there."""
    register(spark)
    new = f".landing-{module}-{uuid.uuid4().hex}"
    options = _options(settings, module, f"{raw}/{new}")
    read = spark.read.format("ticket_pages").options(**options).option("pages_per_task", pages_per_task)
    store = Store(spark, raw)
    try:
        (read if limit is None else read.option("limit", limit)).load().write.format("ticket_pages").options(**options).mode("append").save()
        landed = _run_of(spark, f"{raw}/{new}", options["run"])
        store.replace(new, module)
    except BaseException:
        store.delete(new)
        raise
    return landed


def landed_details(spark: SparkSession, folder: str) -> DataFrame | None:
    """(id, bundle): what has landed so far, each id once; None if there is nothing."""
    if not Store(spark, folder).has_files(".parquet"):
        return None
    return spark.read.schema("id string, bundle string").parquet(folder).groupBy("id").agg(F.first("bundle").alias("bundle"))


def missing(ids: DataFrame, landed: DataFrame | None) -> DataFrame:
    """The different ids that have not landed yet, as text; null is no id."""
    wanted = ids.select(F.col("id").cast("string").alias("id")).where("id is not null").distinct()
    return wanted if landed is None else wanted.join(landed, "id", "left_anti")


def land_details(ids: DataFrame, settings: Settings, module: str, folder: str, notes: bool = True, per_file: int = PER_FILE, per_task: int = PER_TASK) -> tuple[Landed, int]:
    """Fetch and land the bundles of those ids that have not landed yet; what has, and how many were there before."""
    spark = ids.sparkSession
    register(spark)
    known = landed_details(spark, folder)
    todo = missing(ids, known)
    n = todo.count()
    skipped = 0 if known is None else missing(ids, None).join(known, "id", "left_semi").count()
    options = _options(settings, module, folder)
    if not n:
        return Landed(), skipped
    todo.repartition(-(-n // per_task)).write.format("ticket_details").options(**options, notes=str(notes).lower(), per_file=str(per_file)).mode("append").save()
    return _run_of(spark, folder, options["run"]), skipped


def failed_details(spark: SparkSession, folder: str) -> DataFrame | None:
    """(run, id, error): what could not be fetched, by run; None if nothing failed."""
    return spark.read.parquet(f"{folder}/_errors") if Store(spark, f"{folder}/_errors").has_files(".parquet") else None

