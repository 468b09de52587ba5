"""Incremental reading of landed pages and of the server, latest versions, and windowed volumes over streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.runtime import ship
from tidemark.sources.files import page_records
from tidemark.sources.rest import register


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): pages as they land, each once."""
    return spark.readStream.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_name").alias("file"), "value")


def refresh(spark: SparkSession, path: str, module: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the records of pages that have landed since the last run, then stop."""
    rows = page_records(stream_pages(spark, path), module).select("file", "position", F.to_json("record").alias("record"))
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_volume(events: DataFrame, time: str, group: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, group, n) a window; rows later than ``late`` are let go by the watermark."""
    stamped = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return stamped.groupBy(F.window("__t", width).alias("w"), group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), group, "n")


def follow(spark: SparkSession, options: dict[str, str], out: str, checkpoint: str) -> StreamingQuery:
    """Append the server's records that are new since the last run, then stop; each is written once, restarts or not.

    ``options`` are those of the ``tickets`` source. A batch that a restart makes again takes the place of what it had written.
    """
    register(spark)
    rows = spark.readStream.format("tickets").options(**options).load()
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_versions(rows: DataFrame, id: str, version: str, payload: str, time: str, keep: str = "30 days") -> DataFrame:
    """(id, version, payload) of rows whose version is above all that were seen of their id, one an id and batch.

    What is kept of an id is its last version, until the stream's ``time`` is ``keep`` beyond its last row; rows that come later
    than that, or have no id, version or time, are left out.
    """
    ship(rows.sparkSession)
    own = rows.select(F.col(id).cast("string").alias("id"), F.col(version).cast("long").alias("version"), F.col(payload).cast("string").alias("payload"), F.col(time).cast("timestamp").alias("at"))

    def newest(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        best, last = None, 0
        for part in parts:
            top = part.loc[part["version"].idxmax()]
            best = top if best is None or top["version"] > best["version"] else best
            last = max(last, int(part["at"].max().timestamp() * 1000))
        known, before = state.get if state.exists else (None, 0)
        new, last = known is None or best["version"] > known, max(last, before)
        state.update((int(best["version"]) if new else known, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1)
        if new:
            yield pd.DataFrame({"id": [key[0]], "version": [int(best["version"])], "payload": [best["payload"]]})

    dated = own.where("id is not null and version is not null and at is not null").withWatermark("at", keep)
    return dated.groupBy("id").applyInPandasWithState(newest, "id string, version long, payload string", "version long, last long", "update", GroupStateTimeout.EventTimeTimeout)
