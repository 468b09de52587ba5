"""Session settings that the package counts on, and its own way to the executors."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows of a narrow table that may be broadcast once they have been counted; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000


def session(name: str = "tidemark", **conf) -> SparkSession:
    """A session in UTC with adaptive execution; other settings as given, with _ for the dots in their names."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("_", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a context, whether or not they have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = Path(__file__).resolve().parent
    to = Path(os.path.realpath(tempfile.mkdtemp())) / "tidemark_package.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(to))
    sc._tidemark_shipped = True


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``.

    Where that is unset a temporary folder serves, but only on a local master, where there is one
    machine; elsewhere this raises ValueError.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/tidemark-checkpoints"
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table under the shared folder."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder, so that lost executors cost no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for what goes from one round of joins to the next.

    A checkpoint keeps the planner's guess at its size, and joins multiply guesses: over rounds the guess gets millions of digits,
    with which the driver then reckons in every plan. Files have the size that they have.
    """
    path = shared_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nobody holds any more: Spark deletes them once the driver's JVM finds the plans gone.

    Left to itself it looks when its memory is full or in half an hour, and shuffles of long jobs add up on disk until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A checkpointed table, marked for broadcast if it has at most ``most`` rows."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= most else df
