"""Reading, shared storage and Arrow helpers that the operators of this subpackage use."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import checkpoint, released, settled, shared_path, shared_root, ship, small  # noqa: F401  for the operators

#: Working sets in a Python worker are rebuilt once they hold this many bytes of text.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(rows: DataFrame, label: str, bounds: Iterable[tuple[int, int]]) -> DataFrame:
    """Of rows (doc_id, text, label) the first of each (label, how many), by hashes of doc_id and text."""
    parts = [rows.where(F.col(label) == c).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(n) for c, n in bounds]
    return reduce(DataFrame.unionByName, parts)


#: Keys with the most rows that are joined by broadcast; what then is left of any key is at most 1 / HOT_KEYS of the rows.
HOT_KEYS = 1000
#: Where no key has more than 1 / EVEN of the rows, none is joined by broadcast.
EVEN = 200


def join_hot(rows: DataFrame, by_key: DataFrame, key: str, n: str) -> DataFrame:
    """``rows.join(by_key, key)`` for a table of one row a key, whose column ``n`` counts the key's rows.

    The rows of the most frequent keys stay where they are; only the others are dealt by key. Where no key
    has more than 1 / EVEN of the rows, all are dealt. Both tables should be checkpoints.
    """
    most, total = by_key.agg(F.max(n), F.sum(n)).first()
    if (most or 0) * EVEN <= (total or 0):
        return rows.join(by_key, key).drop(n)
    hot = F.broadcast(by_key.orderBy(F.desc(n), key).limit(HOT_KEYS))
    rest = rows.join(hot.select(key), key, "left_anti").join(by_key, key)
    return rows.join(hot, key).unionByName(rest).drop(n)


def chunks(batches: Iterable[pa.RecordBatch], text: int | None = 1, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose column ``text`` holds about ``most`` bytes; a longer row stands alone."""
    for b in batches:
        if not b.num_rows:
            continue
        per = max(1, b.nbytes // b.num_rows)
        start, size = 0, 0
        lengths = b.column(text).to_pandas().str.len().fillna(0).tolist() if text is not None else [per] * b.num_rows
        for i, n in enumerate(lengths):
            if i > start and size + n > most:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        yield b.slice(start)


@contextmanager
def uncollected():
    """No search for cyclic garbage meanwhile: it walks through all that a worker keeps, again and again. For a bounded batch."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str, text: int | None = 1) -> DataFrame:
    """``df.mapInArrow`` of a function from a bounded batch to a batch or a dict of its columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for b in chunks(batches, text):
            with uncollected():
                out = fn(b)
            if isinstance(out, dict):
                out = pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
            yield out

    return map_arrow(df, run, schema)


class Cache(dict):
    """A dict that a worker fills as it goes and empties at ``most`` entries, so its memory is bounded."""

    def __init__(self, make: Callable, most: int = 200_000):
        super().__init__()
        self._make, self._most = make, most

    def __missing__(self, key):
        if len(self) >= self._most:
            self.clear()
        value = self[key] = self._make(key)
        return value
