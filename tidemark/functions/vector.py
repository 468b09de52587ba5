"""Vectors as arrays; sums run in double precision in the order of the elements."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def mean_of(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y) / 2)


def normalize(a: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    size = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: F.when(size > 0, x / size).otherwise(x.cast("double")))


MODEL = "hashed-grams-2"


def gram_vector(text: str | None, dimensions: int) -> np.ndarray:
    """Signed counts of hashed character 3-grams of a text in lower case, at unit length; none give zeros."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) if text else np.zeros(0, np.uint64)
    if len(points) < 3:
        return np.zeros(dimensions, np.float32)
    h = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (points[2:] * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    v = np.bincount((h % np.uint64(dimensions)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0), dimensions)
    n = np.linalg.norm(v)
    return (v / n if n else v).astype(np.float32)


def hashed_embedding(text: Column, dimensions: int = 128) -> Column:
    """A unit vector of signed, hashed character 3-grams: a stand-in that needs no model files."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: gram_vector(t if isinstance(t, str) else None, dimensions))

    return embed(text)


def cache_key(text: Column, model: str) -> Column:
    """The key under which a text's embedding by a model is kept."""
    return F.sha2(F.concat(F.lit(f"{model}\x1f"), F.coalesce(text, F.lit(""))), 256)
