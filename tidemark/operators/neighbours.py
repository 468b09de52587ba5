"""Approximate nearest neighbours by NN-descent over DataFrames.

A neighbour of a neighbour is likely a neighbour. Rows start with the nearest ones in blocks of rows that
fall on the same sides of random planes. Then, round by round, each row brings its neighbours, and those
whose neighbour it is, together: their distances to each other are proposed to both, and each keeps its
``k`` best. A row brings at most ``sample`` together, new ones first, so a round costs a bounded number of
distances a row and no step compares all pairs; pairs of which neither is new have been compared before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.vector import normalize
from tidemark.runtime import BROADCAST_ROWS, settled, ship

#: Rows of a block whose pairs are compared at the start, orders of rows by planes, and planes of an order.
LEAF, TREES, PLANES = 64, 4, 24
#: Rounds at most, and the share of neighbours that must have changed for another one.
ROUNDS, CHANGED = 8, 0.01


def points_of(df: DataFrame, key: str, vector: str, cosine: bool = False) -> DataFrame:
    """(id, v, n): each vector once, under the least key of its rows, with their number; at unit length if ``cosine``."""
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), (normalize(v) if cosine else v).alias("v"))
    return rows.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "v", "n")


def _matrix(lists) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def _distances(x: np.ndarray) -> np.ndarray:
    """Distances of all pairs of rows in each of a stack of small matrices."""
    square = np.einsum("bij,bij->bi", x, x)
    return np.sqrt(np.maximum(square[:, :, None] + square[:, None] - 2 * x @ x.transpose(0, 2, 1), 0))


def _edges(u, v, d, names=("u", "v", "d")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=list(names))


def _start(points: DataFrame, k: int, seed: int) -> DataFrame:
    """(u, v, d): up to k neighbours of each row among those that stand near it in some order by planes."""
    middle = points.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x")).orderBy("i").toPandas()["x"].to_numpy()  # a vector
    planes = np.random.default_rng(seed).normal(size=(len(middle), TREES * PLANES))
    offset = middle @ planes
    bits = 1 << np.arange(PLANES - 1, -1, -1)

    def sides(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = (_matrix(b.column(1)) @ planes > offset).reshape(b.num_rows, TREES, PLANES) @ bits
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t), pa.int32()), pa.array(above[:, t], pa.int64()), b.column(0), b.column(1)], names=["tree", "side", "id", "v"])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in [*batches, None]:
            if b is not None:
                held = b if held is None else pa.concat_batches([held, b])
            if held is None:
                return
            whole = held.num_rows if b is None else held.num_rows // LEAF * LEAF
            for at in range(0, whole, LEAF):
                part = held.slice(at, min(LEAF, whole - at))
                ids, d = part.column(0).to_numpy(), _distances(_matrix(part.column(1))[None])[0]
                d[ids[:, None] == ids] = np.inf  # a block may hold a row in two orders
                best = np.argsort(d, axis=1)[:, : min(k, len(ids) - 1)]
                u, v, near = np.repeat(ids, best.shape[1]), ids[best].ravel(), np.take_along_axis(d, best, 1).ravel()
                yield _edges(u[near < np.inf], v[near < np.inf], near[near < np.inf])
            held = held.slice(whole)

    ordered = points.select("id", "v").mapInArrow(sides, "tree int, side long, id long, v array<double>").repartitionByRange("tree", "side", F.xxhash64("id")).sortWithinPartitions("tree", "side", F.xxhash64("id"))
    return ordered.select("id", "v").mapInArrow(blocks, "u long, v long, d double")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """Of edges (u, v, d, new) each pair once, and of each u the k nearest."""
    once = edges.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return once.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def _proposed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v, d) between rows that one row brings together, where they are better than what u has."""
    for b in batches:
        lists = b.column(0)
        size, at = np.diff(lists.offsets.to_numpy()), lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        rows = lists.flatten()
        ids, far, new = (rows.field(f).to_numpy(zero_copy_only=False) for f in ("id", "far", "new"))
        v = _matrix(rows.field("v"))
        for c in range(0, len(size), 256):
            n, a = size[c : c + 256], at[c : c + 256]
            place = a[:, None] + np.minimum(np.arange(n.max()), n[:, None] - 1)
            real = np.arange(n.max()) < n[:, None]
            d = _distances(v[place])
            pair = real[:, :, None] & real[:, None] & (new[place][:, :, None] | new[place][:, None]) & (d < far[place][:, :, None])
            pair[:, np.arange(n.max()), np.arange(n.max())] = False
            g, i, j = np.nonzero(pair)
            if len(g):
                yield _edges(ids[place[g, i]], ids[place[g, j]], d[g, i, j])


def nearest(points: DataFrame, k: int = 15, sample: int = 24, rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """(u, v, d): the k nearest of each of the points (id, v), nearly all of them, by Euclidean distance; fewer if there are fewer.

    ``id`` must be unique. Points of unit length are ordered by cosine, too.
    """
    spark = points.sparkSession
    ship(spark)
    points = settled(points.select("id", "v"))
    n = points.count()
    if n < 2:
        return spark.createDataFrame([], "u long, v long, d double")
    edges = settled(_best(_start(points, k, seed).withColumn("new", F.lit(True)), k))
    few = F.broadcast if n <= BROADCAST_ROWS // 8 else (lambda df: df)  # of some hundred numbers each
    for step in range(rounds):
        far = edges.groupBy("u").agg(F.max("d").alias("far"), F.count("*").alias("n")).select(F.col("u").alias("id"), F.when(F.col("n") < k, float("inf")).otherwise(F.col("far")).alias("far"))
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("id"), "new").unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("id"), "new"))
        both = both.groupBy("node", "id").agg(F.max("new").alias("new"))
        rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("new"), F.xxhash64("id", "node", F.lit(step)), "id"))
        some = both.withColumn("r", rank).where(F.col("r") <= sample).drop("r")
        known = few(points.join(far, "id", "left").select("id", "v", F.coalesce("far", F.lit(float("inf"))).alias("far")))
        # at most ``sample`` vectors a row
        lists = some.join(known, "id").groupBy("node").agg(F.collect_list(F.struct("id", "far", "new", "v")).alias("c")).select("c")
        found = lists.mapInArrow(_proposed, "u long, v long, d double").withColumn("new", F.lit(True))
        edges = settled(_best(edges.withColumn("new", F.lit(False)).unionByName(found), k))
        if edges.where("new").count() < CHANGED * n * k:
            break
    return edges.select("u", "v", "d")
