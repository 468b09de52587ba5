"""Layout of vectors in few dimensions by their neighbour graph.

Each point's distances to its nearest neighbours become degrees of belonging: 1 for the nearest, falling at a rate at
which they add up to log2(k). The graph joins both directions of an edge. From the principal components on, rounds of
steps pull ends of edges together, each edge in a share of the rounds that goes with its degree, and push points from ones that are
drawn at random, less and less. A step is joins of edges with positions and a sum by point; a point is moved by
bounded amounts, however many edges it has.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vector import normalize
from tidemark.operators.density import numbered
from tidemark.operators.neighbours import nearest, points_of
from tidemark.runtime import BROADCAST_ROWS, checkpoint, settled, ship

#: The curve 1 / (1 + A d ** (2 B)) that says how near ends of an edge should be, and the farthest a step may pull.
A, B, FARTHEST = 1.577, 0.895, 4.0
#: Points drawn to push each end of an edge from, rounds, and the spread that the layout starts with.
DRAWN, ROUNDS, SPREAD = 2, 8, 5.0


def project(df: DataFrame, vector: str, dimensions: int) -> DataFrame:
    """``vector`` on its principal components."""
    rows = df.withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    model = PCA(k=dimensions, inputCol="__v", outputCol="__pc").fit(rows)
    return model.transform(rows).withColumn(vector, vector_to_array("__pc")).drop("__v", "__pc")


def memberships(near: DataFrame, k: int) -> DataFrame:
    """(u, v, w), u < v: the symmetric degrees of belonging of neighbours (u, v, d)."""

    def batch(batches):
        target = np.log2(k)
        for b in batches:
            lists = b.column(1)
            offsets = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
            owner = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            ids, d = (lists.flatten().field(f).to_numpy() for f in ("v", "d"))
            nearest_one = np.minimum.reduceat(np.where(d > 0, d, np.inf), offsets[:-1])
            over = np.maximum(d - np.where(np.isfinite(nearest_one), nearest_one, 0)[owner], 0)
            low, high = np.zeros(b.num_rows), np.full(b.num_rows, np.inf)
            sigma = np.ones(b.num_rows)
            for _ in range(64):
                much = np.bincount(owner, np.exp(-over / sigma[owner]), b.num_rows) > target
                high, low = np.where(much, sigma, high), np.where(much, low, sigma)
                sigma = np.where(np.isinf(high), 2 * sigma, (low + high) / 2)
            sigma = np.maximum(sigma, 1e-3 * np.maximum(np.bincount(owner, d, b.num_rows) / np.diff(offsets), 1e-12))
            w = np.exp(-over / sigma[owner])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), np.diff(offsets))), pa.array(ids), pa.array(w)], names=["u", "v", "w"])

    lists = near.groupBy("u").agg(F.collect_list(F.struct("v", "d")).alias("near"))  # k of each
    one_way = lists.mapInArrow(batch, "u long, v long, w double")
    pairs = one_way.groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).agg(F.sum("w").alias("s"), F.when(F.count("*") > 1, F.product("w")).otherwise(0.0).alias("p"))
    return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), (F.col("s") - F.col("p")).alias("w"))


def layout(edges: DataFrame, start: DataFrame, dimensions: int, rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """(id, v): positions after rounds of steps from those of ``start`` (id, v), along edges (u, v, w).

    A round deals edges and drawn points to positions by their numbers; positions of up to ``BROADCAST_ROWS`` points are broadcast.
    """
    names = [f"x{i}" for i in range(dimensions)]
    at = checkpoint(numbered(start.select("id", *[F.get("v", F.lit(i)).alias(x) for i, x in enumerate(names)]), "id").withColumnRenamed("number", "i"))
    n, few = at.count(), (lambda df: df)
    if n <= BROADCAST_ROWS:
        few = F.broadcast
    ends = at.select("id", "i")
    edges = edges.join(few(ends.toDF("u", "a")), "u").join(few(ends.toDF("v", "b")), "v")
    top = edges.agg(F.max("w")).first()[0] or 1.0
    pair = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = settled(edges.select("w", pair.alias("e")).select("e.a", "e.b", "w"))
    spread = at.agg(*[F.stddev(x).alias(x) for x in names]).first()  # a number a dimension
    scale = SPREAD / max([s for s in spread if s] or [1.0])
    at = settled(at.select("id", "i", *[(F.col(x) * scale).alias(x) for x in names]))
    for step in range(rounds):
        rate = 1.0 - step / rounds
        chosen = both.where(F.pmod(F.xxhash64("a", "b", F.lit(step + 1000 * seed)), F.lit(1 << 20)) < F.col("w") / top * (1 << 20))
        drawn = [F.struct(F.pmod(F.xxhash64("a", "b", F.lit(step), F.lit(j)), F.lit(n)).alias("i"), F.lit(False).alias("pull")) for j in range(DRAWN)]
        other = F.explode(F.array(F.struct(F.col("b").alias("i"), F.lit(True).alias("pull")), *drawn)).alias("o")
        here = few(at.select(F.col("i").alias("a"), *[F.col(x).alias(f"a{x}") for x in names]))
        there = few(at.select("i", *[F.col(x).alias(f"b{x}") for x in names]))
        met = chosen.select("a", other).select("a", "o.i", "o.pull").join(here, "a").join(there, "i")
        square = reduce(add, [(F.col(f"a{x}") - F.col(f"b{x}")) ** 2 for x in names])
        met = met.select("a", "pull", square.alias("s"), *[(F.col(f"a{x}") - F.col(f"b{x}")).alias(x) for x in names])
        power = F.pow("s", F.lit(B))
        pull = F.when(F.col("s") > 0, (-2.0 * A * B) * power / F.col("s") / (1 + A * power)).otherwise(0.0)
        push = (2.0 * B) / ((0.001 + F.col("s")) * (1 + A * power))
        move = lambda x: F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.col("f") * F.col(x)))
        moves = met.select("a", "pull", F.when(F.col("pull"), pull).otherwise(push).alias("f"), *names).select("a", "pull", *[move(x).alias(x) for x in names])
        mean = moves.groupBy("a").agg(*[(F.coalesce(F.avg(F.when(F.col("pull"), F.col(x))), F.lit(0.0)) + F.coalesce(F.avg(F.when(~F.col("pull"), F.col(x))), F.lit(0.0))).alias(f"m{x}") for x in names])
        at = settled(at.join(few(mean), at["i"] == mean["a"], "left").select("id", "i", *[(F.col(x) + rate * F.coalesce(f"m{x}", F.lit(0.0))).alias(x) for x in names]))
    return at.select("id", F.array(*names).alias("v"))


def embed_manifold(df: DataFrame, key: str, vector: str, dimensions: int = 10, neighbours: int = 15, rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """``df`` with ``vector`` in few dimensions, where rows that were near by cosine are near; null stays null."""
    ship(df.sparkSession)
    points = checkpoint(points_of(df, key, vector, cosine=True))
    near = checkpoint(nearest(points, neighbours, seed=seed))
    placed = checkpoint(layout(memberships(near, neighbours), project(points, "v", dimensions), dimensions, rounds, seed))
    unit = normalize(F.transform(vector, lambda x: x.cast("double")))
    rows = df.withColumn("__point_own", unit).withColumn("__point_hash", F.xxhash64("__point_own"))
    of_vector = points.join(placed.withColumnRenamed("v", "__point_at"), "id").select(F.xxhash64("v").alias("__point_hash"), F.col("v").alias("__point"), "__point_at")
    joined = rows.join(of_vector, (rows["__point_hash"] == of_vector["__point_hash"]) & (F.col("__point_own") == F.col("__point")), "left")
    return joined.select(*[F.col("__point_at").alias(c) if c == vector else rows[c] for c in df.columns])
