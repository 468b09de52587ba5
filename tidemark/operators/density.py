"""Density clusters on a neighbour graph: mutual reachability, a spanning forest in rounds of joins, excess of mass.

Rows with the same vector are one point that counts as often as they are. Core distances and reachability
come from each point's nearest neighbours. The spanning forest grows as Boruvka's: in each round every
component takes its least edge to another one, and components that are linked so become one, so there are at
most half as many after it. The hierarchy of a component follows from its edges in order of their length; it is
condensed by a task for each component, which holds some numbers for each point, and nothing meets on the driver.
Components that the graph does not link are apart at any distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.neighbours import nearest, points_of
from tidemark.runtime import BROADCAST_ROWS, checkpoint, settled, ship, small

#: The least distance, so that its inverse is a number.
LEAST = 1e-12


def core_distances(points: DataFrame, near: DataFrame, samples: int) -> DataFrame:
    """(id, core): how far a point's ball reaches that holds ``samples`` rows, its own among them, as far as its neighbours tell."""
    own = points.select(F.col("id").alias("u"), F.lit(0.0).alias("d"), "n")
    rows = near.join(points.select(F.col("id").alias("v"), "n"), "v").select("u", "d", "n").unionByName(own)
    within = F.sum("n").over(Window.partitionBy("u").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = rows.withColumn("within", within)
    return ranked.groupBy(F.col("u").alias("id")).agg(F.coalesce(F.min(F.when(F.col("within") >= samples, F.col("d"))), F.max("d")).alias("core"))


def reachability(near: DataFrame, cores: DataFrame) -> DataFrame:
    """(u, v, d), u < v: the graph's edges by mutual reachability."""
    pairs = near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "d").where("u <> v").groupBy("u", "v").agg(F.min("d").alias("d"))
    both = pairs.join(cores.toDF("u", "cu"), "u").join(cores.toDF("v", "cv"), "v")
    return both.select("u", "v", F.greatest("d", "cu", "cv").alias("d"))


def _roots(links: DataFrame, few: bool) -> DataFrame:
    """(c, root) of links (c, to), one a component, whose only cycles are pairs that name each other.

    ``few``: there are at most ``BROADCAST_ROWS``, which one task resolves; else each round of joins halves the ways to the roots.
    """
    if few:

        def resolve(batches):
            got = pa.Table.from_batches([*batches], schema=pa.schema([("c", pa.int64()), ("to", pa.int64())])).sort_by("c")
            c, to = got.column("c").to_numpy(), np.searchsorted(got.column("c").to_numpy(), got.column("to").to_numpy())
            own = np.arange(len(c))
            up = np.where((to[to] == own) & (own < to), own, to)
            while (up[up] != up).any():
                up = up[up]
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(c[up])], names=["c", "root"])

        return checkpoint(links.coalesce(1).mapInArrow(resolve, "c long, root long"))
    back = links.toDF("to", "back")
    own = F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c")).otherwise(F.col("to"))
    up = checkpoint(links.join(back, "to", "left").groupBy("c", "to").agg(F.min(own).alias("root")).select("c", "root"))
    while True:
        higher = checkpoint(up.join(up.toDF("root", "above"), "root").select("c", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")))
        up = higher.select("c", "root")
        if higher.where("moved").isEmpty():
            return up


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((u, v, d) of a least spanning forest, (id, component) of its points); the edges (u, v, d) are ordered by d, u and v."""
    edges = settled(edges)
    labels = edges.select(F.explode(F.array("u", "v")).alias("id")).distinct().select("id", F.col("id").alias("component"))
    tree = edges.limit(0)
    left = edges.select("u", "v", "d", F.col("u").alias("cu"), F.col("v").alias("cv"))
    while not left.isEmpty():
        edge = F.struct("d", "u", "v")
        sides = left.select(F.explode(F.array(F.struct(F.col("cu").alias("c"), F.col("cv").alias("to")), F.struct(F.col("cv").alias("c"), F.col("cu").alias("to")))).alias("s"), edge.alias("e"))
        taken = settled(sides.groupBy("s.c").agg(F.min(F.struct("e", "s.to")).alias("least")).select("c", "least.to", "least.e"))
        n = taken.count()
        tree = tree.unionByName(taken.select("e.u", "e.v", "e.d").distinct())
        roots = _roots(taken.select("c", "to"), n <= BROADCAST_ROWS)
        roots = F.broadcast(roots) if n <= BROADCAST_ROWS else roots
        labels = settled(labels.join(roots, F.col("component") == F.col("c"), "left").select("id", F.coalesce("root", "component").alias("component")))
        moved = left.join(roots.toDF("cu", "ru"), "cu").join(roots.toDF("cv", "rv"), "cv").where("ru <> rv")
        # of the edges between two components only the least can be taken
        a, b = F.least("ru", "rv").alias("cu"), F.greatest("ru", "rv").alias("cv")
        left = settled(moved.groupBy(a, b).agg(F.min(edge).alias("e")).select("e.u", "e.v", "e.d", "cu", "cv"))
    return settled(tree), labels


def condense(u: np.ndarray, v: np.ndarray, d: np.ndarray, ids: np.ndarray, n: np.ndarray, least: int, whole: bool) -> np.ndarray:
    """The number of each point's cluster, or -1, by excess of mass over the hierarchy of one component's tree (u, v, d).

    ``ids`` are sorted, ``n`` counts the rows of each point. The members of a part of the hierarchy are a chain, so joining two is
    one step. With ``whole`` the component may be a cluster even if it splits.
    """
    order = np.lexsort((v, u, d))
    at = lambda x: np.searchsorted(ids, x[order]).tolist()
    parent, size, after, last = list(range(len(ids))), n.tolist(), [-1] * len(ids), list(range(len(ids)))
    # [mass, rows, parts, first, last]; a point with enough rows is a cluster from the start
    node = [[s / LEAST, s, [], i, i] if s >= least else None for i, s in enumerate(size)]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b, dist in zip(at(u), at(v), d[order].tolist()):
        a, b, lam = find(a), find(b), 1 / max(dist, LEAST)
        if size[a] < size[b]:
            a, b = b, a
        both, x, y = size[a] + size[b], node[a], node[b]
        if x and y:  # a true split, seen from above: both keep the members that they have by now
            for part, top in ((x, a), (y, b)):
                part[0] -= part[1] * lam
                part[4] = last[top]
            own = [both * lam, both, [x, y], a, None]
        elif x or y:
            own = x or y
            own[0] += (both - own[1]) * lam
            own[1] = both
        else:
            own = [both * lam, both, [], a, None] if both >= least else None
        if own:
            own[3] = a  # the chain begins with the larger part's
        after[last[a]], last[a], parent[b], size[a], node[a], node[b] = b, last[b], a, both, own, None
    labels, count = np.full(len(ids), -1), 0
    roots = [(i, x) for i, x in enumerate(node) if x]
    for top, root in roots:
        root[4] = last[top]
        # from the leaves up: a part stays if it has more mass than what was taken below it
        ordered, stack = [], [root]
        while stack:
            ordered.append(part := stack.pop())
            stack += part[2]
        taken: dict[int, tuple[float, bool]] = {}
        for part in reversed(ordered):
            below = sum(taken[id(x)][0] for x in part[2])
            split = bool(part[2]) and (below > part[0] or part is root and not whole)
            taken[id(part)] = (below, False) if split else (part[0], True)
        stack = [root]
        while stack:
            part = stack.pop()
            if not taken[id(part)][1]:
                stack += part[2]
                continue
            i = part[3]
            while True:
                labels[i] = count
                if i == part[4]:
                    break
                i = after[i]
            count += 1
    return labels


def numbered(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``number``: its place in an order, counted from 0 by partitions, of which only the sizes meet."""
    placed = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    sizes = placed.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__least"))  # a row a partition
    before = sizes.select("__p", "__least", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    return placed.join(F.broadcast(before), "__p").withColumn("number", F.col("__before") + F.col("__i") - F.col("__least")).drop("__p", "__i", "__least", "__before")


def density_clusters(df: DataFrame, key: str, vector: str, min_size: int = 20, min_samples: int = 5, neighbours: int = 15, rounds: int = 10) -> DataFrame:
    """``df`` with ``cluster``: -1 for noise (and rows without a vector), else the clusters' numbers by falling size and least key.

    ``neighbours`` nearest of each point make the graph; with as many as there are points the result is that of all pairs.
    """
    ship(df.sparkSession)
    points = settled(points_of(df, key, vector))
    near = settled(nearest(points, max(neighbours, min_samples), rounds=rounds))
    tree, labels = spanning_forest(reachability(near, core_distances(points, near, min_samples)))
    weighed = checkpoint(points.select("id", "n").join(labels, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component")))
    several = weighed.groupBy("component").agg(F.sum("n").alias("n")).where(F.col("n") >= min_size).limit(2).count() > 1
    sides = tree.join(labels, F.col("u") == F.col("id")).select("component", "u", "v", "d")

    def cut(key, points, tree):
        points = points.sort_values("id")
        out = condense(*(tree[c].to_numpy() for c in ("u", "v", "d")), points["id"].to_numpy(), points["n"].to_numpy(), min_size, several)
        return pd.DataFrame({"id": points["id"].to_numpy(), "n": points["n"].to_numpy(), "component": key[0], "part": out})

    parts = weighed.groupBy("component").cogroup(sides.groupBy("component")).applyInPandas(cut, "id long, n long, component long, part long")
    parts = checkpoint(parts.where("part >= 0"))
    ranks = numbered(parts.groupBy("component", "part").agg(F.sum("n").alias("n"), F.min("id").alias("least")), F.desc("n"), "least")
    named = parts.join(small(ranks.select("component", "part", "number")), ["component", "part"]).select("id", F.col("number").cast("int").alias("cluster"))
    of_vector = points.join(named, "id").select(F.xxhash64("v").alias("__point_hash"), F.col("v").alias("__point"), "cluster")
    rows = df.withColumn("__point_own", F.transform(vector, lambda x: x.cast("double"))).withColumn("__point_hash", F.xxhash64("__point_own"))
    # the rows of a frequent vector are split by the adaptive join
    joined = rows.join(of_vector, (rows["__point_hash"] == of_vector["__point_hash"]) & (F.col("__point_own") == F.col("__point")), "left")
    return joined.select(*[rows[c] for c in df.columns], F.coalesce("cluster", F.lit(-1)).alias("cluster"))
