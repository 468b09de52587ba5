"""Neighbours, layout and density clusters against all pairs on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import density, manifold, neighbours


def rows_of(spark, points, ids=None):
    return spark.createDataFrame([(int(i), [float(x) for x in p]) for i, p in zip(ids if ids is not None else range(len(points)), points)], "id long, v array<double>")


def all_distances(x):
    return np.sqrt(((x[:, None] - x) ** 2).sum(-1))


@pytest.fixture(scope="module")
def blobs():
    r = np.random.default_rng(0)
    centres = r.normal(0, 3, (6, 20))
    return np.concatenate([c + r.normal(0, 0.6, (90, 20)) for c in centres])


def test_neighbours_recall(spark, blobs):
    got = neighbours.nearest(rows_of(spark, blobs), 10).collect()
    d = all_distances(blobs)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j)) for i in range(len(d)) for j in np.argsort(d[i])[:10]}
    assert len(got) == len(want) and len({(r.u, r.v) for r in got} & want) / len(want) >= 0.95
    assert max(abs(r.d - d[r.u, r.v]) for r in got) < 1e-6


def test_neighbours_of_few_points(spark):
    few = rows_of(spark, [[0.0], [1.0], [5.0]])
    assert sorted((r.u, r.v, round(r.d, 6)) for r in neighbours.nearest(few, 10).collect()) == [(0, 1, 1), (0, 2, 5), (1, 0, 1), (1, 2, 4), (2, 0, 5), (2, 1, 4)]
    assert neighbours.nearest(few.limit(1), 10).count() == 0 == neighbours.nearest(few.where("false"), 10).count()


def trustworthiness(x, y, k):
    n, near = len(x), np.argsort(all_distances(y), 1)[:, 1 : k + 1]
    rank = np.argsort(np.argsort(all_distances(x), 1), 1)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()


def test_layout_is_trustworthy(spark):
    """Groups in more directions than the layout has: principal components lay some over each other."""
    r = np.random.default_rng(7)
    blobs = np.concatenate([c + r.normal(0, 0.6, (40, 20)) for c in r.normal(0, 3, (14, 20))])
    rows = rows_of(spark, blobs).unionByName(spark.createDataFrame([(900, None), (901, [float(x) for x in blobs[3]])], "id long, v array<double>"))
    got = {r.id: r.v for r in manifold.embed_manifold(rows, "id", "v", 2).collect()}
    assert len(got) == len(blobs) + 2 and got[900] is None and got[901] == got[3]
    unit = blobs / np.linalg.norm(blobs, axis=1, keepdims=True)
    flat = np.array([r.v for r in manifold.project(rows_of(spark, unit), "v", 2).orderBy("id").collect()])
    laid = np.array([got[i] for i in range(len(blobs))])
    assert np.isfinite(laid).all()
    print("trustworthiness", trustworthiness(unit, laid, 10), "components", trustworthiness(unit, flat, 10))
    assert trustworthiness(unit, laid, 10) > max(0.85, trustworthiness(unit, flat, 10))


def clusters_by_hand(x, ids, min_size, min_samples):
    """Excess of mass over the tree of all pairs, with sets of members."""
    d = all_distances(x)
    core = np.sort(d, 1)[:, min(min_samples, len(x)) - 1]
    reach = np.maximum(d, np.maximum(core[:, None], core))
    edges = sorted((reach[i, j], min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(x)) for j in range(i))
    of, nodes, roots = {i: {i} for i in ids}, {}, []
    for w, a, b in edges:
        if of[a] is of[b]:
            continue
        lam, parts = 1 / max(w, 1e-12), [of[a], of[b]]
        both = parts[0] | parts[1]
        known = [nodes.pop(id(p), None) for p in parts]
        for i in both:
            of[i] = both
        if all(known):
            for k, p in zip(known, parts):
                k["mass"] -= k["n"] * lam
                k["members"] = set(p)
            node = {"mass": len(both) * lam, "n": len(both), "below": known}
        elif any(known):
            node = known[0] or known[1]
            node["mass"] += (len(both) - node["n"]) * lam
            node["n"] = len(both)
        else:
            node = {"mass": len(both) * lam, "n": len(both), "below": []} if len(both) >= min_size else None
        if node:
            node["members"], nodes[id(both)] = both, node
        roots.append(both)

    def choose(c, root):
        below = [choose(k, False) for k in c["below"]]
        if c["below"] and (root or sum(m for m, _ in below) > c["mass"]):
            return sum(m for m, _ in below), [x for _, xs in below for x in xs]
        return c["mass"], [c["members"]]

    chosen = [m for c in nodes.values() for m in choose(c, True)[1]]
    return {i: k for k, m in enumerate(sorted(chosen, key=lambda m: (-len(m), min(m)))) for i in m}


def test_density_clusters_equal_those_of_all_pairs(spark):
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(0, 0.3, (40, 3)), r.normal(2, 0.4, (35, 3)), r.normal([0, 4, 0], 0.2, (30, 3)), r.uniform(-4, 6, (25, 3)), np.repeat(r.normal(8, 0.1, (2, 3)), [12, 3], 0)])
    ids = r.permutation(len(x)) * 3 - 50
    want = clusters_by_hand(x, ids.tolist(), 10, 5)
    df = rows_of(spark, x, ids).withColumn("cluster_of", F.lit(1))
    got = {row.id: row.cluster for row in density.density_clusters(df, "id", "v", min_size=10, min_samples=5, neighbours=len(x)).collect()}
    assert len(set(want.values())) >= 3 and got == {int(i): want.get(i, -1) for i in ids.tolist()}


def test_density_clusters_of_a_sparse_graph(spark):
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(c, 0.2, (40, 2)) for c in (0, 5, 10)])
    rows = rows_of(spark, x).unionByName(spark.createDataFrame([(900, None)], "id long, v array<double>"))
    got = {row.id: row.cluster for row in density.density_clusters(rows, "id", "v", min_size=20, neighbours=8).collect()}
    assert got[900] == -1
    for k in range(3):
        own = [got[i] for i in range(40 * k, 40 * k + 40)]
        assert max(set(own), key=own.count) >= 0 and own.count(max(set(own), key=own.count)) >= 36
    assert len({max(set(o), key=o.count) for o in ([got[i] for i in range(40 * k, 40 * k + 40)] for k in range(3))}) == 3
    assert density.density_clusters(rows.where("false"), "id", "v").count() == 0


def test_rounds_leave_the_planner_a_small_guess(spark):
    """Joins multiply the guesses at sizes that checkpoints keep."""
    r = np.random.default_rng(5)
    edges = spark.createDataFrame([(int(a), int(a) + 1 + int(b), float(d)) for a, b, d in zip(range(300), r.integers(0, 4, 300), r.random(300))], "u long, v long, d double")
    near = neighbours.nearest(rows_of(spark, r.normal(size=(150, 4))), 5)
    tree, labels = density.spanning_forest(edges)
    for df in (near, tree, labels):
        assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 60


def test_roots_by_joins_and_in_a_task(spark):
    r = np.random.default_rng(3)
    links = [(0, 1), (1, 0), *((i, int(r.integers(0, i))) for i in range(2, 60)), (100, 101), (101, 100), (102, 101)]
    df = spark.createDataFrame(links, "c long, to long")
    want = {c: 100 if c >= 100 else 0 for c, _ in links}
    assert {x.c: x.root for x in density._roots(df, True).collect()} == want == {x.c: x.root for x in density._roots(df, False).collect()}
