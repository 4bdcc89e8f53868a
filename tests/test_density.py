"""Distributed HDBSCAN against a plain definition, whatever the blocks and chunks."""

import numpy as np
import pytest

from inspectra.operators import cluster, density, neighbours
from inspectra.tables import Tables, indexed

SCHEMA = "i long, v array<double>"


def frame(spark, x):
    return spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], SCHEMA)


def brute(x, least, k):
    """Top down: a set of points falls apart at its longest needed step, all steps
    of that length at once."""
    n = len(x)
    d = neighbours.distances(x, x)
    np.fill_diagonal(d, np.inf)
    core = np.sort(d, axis=1)[:, k - 1]
    r = np.maximum(np.maximum(np.minimum(d, 1e9), core[:, None]), core)
    np.fill_diagonal(r, 0)

    def parts(s, w):
        left, out = set(s), []
        while left:
            todo, seen = [left.pop()], []
            while todo:
                p = todo.pop()
                seen.append(p)
                more = [q for q in left if r[p, q] < w]
                left -= set(more)
                todo += more
            out.append(sorted(seen))
        return out

    clusters = []  # birth, points that leave with their density, children

    def grow(s, birth):
        c = {"birth": birth, "left": [], "children": []}
        clusters.append(c)
        while True:
            steps = sorted({r[a, b] for a in s for b in s if a != b})
            w = next(v for v in reversed(steps) if len(parts(s, v)) > 1)
            lam = 1 / w if w > 0 else density.MOST_LAMBDA
            below = parts(s, w)
            big = [p for p in below if len(p) >= least]
            c["left"] += [(p, lam) for q in below if len(q) < least for p in q]
            if len(big) != 1:
                c["children"] = [grow(b, lam) for b in big]
                return c
            s = big[0]

    if n < least:
        return [-1] * n, [0.0] * n
    root = grow(list(range(n)), 0.0)

    def points(c):
        return c["left"] + [p for k_ in c["children"] for p in points(k_)]

    def best(c):
        own = sum(lam - c["birth"] for _, lam in c["left"]) + sum((k_["birth"] - c["birth"]) * len(points(k_)) for k_ in c["children"])
        below = [best(k_) for k_ in c["children"]]
        total = sum(b[0] for b in below)
        if c is root or (below and total > own):
            return total, [z for b in below for z in b[1]]
        return own, [c]

    labels, strength = [-1] * n, [0.0] * n
    for name, c in enumerate(sorted(best(root)[1], key=lambda c: min(p for p, _ in points(c)))):
        top = max(lam for _, lam in points(c))
        for p, lam in points(c):
            labels[p], strength[p] = name, 1.0 if top >= density.MOST_LAMBDA else min(lam, top) / top
    return labels, strength


def fitted(spark, x, least, **more):
    return sorted((r.i, r.cluster, r.probability) for r in density.fit(frame(spark, x), "i", "v", least, **more).collect())


def groups(rng, n=60, d=3):
    return np.concatenate([rng.normal(c, s, (n // 3, d)) for c, s in ((0, 0.3), (3, 0.5), (6, 0.2))])


@pytest.mark.parametrize("block_rows, chunk", [(1000, 1 << 18), (7, 20)])
def test_equals_the_definition(spark, block_rows, chunk):
    rng = np.random.default_rng(4)
    x = groups(rng)
    labels, strength = brute(x, 4, 4)
    got = fitted(spark, x, 4, block_rows=block_rows, chunk=chunk)
    assert [g[1] for g in got] == labels and max(labels) >= 2
    assert np.allclose([g[2] for g in got], strength)


def test_ties_and_doubles(spark):
    """Points on a grid and many copies: every length is tied."""
    x = np.array([(a, b) for a in range(5) for b in range(5)] + [(20, 20)] * 12 + [(20, 21)] * 3 + [(40 + a, 0) for a in range(6)], float)
    labels, strength = brute(x, 3, 3)
    for block_rows, chunk in ((1000, 1 << 18), (6, 10)):
        got = fitted(spark, x, 3, block_rows=block_rows, chunk=chunk)
        assert [g[1] for g in got] == labels
        assert np.allclose([g[2] for g in got], strength)


def test_equals_the_local_fit_on_the_tables(spark):
    """The local fit goes another way (a tree by Prim, cut from the top)."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    want = cluster.fit_hdbscan(x).labels
    got = np.array([g[1] for g in fitted(spark, x, 3, block_rows=60, chunk=200)])
    pairs = set(zip(want.tolist(), got.tolist()))
    assert len(pairs) == len(set(want)) == len(set(got))


def test_small_tables(spark):
    one = np.array([[1.0, 2.0]])
    assert fitted(spark, one[:0], 3) == [] and fitted(spark, one, 3) == [(0, -1, 0.0)]
    assert [g[1] for g in fitted(spark, np.array([[0.0], [1.0]]), 3)] == [-1, -1]
    df = spark.createDataFrame([(i, [float(i % 4 // 2 * 10), float(i)] if i else None) for i in range(9)], SCHEMA)
    assert density.fit(df, "i", "v").count() == 8


def test_neighbours_are_exact(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([groups(rng, 90, 5), np.zeros((15, 5)), rng.normal(50, 1, (5, 5))])
    tables = Tables(spark, "t")
    points = indexed(frame(spark, x).orderBy("i").withColumnRenamed("v", "vec"), tables)
    d = neighbours.distances(x, x)
    np.fill_diagonal(d, np.inf)
    for rows, pivots in ((1000, 10), (8, 100), (8, 2)):
        b = neighbours.blocks(points, tables, rows, pivots)
        got = {r.idx: [p.d for p in r.near] for r in neighbours.nearest_k(b, 6, tables).collect()}
        assert len(got) == len(x) and all(got[i] == np.sort(d[i])[:6].tolist() for i in got)


def test_assignment_in_pieces(spark):
    """Any pieces give what the local model says."""
    rng = np.random.default_rng(7)
    x, new = groups(rng), np.concatenate([groups(rng), rng.normal(3, 4, (40, 3))])
    m = cluster.fit_hdbscan(x, 4)
    want = m.predict(new)
    f = density.fit(frame(spark, x), "i", "v", 4, block_rows=20)
    rows = frame(spark, new).unionByName(spark.createDataFrame([(999, None)], SCHEMA))
    for pieces in ((1000, 1000), (30, 17)):
        got = {r.i: (r.cluster_id, r.probability) for r in density.assign(rows, f, "i", "v", 4, *pieces).collect()}
        assert got.pop(999) == (-1, 0.0)
        assert [got[i][0] for i in range(len(new))] == want[0].tolist()
        assert np.allclose([got[i][1] for i in range(len(new))], want[1])
    with pytest.raises(ValueError):
        density.assign(rows, f.limit(0), "i", "v")


def test_forest_finds_most_neighbours_and_the_same_groups(spark):
    """Linear neighbours: recall against brute force, groups against the exact fit."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 0.5, (200, 12)) for c in rng.normal(0, 4, (6, 12))])
    tables = Tables(spark, "t")
    points = indexed(frame(spark, x).orderBy("i").withColumnRenamed("v", "vec"), tables)
    d = neighbours.distances(x, x)
    np.fill_diagonal(d, np.inf)
    true = [set(r) for r in np.argsort(d, axis=1)[:, :10].tolist()]
    near = {r.idx: {p.j for p in r.near} for r in neighbours.forest_k(points, 10, tables, rows=150).collect()}
    assert np.mean([len(near[i] & true[i]) / 10 for i in range(len(x))]) >= 0.9
    exact = [g[1] for g in fitted(spark, x, 15, block_rows=80)]
    quick = [g[1] for g in fitted(spark, x, 15, block_rows=150, trees=8)]
    assert len(set(exact) - {-1}) == 6
    agree = np.mean([(a == b) == (c == d_) for (a, c), (b, d_) in zip(zip(exact, quick), reversed(list(zip(exact, quick))))])
    assert agree >= 0.95
