"""Work on all pairs of blocks: no copies of rows or edges on the disk."""

import os

import numpy as np

from inspectra.operators import density, neighbours
from inspectra.tables import Tables, indexed


def shuffled(spark, made) -> int:
    """Bytes that ``made()`` shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def stages():
        bus.waitUntilEmpty(30_000)
        found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = set(stages())
    made()
    return sum(size for stage, size in stages().items() if stage not in before)


def test_a_row_is_not_copied_for_every_block(spark):
    """Fifteen times the blocks, and no more bytes in the shuffles of neighbours."""
    rng = np.random.default_rng(2)
    tables, sizes = Tables(spark, "t"), {}
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.normal(size=(1500, 64)))], "i long, vec array<double>")
    points = tables.save(indexed(df.orderBy("i"), tables), "points")
    for rows in (750, 50):
        b = neighbours.blocks(points, tables, rows)
        sizes[rows] = shuffled(spark, lambda: neighbours.nearest_k(b, 3, tables).write.format("noop").mode("overwrite").save())
    assert sizes[50] < 2 * sizes[750]


def test_chunks_of_edges_leave_no_copies(spark):
    """The edges that are left after a chunk replace those before it."""
    rng = np.random.default_rng(3)
    n = 400
    tables = Tables(spark, "t")
    edges = spark.createDataFrame([(i, int(rng.integers(i)), float(rng.random())) for i in range(1, n)], "a long, b long, w double")
    clusters, left = density.condense(edges, n, 3, tables, 40)
    kept = [d for d in os.listdir(tables.root.removeprefix("file://")) if d.startswith("left-")]
    assert len(kept) <= 1 and left.count() == n


def test_spanning_forest():
    """Against Kruskal's algorithm, with ties and several parts."""
    rng = np.random.default_rng(5)
    for n, m, most in ((2, 1, 1), (30, 20, 3), (60, 400, 5), (200, 3000, 10_000)):
        a, b, w = rng.integers(n, size=m), rng.integers(n, size=m), rng.integers(most, size=m) / 8
        up, want = list(range(n)), []
        for e in np.argsort(w, kind="stable"):
            x, y = int(a[e]), int(b[e])
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            if x != y:
                up[x] = y
                want.append(int(e))
        assert sorted(density.spanning_forest(a, b, w, n).tolist()) == sorted(want)
