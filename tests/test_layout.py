"""Kernel PCA and UMAP layouts over any number of rows."""

import numpy as np

from inspectra.operators import fusion, layout


def groups(n=120, d=10, seed=2):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(size=(n // 3, d)) * 0.3 + c for c in np.eye(3, d) * 4])


def frame(spark, x):
    return spark.createDataFrame([(i, None if v is None else list(map(float, v))) for i, v in enumerate(x)], "i long, v array<double>")


def kept(x, y, k=10):
    """Share of the k nearest by cosine that are among the 2k nearest in a layout."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = 1 - u @ u.T, ((y[:, None] - y) ** 2).sum(2)
    np.fill_diagonal(a, np.inf)
    np.fill_diagonal(b, np.inf)
    a, b = np.argsort(a, axis=1)[:, :k], np.argsort(b, axis=1)[:, : 2 * k]
    return np.mean([len(set(p) & set(q)) / k for p, q in zip(a, b)])


def test_layout_keeps_groups_and_neighbours_in_any_parts(spark):
    x = groups()
    own = np.arange(120) // 40
    for part, block in ((10**6, 1500), (25, 30)):
        rows = sorted((r.i, r.y) for r in layout.fit(frame(spark, x), "i", "v", 10, part=part, block_rows=block).collect())
        y = np.array([r[1] for r in rows])
        d = np.sqrt(((y[:, None] - y) ** 2).sum(2))
        same = own[:, None] == own
        assert d[same].mean() < 0.5 * d[~same].mean()
        assert kept(x, y) > 0.55  # by chance within a group: about 0.5 x 10 / 39, over all: 0.17


def test_graph_is_exact_and_symmetric(spark):
    rows = [(0, [(0.1, 1), (0.2, 2)]), (1, [(0.1, 0), (0.3, 2)]), (2, [(0.2, 0), (0.3, 1)])]
    near = spark.createDataFrame(rows, "idx long, near array<struct<d: double, j: long>>")
    w = {(r.a, r.b): r.w for r in layout.graph(near, 2).collect()}
    assert len(w) == 6 and all(abs(w[a, b] - w[b, a]) < 1e-12 and 0 < w[a, b] <= 1 for a, b in w)
    assert w[0, 1] == 1.0


def test_transform_in_pieces(spark):
    x = groups()
    fitted = layout.fit(frame(spark, x), "i", "v", 10)
    places = {r.i: np.array(r.y) for r in fitted.collect()}
    new = [*x[::7], None, [float("nan")] * 10]
    for pieces in ((5000, 5000), (4, 11)):
        got = {r.i: r.y for r in layout.transform(frame(spark, new), fitted, "i", "v", 10, *pieces).collect()}
        assert got[len(new) - 1] is None and got[len(new) - 2] is None
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        for i in range(len(new) - 2):
            c = np.sort(1 - u @ u[7 * i])[:10]
            at = np.argsort(1 - u @ u[7 * i], kind="stable")[:10]
            w = np.exp(-(c - c[0]) / max(c.mean() - c[0], 1e-9))
            assert np.allclose(got[i], (w[:, None] * np.array([places[j] for j in at])).sum(0) / w.sum(), atol=1e-6)


def test_small_layouts(spark):
    assert layout.fit(frame(spark, []), "i", "v").count() == 0
    assert [r.y for r in layout.fit(frame(spark, [[1.0, 2.0], [2.0, 1.0], None]), "i", "v").collect()] == [[0.0, 0.0]] * 2
    assert layout.fit(frame(spark, np.ones((8, 4))), "i", "v", 5).count() == 8


def test_kernel_pca_equals_the_kernel(spark):
    """Against the eigenvectors of the n x n kernel, up to their signs."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(70, 6)) * [3, 2, 1, 1, 0.5, 0.1] + 1
    x[3] = 0
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    g = u @ u.T
    g = g - g.mean(0) - g.mean(1, keepdims=True) + g.mean()
    value, vector = np.linalg.eigh(g)
    want = vector[:, ::-1][:, :4] * np.sqrt(value[::-1][:4])
    got = np.array([r.vec for r in fusion.kernel_pca(frame(spark, x).repartition(5), "i", "v", 4).orderBy("i").collect()])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-9)
    assert fusion.kernel_pca(frame(spark, []), "i", "v").count() == 0
