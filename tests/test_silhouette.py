"""Silhouettes: the same whatever the pieces, and no copies of rows on the disk."""

import numpy as np
import pytest

from inspectra.operators import metrics
from test_pairs import shuffled

ROWS = "i long, c int, v array<double>"


def silhouettes(x, c):
    d = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() < 2 or len(set(c)) < 2:
            out.append(0.0)
            continue
        a, b = d[i, own].sum() / (own.sum() - 1), min(d[i, c == k].mean() for k in set(c) - {c[i]})
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("piece", [4000, 17, 3])
def test_silhouette_of_any_pieces(spark, monkeypatch, piece):
    """Clusters of one point, of less than a piece and of many pieces; noise is left out."""
    monkeypatch.setattr(metrics, "PIECE", piece)
    rng = np.random.default_rng(1)
    c = np.array([0] * 50 + [1] * 17 + [2] * 5 + [3] + [4, 4] + [9] * 8)
    x = rng.normal(size=(len(c), 12)) + c[:, None]
    x[3] = x[4]
    order = rng.permutation(len(c))
    rows = [(int(i) * 7, int(c[i]), x[i].tolist()) for i in order] + [(-1, -1, x[0].tolist())]
    got = {r.i: r.silhouette for r in metrics.silhouette(spark.createDataFrame(rows, ROWS), "i", "c", "v").collect()}
    assert len(got) == len(c)
    assert np.allclose([got[i * 7] for i in range(len(c))], silhouettes(x, c), atol=1e-9)


def test_silhouette_of_rows_without_a_vector(spark):
    """As in SQL: they count as members, have no distance and are 0 themselves."""
    rows = [(0, 0, [0.0]), (1, 0, [1.0]), (2, 1, [5.0]), (3, 1, None), (4, 2, None)]
    got = {r.i: r.silhouette for r in metrics.silhouette(spark.createDataFrame(rows, ROWS), "i", "c", "v").collect()}
    assert got[3] == got[4] == 0 and got[0] == pytest.approx((2.5 - 1) / 2.5)


def test_a_row_is_not_copied_for_every_piece(spark, monkeypatch):
    """Fifteen times the pieces, and no more bytes in the shuffles."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, i % 4, r.tolist()) for i, r in enumerate(rng.normal(size=(1500, 64)))], ROWS).repartition(2).cache()
    df.count()
    sizes = {}
    for piece in (750, 50):
        monkeypatch.setattr(metrics, "PIECE", piece)
        sizes[piece] = shuffled(spark, lambda: metrics.silhouette(df, "i", "c", "v").agg({"silhouette": "avg"}).collect())
    assert sizes[50] < 2 * sizes[750]
