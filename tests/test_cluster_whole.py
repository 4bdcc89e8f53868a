"""HDBSCAN fits on all points, whatever their number."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from inspectra import catalog
from inspectra.operators import cluster


def test_cluster_assign_fits_on_the_whole_bank(spark, tmp_path):
    """The cluster of greatest ids lies beyond the first 5,000 rows."""
    rng = np.random.default_rng(0)
    n, late = 5060, 60
    x = rng.normal(size=(n, 3))
    x[-late:] = 50 + 0.01 * rng.normal(size=(late, 3))
    table = pa.table({"vec_id": np.arange(n) * 2, "embedding": pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())), "label": np.zeros(n, np.int32)})
    pq.write_table(table, f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r.cluster_id for r in catalog.QUERIES["cluster_assign"](spark, f"file://{tmp_path}").collect()}
    assert len(got) == n
    assert sum(got[2 * i] >= 0 for i in range(n - late, n)) > late / 2
    assert len(cluster.fit_hdbscan(x).labels) == n


def test_blocks_do_not_change_the_fit(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.3, (40, 4)) for c in (0, 3, 6)])
    want = cluster.fit_hdbscan(x, 5)
    monkeypatch.setattr(cluster, "BLOCK", 7)
    got = cluster.fit_hdbscan(x, 5)
    assert (got.labels == want.labels).all() and np.allclose(got.probabilities, want.probabilities) and set(got.labels) >= {0, 1, 2}
