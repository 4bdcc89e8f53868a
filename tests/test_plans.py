"""The composed plans on small made-up images."""

import numpy as np
import pytest

from inspectra import fixtures as fx
from inspectra.operators import metrics, vectors
from inspectra.plans import clustering
from inspectra.plans.retrain import retrain


def vectors_of(spark, n=90, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    centres = np.eye(3, dim) * 3
    x = np.concatenate([rng.normal(size=(n // 3, dim)) * 0.15 + c for c in centres])
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")


def test_cluster_assignment(spark):
    x, df = vectors_of(spark)
    model = clustering.fit_clusterer(df, "v", 5, 8)
    got = {r.i: r.cluster_id for r in clustering.assign_clusters(df, model, "i", "v").collect()}
    rows = spark.createDataFrame([(i, c, i // 30) for i, c in got.items()], "item_id int, predicted int, truth int")
    assert metrics.pair_metrics(metrics.cells(rows)).first().ari > 0.9
    zero = spark.createDataFrame([(0, [0.0] * 12)], "i int, v array<double>")
    assert clustering.assign_clusters(zero, model, "i", "v").first().cluster_id == -1


def test_experiment_finds_the_classes(spark):
    rng = np.random.default_rng(7)
    rows, colors, shapes = [], [], []
    for i in range(45):
        k = i // 15
        for p in range(6):
            odd = p == 0
            for level in ("a", "b"):
                v = rng.normal(size=8) * 0.05 + (np.eye(4, 8)[k + 1] * 3 if odd else np.eye(4, 8)[0] * 3)
                rows.append((i, level, p, [float(t) for t in v]))
        colors.append((i, [float(t) for t in rng.normal(size=5) * 0.01 + k]))
        shapes.append((i, [0.1, 0.5, 1.0, 1.0, 1.0]))
    patches = spark.createDataFrame(rows, "image_id int, level string, patch_idx int, vec array<double>")
    bank = spark.createDataFrame([(level, [float(t) for t in rng.normal(size=8) * 0.05 + np.eye(4, 8)[0] * 3]) for level in ("a", "b") for _ in range(20)], "level string, vec array<double>")
    out = clustering.experiment(patches, bank, spark.createDataFrame(colors, "image_id int, color array<double>"), spark.createDataFrame(shapes, "image_id int, shape array<double>"), 5, 5)
    got = {r.image_id: r.refined for r in out.collect()}
    table = spark.createDataFrame([(i, c, i // 15) for i, c in got.items()], "item_id int, predicted int, truth int")
    assert len(got) == 45 and metrics.pair_metrics(metrics.cells(table)).first().ari > 0.8


def test_retrain_makes_a_candidate(spark):
    rng = np.random.default_rng(1)
    rows = [(str(i), p, [float(t) for t in rng.normal(size=4)]) for i in range(6) for p in range(4)]
    patches = spark.createDataFrame(rows, "image_id string, patch_idx int, vec array<double>")
    bank = patches.where("image_id = '0'").select("vec")
    results = spark.createDataFrame([(str(i), str(i), "m3", "normal" if i < 4 else "anomaly", f"{i}.png") for i in range(6)], "event_id string, image_id string, model_id string, status string, object_key string").selectExpr("*", "timestamp'2024-01-01' as inferred_at")
    c = retrain(fx.registry(spark), results, bank, patches.where("image_id = '5'"), patches.where("image_id in ('1', '2', '3', '4')"), (1.0, 2.0), "patchcore")
    assert c.version == (1, 10, 4) and c.bank.count() == 5
    row = c.row.first()
    assert row.model_id == "patchcore-1.10.4" and not row.is_valid
    added = vectors.coreset(patches.where("image_id = '5'"), vectors.F.xxhash64(vectors.F.lit(42), "patch_idx"))
    grown = np.array([r.vec for r in bank.unionByName(added.select("vec")).collect()])
    scores = []
    for i in "123":
        q = np.array([r.vec for r in patches.where(f"image_id = '{i}'").collect()])
        scores.append(np.sqrt(((q[:, None] - grown) ** 2).sum(2)).min(1).max())
    assert np.allclose(tuple(c.band.first()), np.percentile(scores, [75, 99]))
    with pytest.raises(LookupError):
        retrain(fx.registry(spark), results, bank, patches, patches, (1.0, 2.0), "none")
