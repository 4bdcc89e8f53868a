"""Edge cases of the operators on tiny frames, golden values, properties."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from inspectra import fixtures as fx
from inspectra.functions import events as ev
from inspectra.functions import keys, verdict
from inspectra.operators import cluster, descriptors, fusion, metrics, registry, results, vectors
from inspectra.sources import assets, images, sinks

GOLDEN = [[0, 14, 6, 0, 0], [19, 0, 1, 0, 6], [0, 0, 0, 17, 0], [0, 0, 0, 0, 10], [0, 3, 10, 0, 1]]


def labelled(spark, table):
    rows = [(p, t) for p, r in enumerate(table) for t, n in enumerate(r) for _ in range(n)]
    return spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "item_id int, predicted int, truth int")


def test_golden_contingency(spark):
    c = metrics.cells(labelled(spark, GOLDEN)).cache()
    assert tuple(metrics.pair_metrics(c).first()) == (0.617040, 0.694540)
    i = metrics.information_metrics(c).first()
    assert (i.nmi, i.homogeneity, i.completeness) == (0.718695, 0.708013, 0.729705)
    assert metrics.adjusted_mutual_information(c).first().ami == 0.699208
    assert metrics.purity(c).first().purity == 0.804598
    assert round(metrics.hungarian_accuracy(c), 6) == 0.804598


def test_metrics_of_identical_and_single_clusters(spark):
    c = metrics.cells(labelled(spark, [[3, 0], [0, 4]]))
    assert metrics.pair_metrics(c).first().ari == 1.0 and metrics.adjusted_mutual_information(c).first().ami == 1.0
    one = metrics.cells(labelled(spark, [[5]]))
    assert metrics.pair_metrics(one).first().ari == 1.0 and metrics.information_metrics(one).first().nmi == 1.0


def test_relabelling_changes_nothing(spark):
    a = metrics.cells(labelled(spark, GOLDEN))
    b = metrics.cells(labelled(spark, GOLDEN[::-1]))
    assert metrics.pair_metrics(a).first() == metrics.pair_metrics(b).first()
    assert metrics.information_metrics(a).first() == metrics.information_metrics(b).first()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.randoms())
def test_assignment_is_optimal(n, m, rng):
    c = np.array([[rng.randint(0, 20) for _ in range(m)] for _ in range(n)], float)
    got = sum(c[i, j] for i, j in metrics.assignment(c))
    k = min(n, m)
    rows = itertools.permutations(range(n), k)
    best = min(sum(c[i, j] for i, j in zip(r, q, strict=True)) for r in rows for q in itertools.combinations(range(m), k))
    assert got == best and len(metrics.assignment(c)) == k


def test_ln_factorial(spark):
    ns = [0, 1, 2, 5, 20, 170, 10**6]
    got = spark.createDataFrame([(n,) for n in ns], "n long").select(metrics.ln_factorial(F.col("n"))).collect()
    for n, r in zip(ns, got, strict=True):
        assert math.isclose(r[0], math.lgamma(n + 1), rel_tol=1e-12, abs_tol=1e-12)


def test_verdict_bounds_and_nan(spark):
    scores = [1.0, 2.0, 2.5, 3.0, 3.1, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(s,) for s in scores], "s double").select(verdict.classify(F.col("s"), F.lit(2.0), F.lit(3.0)).alias("v"))
    assert [r.v for r in df.collect()] == ["normal", "pending", "pending", "pending", "anomaly", "pending", None, "anomaly"]


def test_percentiles_and_fallback(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 8, 16)], "anomaly_score double")
    r = vectors.calibrate(df, (0.0, 0.0)).first()
    assert math.isclose(r.lower, 8.0) and math.isclose(r.upper, 15.68)
    assert tuple(vectors.calibrate(df.where("false"), (1.5, 2.5)).first()) == (1.5, 2.5)


@pytest.mark.parametrize(("n", "want"), [(1, 1), (97, 1), (98, 1), (195, 1), (196, 2), (784, 8)])
def test_coreset_size(spark, n, want):
    df = spark.range(n).select(F.lit("a").alias("image_id"), "id")
    assert vectors.coreset(df, F.xxhash64("id")).count() == want


def test_registry(spark):
    r = fx.registry(spark)
    assert registry.latest(r, "PatchCore").version == "1.10.0"
    with pytest.raises(LookupError):
        registry.latest(r, "none")
    assert registry.next_version(r, registry.latest(r, "patchcore")) == (1, 10, 4)
    assert registry.next_version(r, Row(model_type="new", major_version=3, minor_version=1, patch_version=7)) == (3, 1, 8)
    f = registry.ModelFactory()
    f.register("PatchCore", lambda row: row.model_id)
    assert f.create(r, "patchcore") == "m3"
    with pytest.raises(ValueError, match="unknown"):
        f.create(r, "other")
    f.register("none", lambda row: row)
    assert f.create_optional(r, "none") is None


def test_summary_has_zeros_and_arguments_are_checked(spark):
    empty = spark.createDataFrame([], "event_id string, status string")
    assert {(r.status, r.n) for r in results.verdict_summary(empty).collect()} == {("normal", 0), ("pending", 0), ("anomaly", 0), ("total", 0)}
    for bad in ({"limit": 0}, {"limit": 501}, {"status": "odd"}):
        with pytest.raises(ValueError, match="must be"):
            results.recent(empty, **bad)
    with pytest.raises(ValueError, match="no event"):
        results.retrain_candidates(empty, fx.registry(spark), [])


def test_keys(spark):
    names = {"heatmap/abc.png": "abc", "a/b.tar.gz": "b.tar", ".hid": ".hid", "x": "x", "a/b/c.PNG": "c", "we.ird/na me.jpeg": "na me"}
    df = spark.createDataFrame([(k,) for k in names], "k string").select("k", keys.stem(F.col("k")).alias("s"), keys.suffix(F.col("k")).alias("x"))
    assert {r.k: r.s for r in df.collect()} == names
    paths = spark.createDataFrame([("/b/k",), ("/b/a/c.png",), ("/b",), ("",), (None,)], "p string").select(keys.image_path(F.col("p")).alias("v"))
    assert [tuple(r.v) if r.v else None for r in paths.collect()] == [("b", "k"), ("b", "a/c.png"), None, None, None]
    k = spark.range(1).select(keys.new_key(F.lit("png"))).first()[0]
    assert len(k) == 36 and "-" not in k


def test_messages(spark):
    texts = ['{"event":"inference","bucket":"b","object_key":"k","created_at":"2024-01-02T03:04:05"}', "notjson", "[1]", None, '{"event":"x","data":{"a":1}}', '{"event":"y","data":5}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = ev.decode_inference(df).collect()
    assert got[0].error is None and got[0].content_type == "application/octet-stream" and got[0].size_bytes == 0
    assert all(r.error.startswith("missing") for r in got[1:])
    demo = [r.data for r in ev.project_demo(df).collect()]
    assert demo == [None, None, None, None, '{"a":1}', "5", None]
    t = spark.createDataFrame([('{"event":"train","model":"m","images":"/b/k"}',), ('{"event":"train","images":"/b"}',)], "value string")
    assert [r.error for r in ev.decode_train(t).collect()] == [None, "bad message"]
    back = t.limit(1).select(ev.encode_train(F.lit("m"), F.lit("b"), F.lit("k")).alias("v")).first().v
    assert back == '{"event":"train","model":"m","images":"/b/k"}'


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_nearest_both_ways(spark, limit, monkeypatch):
    monkeypatch.setattr(vectors, "BANK_PIECE", 7)
    monkeypatch.setattr(vectors, "PATCH_PIECE", 5)
    rng = np.random.default_rng(0)
    q, b = rng.normal(size=(23, 6)), rng.normal(size=(31, 6))
    q[0] = b[3]
    patches = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)] + [(99, None)], "id int, vec array<double>")
    bank = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "row_id int, vec array<double>")
    d = np.sqrt(((q[:, None] - b) ** 2).sum(2)).min(1)
    got = {r.id: r.distance for r in vectors.nearest(patches, bank, ["id"], broadcast_bytes=limit).collect()}
    assert got.pop(99) is None and np.allclose([got[i] for i in range(23)], d)
    c = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    got = {r.id: r.distance for r in vectors.nearest(patches, bank, ["id"], "cosine", 3, limit).collect()}
    assert np.allclose([got[i] for i in range(23)], 1 - np.sort(c, axis=1)[:, -3:].mean(1))
    assert vectors.nearest(patches, bank.where("false"), ["id"]).where("distance is not null").count() == 0


def test_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    r = [x.u for x in df.select(vectors.l2_normalise(F.col("v")).alias("u")).collect()]
    assert all(math.isnan(x) for x in r[0]) and r[1] == [0.6, 0.8]
    assert df.select(vectors.l2_normalise(F.col("v"), 1e-12).alias("u")).first().u == [0.0, 0.0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=2, max_size=14))
def test_split_is_never_worse_than_a_threshold(spark, values):
    df = spark.createDataFrame([(0, float(v), i) for i, v in enumerate(values)], "g int, v double, i int")
    rows = fusion.split_1d(df, "g", "v", "i").collect()
    sse = lambda x: float(((np.array(x) - np.mean(x)) ** 2).sum()) if len(x) else 0.0
    got = sse([r.v for r in rows if r.high]) + sse([r.v for r in rows if not r.high])
    best = min([sse([v for v in values if v <= t]) + sse([v for v in values if v > t]) for t in values])
    assert got <= best + 1e-6


def test_refine_equal_halves_and_gates(spark):
    rows = [(i, 0, 0.1 if i < 6 else 0.9, 0.0) for i in range(12)] + [(20 + i, 1, 0.1 if i < 6 else 0.9, 9.0) for i in range(12)] + [(50, -1, 0.5, 0.0)]
    df = spark.createDataFrame(rows, "item_id int, cluster int, ecc double, color_mag double")
    out = {r.item_id: r.refined for r in fusion.refine(df).collect()}
    assert [out[i] for i in range(12)] == [0] * 6 + [2] * 6 and all(out[20 + i] == 1 for i in range(12)) and out[50] == -1
    flat = spark.createDataFrame([(i, 0, 0.5, 0.0) for i in range(12)], df.schema)
    assert {r.refined for r in fusion.refine(flat).collect()} == {0}


def test_rasters():
    a = np.zeros((40, 40))
    a[10:14, 8:20] = 1.0
    mask, smooth = descriptors.defect_mask(a)
    assert mask[12, 13] and smooth.max() < 1 and math.isclose(smooth.sum(), a.sum(), rel_tol=1e-6)
    s = descriptors.shape_descriptor(a > 0)
    assert math.isclose(s[0], 48 / 1600) and math.isclose(s[2], 1.0) and math.isclose(s[3], 1.0) and math.isclose(s[4], 3.0, rel_tol=1e-5)
    assert math.isclose(s[1], math.sqrt(1 - (4**2) / (12**2)), rel_tol=1e-9)
    assert tuple(descriptors.shape_descriptor(np.zeros((5, 5), bool))) == descriptors.SHAPE_DEFAULT
    diagonal = np.eye(6, dtype=bool)
    assert descriptors.label(diagonal).max() == 1
    spiral = np.zeros((9, 9), bool)
    spiral[0], spiral[:, 8], spiral[8], spiral[2:, 0], spiral[2, :7] = True, True, True, True, True
    assert descriptors.label(spiral).max() == 1
    up = descriptors.upsample(np.arange(4.0).reshape(2, 2), 4, 4)
    assert np.allclose(up[0], [0, 0.25, 0.75, 1]) and np.allclose(up[:, 0], [0, 0.5, 1.5, 2])
    rgb = np.zeros((40, 40, 3))
    rgb[a > 0] = (0.9, 0.1, 0.1)
    c = descriptors.color_descriptor(rgb, a, a > 0)
    assert np.allclose(c, [0.9, 0.1, 0.1, 1.1 / 3, 0.8])
    hole = np.ones((5, 5), bool)
    hole[2, 2] = False
    assert descriptors.closing(np.pad(hole, 2))[4, 4]


def test_elongation(spark):
    line = [(0, x, 0, 1.0) for x in range(10)]
    square = [(1, x, y, 1.0) for x in range(5) for y in range(5)]
    few = [(2, 0, 0, 1.0), (2, 5, 5, 1.0)]
    df = spark.createDataFrame(line + square + few, "i int, x int, y int, score double")
    got = {r.i: r.elongation for r in descriptors.elongation(df, ["i"]).collect()}
    assert got[0] > 1000 and math.isclose(got[1], 1.0, rel_tol=1e-6) and got[2] == 1.0


def test_hdbscan_and_prediction(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(40, 2)) * 0.2, rng.normal(size=(40, 2)) * 0.2 + 5, rng.normal(size=(40, 2)) * 0.2 + (0, 9), [[20.0, 20.0]]])
    m = cluster.fit_hdbscan(x, 10)
    assert len(set(m.labels) - {-1}) == 3 and m.labels[-1] == -1
    assert len(set(m.labels[:40]) - {-1}) == 1
    labels, p = m.predict(np.array([x[:40].mean(axis=0), [50.0, 50.0]]))
    assert labels[0] == m.labels[0] and labels[1] == -1 and 0 <= p[0] <= 1 and p[1] == 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    assert {r.i: r.cluster for r in cluster.hdbscan(df, "i", "v", 10).collect()} == dict(enumerate(m.labels.tolist()))
    with pytest.raises(ValueError, match="prediction"):
        cluster.assign(df, cluster.Hdbscan(x[:0], x[:0], x[:0], x[:0], {}, 3), "i", "v")


def test_pca_holds_variance(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5)) * [5, 3, 1, 0.1, 0.1] + 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    mean, parts = fusion.fit_pca(df, "v", 0.95)
    assert np.allclose(mean, x.mean(axis=0)) and parts.shape == (5, 2)
    got = np.array([r.vec for r in fusion.project(df, "i", "v", mean, parts).orderBy("i").collect()])
    u, s, vt = np.linalg.svd(x - x.mean(axis=0))
    assert np.allclose(np.abs(got), np.abs((x - x.mean(axis=0)) @ vt[:2].T))


def test_assets(spark, tmp_path):
    root = f"file://{tmp_path}"
    assets.write_band(spark, root, "patchcore", "1.0.0", 16.2815, 17.6712)
    assert assets.read_band(spark, root, "patchcore", "1.0.0") == (16.2815, 17.6712)
    (tmp_path / "patchcore" / "2.0.0").mkdir(parents=True)
    (tmp_path / "patchcore" / "2.0.0" / "buffer_zone.txt").write_text("lower=1\n")
    with pytest.raises(KeyError):
        assets.read_band(spark, root, "patchcore", "2.0.0")
    np.save(tmp_path / "bank.npy", np.arange(6, dtype=np.float32).reshape(3, 2))
    bank = assets.import_npy(spark, f"{root}/bank.npy")
    assets.write_bank(bank, root, "patchcore", "1.0.1")
    back = assets.read_bank(spark, root, "patchcore", "1.0.1")
    import io

    assert np.array_equal(np.load(io.BytesIO(assets.export_npy(back))), np.arange(6, dtype=np.float32).reshape(3, 2))
    s = assets.Settings.from_env({"INSPECTRA_ONCE": "Yes", "INSPECTRA_RECENT_GOOD": "9"})
    assert s.once and s.recent_good == 9 and s.topic == "events"
    with pytest.raises(ValueError, match="missing"):
        assets.Settings.from_env({}, required=("user",))


def test_objects_and_inserts(spark, tmp_path):
    path = f"file://{tmp_path}/objects"
    df = spark.createDataFrame([("images", "a.png", "image/png", bytearray(b"123")), ("other", "b", "x", bytearray(b""))], "bucket string, object_key string, content_type string, content binary")
    assert {r.size_bytes for r in sinks.put_objects(df, path).collect()} == {0, 3}
    assert sinks.get_object(spark, path, "images", "a.png") == b"123"
    with pytest.raises(PermissionError):
        sinks.get_object(spark, path, "other", "b")
    with pytest.raises(KeyError):
        sinks.get_object(spark, path, "images", "none")
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    table = f"file://{tmp_path}/t"
    for _ in range(2):
        sinks.insert_if_absent(rows, table, "k")
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [("a", 1), ("b", 2)]


def png(rgb):
    """A PNG of 8-bit RGB rows."""
    import struct
    import zlib

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = b"".join(b"\0" + r.tobytes() for r in rgb)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", rgb.shape[1], rgb.shape[0], 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    a = np.zeros((20, 30, 3), np.uint8)
    a[..., 0] = 200
    for at in ("test/hole/1.png", "test/good/2.png", "test/hole/x.txt"):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / at).write_bytes(png(a) if at.endswith("png") else b"junk")
    root = f"file://{tmp_path}"
    assert images.scan_folder(spark, f"{root}/none").count() == 0
    assert [r.content_type for r in images.scan_folder(spark, f"{root}/test/hole").collect()] == ["image/png"]
    assert {r.label for r in images.scan_labelled(spark, f"{root}/test").collect()} == {"hole"}
    assert images.scan_labelled(spark, f"{root}/test", True).count() == 2
    assert images.scan_normals(spark, f"{root}/none", spark.range(3)).count() == 3
    shown = images.decode(spark, f"{root}/test/hole")
    r = shown.first()
    assert (r.h, r.w) == (20, 30) and np.allclose(np.array(r.rgb).reshape(20, 30, 3), a / 255)
    got = images.embed(shown, images.StubEmbedder()).collect()
    assert len(got) == 49 and all(x.error is None for x in got)
    bad = images.embed(shown, lambda t: 1 / 0).collect()
    assert len(bad) == 1 and "ZeroDivision" in bad[0].error and bad[0].vec is None
    assert images.preprocess_crop(a / 255).shape == (3, 224, 224)
