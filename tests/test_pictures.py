"""Pictures, maps of several levels, and objects fetched in tasks."""

import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inspectra.operators import pictures
from inspectra.plans import clustering
from inspectra.sources import images, sinks


def read_png(data):
    """A plain reader of what the writer makes."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, body = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + part)
        if kind == b"IHDR":
            w, h = struct.unpack(">II", part[:8])
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + 3 * w)
    assert not lines[:, 0].any()
    return lines[:, 1:].reshape(h, w, 3)


def test_heatmaps_are_files_that_open(spark, tmp_path):
    rng = np.random.default_rng(1)
    scores = [rng.random(16) * 20 for _ in range(3)]
    rgb = rng.random((6, 5, 3))
    rows = [(i, 4, 4, [float(x) for x in s], (6, 5, [float(x) for x in rgb.ravel()]) if i else None) for i, s in enumerate(scores)] + [(9, 4, 4, None, None)]
    maps = spark.createDataFrame(rows, "image_id int, h int, w int, values array<double>, px struct<h: int, w: int, rgb: array<double>>")
    made = pictures.heatmap_pngs(maps, 10.0, 15.0, 32, rgb="px").withColumn("name", F.concat(F.lit("heat/"), "image_id", F.lit(".png")))
    done = sinks.write_files(made, f"file://{tmp_path}/o", "name", "png").collect()
    assert sorted(r.name for r in done) == ["heat/0.png", "heat/1.png", "heat/2.png"] and all(r.error is None for r in done)
    for i, s in enumerate(scores):
        want = pictures.heatmap_picture(s.reshape(4, 4), 8.0, 18.0, rgb if i else None, 32)
        assert (read_png((tmp_path / "o" / "heat" / f"{i}.png").read_bytes()) == want).all() and want.shape == (32, 64 if i else 32, 3)
    # Spark's own image source opens them.
    opened = spark.read.format("image").load(f"file://{tmp_path}/o/heat").select("image.height", "image.width").collect()
    assert sorted((r.height, r.width) for r in opened) == [(32, 32), (32, 64), (32, 64)]


def test_colours():
    c = pictures.jet(np.array([-1.0, 0.0, 0.5, 1.0, 2.0, np.nan])).tolist()
    assert c[0] == c[1] == c[5] == [0, 0, 128] and c[2] == [128, 255, 128] and c[3] == c[4] == [128, 0, 0]


def pictures_of(spark, n=6, side=28):
    rng = np.random.default_rng(3)
    rows = [(f"i{i}", side, side, [float(x) for x in (rng.random((side, side, 3)) * 0.2 + i / n).ravel()]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "path string, h int, w int, rgb array<double>")


def pooling_network(levels):
    """The bytes of an ONNX network that pools its input once a level, by hand: a
    message is its numbered fields, lengths and numbers are varints."""

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    num = lambda k, n: varint(k << 3) + varint(n)
    sub = lambda k, *parts: varint(k << 3 | 2) + varint(len(b"".join(parts))) + b"".join(parts)
    text = lambda k, s: sub(k, s.encode())
    ints = lambda name, v: sub(5, text(1, name), *(num(8, x) for x in v), num(20, 7))
    value = lambda k, name, dims: sub(k, text(1, name), sub(2, sub(1, num(1, 1), sub(2, *(sub(1, num(1, d)) for d in dims)))))
    nodes = [sub(1, text(1, "x"), text(2, k), text(4, "AveragePool"), ints("kernel_shape", (n, n)), ints("strides", (n, n))) for k, n in levels.items()]
    outs = [value(12, k, (1, 3, 28 // n, 28 // n)) for k, n in levels.items()]
    return num(1, 7) + sub(7, *nodes, text(2, "g"), value(11, "x", (1, 3, 28, 28)), *outs) + sub(8, text(1, ""), num(2, 11))


def test_levels_of_a_network(spark, tmp_path):
    """One pass of an ONNX network gives the maps of all levels."""
    path = str(tmp_path / "net.onnx")
    (tmp_path / "net.onnx").write_bytes(pooling_network({"p4": 4, "p7": 7}))
    rows, df = pictures_of(spark)
    out = images.embed_levels(df.unionByName(spark.createDataFrame([("bad", 2, 2, [0.0])], df.schema)), images.OnnxPyramid(path, {"fine": "p4", "coarse": "p7"}), lambda rgb: images.preprocess_square(rgb, 28))
    got = {(r.path, r.level, r.patch_idx): r for r in out.collect()}
    assert got["bad", None, -1].error and len(got) == 1 + 6 * (49 + 16)
    x = np.array(rows[2][3]).reshape(28, 28, 3)
    for level, n in (("fine", 4), ("coarse", 7)):
        want = x.reshape(28 // n, n, 28 // n, n, 3).mean(axis=(1, 3)).reshape(-1, 3)
        have = np.array([got["i2", level, p].vec for p in range(len(want))])
        assert np.allclose(have, want, atol=1e-5) and got["i2", level, 0].h == 28 // n
    single = images.embed(df, images.OnnxEmbedder(path), lambda rgb: images.preprocess_square(rgb, 28))
    assert single.where("error is null").count() > 0


def test_the_experiment_reads_the_levels(spark):
    _, df = pictures_of(spark, 12)
    levels = images.embed_levels(df, images.PyramidStub({"a": 4, "b": 2}, 8), lambda rgb: images.preprocess_square(rgb, 28)).where("error is null").withColumnRenamed("path", "image_id")
    bank = levels.where("image_id < 'i2'").select("level", F.col("vec").cast("array<double>").alias("vec"))
    colors = df.selectExpr("path as image_id", "array(rgb[0], rgb[1], rgb[2]) as color")
    shapes = df.selectExpr("path as image_id", "array(0.1D, 0.5D, 1D, 1D, 1D) as shape")
    patches = levels.select("image_id", "level", "patch_idx", F.col("vec").cast("array<double>").alias("vec"))
    assert clustering.experiment(patches, bank, colors, shapes, 3, 4).count() == 12


def test_validation_skips_what_cannot_be_had_and_stops_at_a_bad_score(spark, tmp_path):
    def get(bucket, key):
        if key == "gone":
            raise FileNotFoundError(key)
        if key == "text":
            return b"no image"
        out = io.BytesIO()
        np.save(out, np.full((28, 28, 3), float(key)))
        return out.getvalue()

    def load(content):
        return np.load(io.BytesIO(content))

    rows = spark.createDataFrame([(i, "b", k) for i, k in enumerate(["0.1", "gone", "0.5", "text", "0.9", None])], "image_id int, bucket string, object_key string")
    patches, failed = images.validation_patches(rows, get, load, images.StubEmbedder(), f"file://{tmp_path}/v", threads=2)
    assert sorted({r.image_id for r in patches.collect()}) == [0, 2, 4] and patches.count() == 3 * 49
    errors = {r.image_id: r.error.split(":")[0] for r in failed.collect()}
    assert errors == {1: "FileNotFoundError", 3: "ValueError", 5: "KeyError"}

    def broken(tensor):
        raise RuntimeError("the network fails")

    with pytest.raises(Exception, match="the network fails"):
        images.validation_patches(rows, get, load, broken, f"file://{tmp_path}/w")


def test_fetching_is_bounded(spark):
    import threading

    class Counting:
        def __init__(self):
            self.at_once, self.most = 0, 0

        def __getstate__(self):
            return {}

        def __call__(self, key):
            import time

            lock = globals().setdefault("_lock", threading.Lock())
            with lock:
                self.at_once = getattr(self, "at_once", 0) + 1
                self.most = max(getattr(self, "most", 0), self.at_once)
            time.sleep(0.01)
            with lock:
                self.at_once -= 1
            return str(self.most).encode()

    rows = spark.range(40).selectExpr("cast(id as string) as k").coalesce(1)
    got = images.fetch(rows, Counting(), ("k",), 4).collect()
    assert len(got) == 40 and max(int(r.content) for r in got) <= 4
