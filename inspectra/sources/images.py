"""Image scans, decoding and preprocessing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import LABELLED_SUFFIXES, SCAN_SUFFIXES, content_type, suffix

FILES = "path string, modificationTime timestamp, length long, content binary"
#: Channel means and spreads of the second model's preprocessing.
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scan_folder(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SCAN_SUFFIXES) -> DataFrame:
    """Image files right in a folder; a folder that is missing has none."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], FILES + ", content_type string")
    return spark.read.format("binaryFile").load(folder).where(suffix(F.col("path")).isin(*suffixes)).withColumn("content_type", content_type(F.col("path")))


def scan_stream(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SCAN_SUFFIXES) -> DataFrame:
    """The same folder as a stream; each file is taken once (checkpoint)."""
    files = spark.readStream.format("binaryFile").schema(FILES).load(folder)
    return files.where(suffix(F.col("path")).isin(*suffixes)).withColumn("content_type", content_type(F.col("path")))


def scan_labelled(spark: SparkSession, root: str, include_good: bool = False) -> DataFrame:
    """Images below a root with the folder's name as label."""
    if not _exists(spark, root):
        return spark.createDataFrame([], FILES + ", label string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(suffix(F.col("path")).isin(*LABELLED_SUFFIXES))
    files = files.withColumn("label", F.element_at(F.split("path", "/"), -2))
    return files if include_good else files.where("label <> 'good'")


def scan_normals(spark: SparkSession, root: str | None, fallback: DataFrame, most: int = 200) -> DataFrame:
    """The first normal images by path, or the fallback images if there is none."""
    if root is not None and _exists(spark, root):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(suffix(F.col("path")).isin(*LABELLED_SUFFIXES))
        if not found.isEmpty():
            return found.orderBy("path").limit(most)
    return fallback


def decode(spark: SparkSession, path: str) -> DataFrame:
    """``path, h, w, rgb``: row-major pixels in 0..1 from Spark's image source
    (whose bytes are blue-green-red); files that are no image are left out."""
    raw = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")

    def run(batches):
        for b in batches:
            out = []
            for h, w, c, data in zip(b["height"], b["width"], b["nChannels"], b["data"], strict=True):
                a = np.frombuffer(data, np.uint8).reshape(h, w, c)
                a = np.repeat(a, 3, axis=2) if c == 1 else a[:, :, 2::-1]
                out.append((a.astype(float) / 255).ravel().tolist())
            yield pd.DataFrame({"path": b["origin"], "h": b["height"], "w": b["width"], "rgb": out})

    return raw.mapInPandas(run, "path string, h int, w int, rgb array<double>")


def resize(rgb: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear; when shrinking, the kernel is widened to the step."""

    def weights(n: int, m: int) -> np.ndarray:
        step = max(n / m, 1.0)
        centre = (np.arange(m) + 0.5) * n / m
        d = np.abs((np.arange(n) + 0.5) - centre[:, None]) / step
        k = np.maximum(0, 1 - d)
        return k / k.sum(axis=1, keepdims=True)

    return np.einsum("yi,ijc,xj->yxc", weights(rgb.shape[0], height), rgb, weights(rgb.shape[1], width))


def preprocess_square(rgb: np.ndarray, size: int = 224) -> np.ndarray:
    """First model: square resize to 0..1, channels first; nothing subtracted."""
    return resize(rgb, size, size).transpose(2, 0, 1).astype(np.float32)


def preprocess_crop(rgb: np.ndarray, size: int = 224) -> np.ndarray:
    """Second model: shorter side to size, centre crop, channels standardised."""
    h, w = rgb.shape[:2]
    scale = size / min(h, w)
    r = resize(rgb, max(size, round(h * scale)), max(size, round(w * scale)))
    y, x = (r.shape[0] - size) // 2, (r.shape[1] - size) // 2
    r = (r[y : y + size, x : x + size] - np.array(MEAN)) / np.array(STD)
    return r.transpose(2, 0, 1).astype(np.float32)


class StubEmbedder:
    """Deterministic stand-in where no weights are there: each patch is the mean
    colour and spread of a cell of the picture, turned by a fixed matrix."""

    def __init__(self, grid: int = 7, dim: int = 16, seed: int = 0):
        self.grid, self.turn = grid, np.random.default_rng(seed).normal(size=(6, dim))

    def __call__(self, tensor: np.ndarray) -> np.ndarray:
        c, h, w = tensor.shape
        cells = tensor[:, : h // self.grid * self.grid, : w // self.grid * self.grid].reshape(c, self.grid, h // self.grid, self.grid, w // self.grid)
        x = np.concatenate([cells.mean(axis=(2, 4)), cells.std(axis=(2, 4))]).reshape(2 * c, -1).T
        return (x @ self.turn).astype(np.float32)


class OnnxEmbedder:
    """First output of an ONNX network; the session is opened where it runs."""

    def __init__(self, path: str):
        self.path, self._session = path, None

    def __getstate__(self):
        return {"path": self.path, "_session": None}

    def session(self):
        if self._session is None:
            import onnxruntime

            self._session = onnxruntime.InferenceSession(self.path, providers=["CPUExecutionProvider"])
        return self._session

    def __call__(self, tensor: np.ndarray) -> np.ndarray:
        session = self.session()
        out = session.run(None, {session.get_inputs()[0].name: tensor[None].astype(np.float32)})[0]
        return np.asarray(out, np.float32).reshape(-1, out.shape[-1])


def embed(images: DataFrame, embedder, preprocess=preprocess_square, id_col: str = "path") -> DataFrame:
    """``id, patch_idx, vec`` of decoded images. A picture that fails has one row
    with a null vector and the error, so that others go on."""
    kind = images.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = []
            for i, h, w, rgb in zip(b[id_col], b["h"], b["w"], b["rgb"], strict=True):
                try:
                    rows += [(i, p, v.tolist(), None) for p, v in enumerate(embedder(preprocess(np.asarray(rgb, float).reshape(h, w, 3))))]
                except Exception as e:  # noqa: BLE001  a row's failure is data here
                    rows.append((i, -1, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(rows, columns=[id_col, "patch_idx", "vec", "error"])

    return images.select(id_col, "h", "w", "rgb").mapInPandas(run, f"{id_col} {kind}, patch_idx int, vec array<float>, error string")


class PyramidStub:
    """Deterministic maps of several levels where no weights are there: each level
    is a grid of other size, its cells as in :class:`StubEmbedder`."""

    def __init__(self, grids: dict[str, int] | None = None, dim: int = 16, seed: int = 0):
        self.levels = {k: StubEmbedder(n, dim, seed + i) for i, (k, n) in enumerate((grids or {"fine": 14, "coarse": 7}).items())}

    def __call__(self, tensor: np.ndarray) -> dict[str, np.ndarray]:
        return {k: e(tensor).reshape(e.grid, e.grid, -1) for k, e in self.levels.items()}


class OnnxPyramid(OnnxEmbedder):
    """Maps of several levels from one pass of an ONNX network: ``levels`` names the
    output of each, channels first."""

    def __init__(self, path: str, levels: dict[str, str]):
        super().__init__(path)
        self.levels = levels

    def __getstate__(self):
        return {"path": self.path, "levels": self.levels, "_session": None}

    def __call__(self, tensor: np.ndarray) -> dict[str, np.ndarray]:
        session = self.session()
        found = session.run(list(self.levels.values()), {session.get_inputs()[0].name: tensor[None].astype(np.float32)})
        return {k: np.moveaxis(np.asarray(m[0], np.float32), 0, -1) for k, m in zip(self.levels, found)}


def embed_levels(images: DataFrame, embedder, preprocess=preprocess_square, id_col: str = "path") -> DataFrame:
    """``id, level, patch_idx, h, w, vec`` of decoded images: the cells of every
    level's map, row by row. A picture that fails has one row with a null level and
    the error."""
    kind = images.schema[id_col].dataType.simpleString()
    columns = [id_col, "level", "patch_idx", "h", "w", "vec", "error"]

    def run(batches):
        for b in batches:
            for i, h, w, rgb in zip(b[id_col], b["h"], b["w"], b["rgb"], strict=True):
                try:
                    maps = embedder(preprocess(np.asarray(rgb, float).reshape(h, w, 3)))
                    rows = [(i, k, p, m.shape[0], m.shape[1], v.tolist(), None) for k, m in maps.items() for p, v in enumerate(m.reshape(-1, m.shape[2]))]
                except Exception as e:  # noqa: BLE001  a row's failure is data here
                    rows = [(i, None, -1, 0, 0, None, f"{type(e).__name__}: {e}"[:200])]
                yield pd.DataFrame(rows, columns=columns)

    return images.select(id_col, "h", "w", "rgb").mapInPandas(run, f"{id_col} {kind}, level string, patch_idx int, h int, w int, vec array<float>, error string")


#: Objects that a task fetches at once.
THREADS = 16


def fetch(rows: DataFrame, get, keys: tuple[str, ...] = ("bucket", "object_key"), threads: int = THREADS) -> DataFrame:
    """``rows`` with ``content`` and ``error``: ``get(*keys)`` is called in the tasks,
    for at most ``threads`` objects of a task at a time, whose bytes are handed on
    before the next are asked for. An object that cannot be fetched is a row with
    its error."""

    def one(args):
        try:
            if any(a is None for a in args):
                raise KeyError("no key")
            return bytes(get(*args)), None
        except Exception as e:  # noqa: BLE001  an object's failure is data here
            return None, f"{type(e).__name__}: {e}"[:200]

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow as pa

        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                for at in range(0, b.num_rows, threads):
                    part = b.slice(at, threads)
                    got = list(pool.map(one, zip(*(part[k].to_pylist() for k in keys))))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())], [*part.schema.names, "content", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, content binary, error string")


def validation_patches(rows: DataFrame, get, open_image, embedder, at: str, preprocess=preprocess_square, id_col: str = "image_id", threads: int = THREADS) -> tuple[DataFrame, DataFrame]:
    """Patches of the objects of ``rows`` (``id, bucket, object_key``) and those that
    could not be had, ``id, error``. An object that cannot be fetched or opened
    (``open_image`` gives rows x columns x 3 in 0..1) is skipped and counted; an
    image that the embedder fails on ends the job. Objects are fetched once: what
    comes of them is a table at ``at``."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for i, content, error in zip(b[id_col], b["content"], b["error"], strict=True):
                if error is None:
                    try:
                        image = np.asarray(open_image(bytes(content)), float)
                    except Exception as e:  # noqa: BLE001  so is one that is no image
                        error = f"{type(e).__name__}: {e}"[:200]
                if error is not None:
                    out.append((i, -1, None, error))
                else:
                    out += [(i, p, v.tolist(), None) for p, v in enumerate(embedder(preprocess(image)))]
            yield pd.DataFrame(out, columns=[id_col, "patch_idx", "vec", "error"])

    fetched = fetch(rows.select(id_col, "bucket", "object_key"), get, threads=threads)
    fetched.mapInPandas(run, f"{id_col} {kind}, patch_idx int, vec array<float>, error string").write.mode("overwrite").parquet(at)
    done = rows.sparkSession.read.parquet(at)
    return done.where("error is null").drop("error"), done.where("error is not null").select(id_col, "error")
