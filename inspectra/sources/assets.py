"""Versioned model assets: memory banks and decision bands."""

from __future__ import annotations

import io
import os
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """Configuration with defaults, from the environment."""

    kafka_servers: str = "localhost:9092"
    topic: str = "events"
    group: str = "inspectra"
    images: str = "images"
    models: str = "models"
    model_type: str = "patchcore"
    recent_good: int = 200
    poll_seconds: float = 5.0
    once: bool = False

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "INSPECTRA_", required: tuple[str, ...] = ()) -> Settings:
        """Names are upper-cased; truth is one of 1, true, yes, on."""
        env = dict(os.environ) if env is None else env
        lacking = [r for r in required if not env.get(prefix + r.upper())]
        if lacking:
            raise ValueError(f"settings are missing: {', '.join(lacking)}")
        out = {}
        for name, default in ((f, getattr(cls, f)) for f in cls.__dataclass_fields__):
            raw = env.get(prefix + name.upper())
            if raw is not None:
                out[name] = raw.strip().lower() in {"1", "true", "yes", "on"} if isinstance(default, bool) else type(default)(raw)
        return cls(**out)


def asset_path(root: str, model_type: str, version: str, name: str) -> str:
    return f"{root.rstrip('/')}/{model_type}/{version}/{name}"


def copy_assets(spark: SparkSession, root: str, model_type: str, source: str, target: str, names: Iterable[str], replace: bool = False) -> list[str]:
    """Give a version the assets that it takes over from another one unchanged,
    and tell which were copied. The file system streams the bytes. If the source
    lacks one, FileNotFoundError comes before anything is copied; an asset that
    the target has already stays, unless ``replace``. A copy gets its name only when it
    is whole."""
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    names, conf = list(names), spark._jsc.hadoopConfiguration()
    pairs = [(n, at(asset_path(root, model_type, source, n)), asset_path(root, model_type, target, n)) for n in names]
    lacking = [n for n, src, _ in pairs if not src.getFileSystem(conf).exists(src)]
    if lacking:
        raise FileNotFoundError(f"{model_type} {source} lacks {', '.join(lacking)}")
    done = []
    for n, src, dst in pairs:
        fs, part = at(dst).getFileSystem(conf), at(dst + ".part")
        if fs.exists(at(dst)) and not replace:
            continue
        fs.delete(part, True)
        fs.mkdirs(at(dst).getParent())
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(src.getFileSystem(conf), src, fs, part, False, True, conf)
        if replace:
            fs.delete(at(dst), True)
        if not fs.rename(part, at(dst)):
            raise OSError(f"{dst} cannot be named")
        done.append(n)
    return done


def fetch_assets(spark: SparkSession, root: str, model_type: str, version: str, names: Iterable[str]) -> dict[str, str]:
    """Ship a version's files to every executor, and give the name
    by which ``SparkFiles.get`` finds each in a task. Spark keeps one file of a name,
    so a session fetches one version of it. A missing file raises FileNotFoundError before any is shipped."""
    conf, paths = spark._jsc.hadoopConfiguration(), {n: asset_path(root, model_type, version, n) for n in names}
    for n, p in paths.items():
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        if not at.getFileSystem(conf).exists(at):
            raise FileNotFoundError(f"{model_type} {version} lacks {n}")
    for p in paths.values():
        spark.sparkContext.addFile(p)
    return {n: n.rsplit("/", 1)[-1] for n in paths}


def write_bank(bank: DataFrame, root: str, model_type: str, version: str, mode: str = "errorifexists") -> None:
    bank.write.mode(mode).parquet(asset_path(root, model_type, version, "memory_bank"))


def read_bank(spark: SparkSession, root: str, model_type: str, version: str) -> DataFrame:
    return spark.read.parquet(asset_path(root, model_type, version, "memory_bank"))


def import_npy(spark: SparkSession, path: str) -> DataFrame:
    """``row_id, vec`` from a float matrix in .npy form, wherever Spark reads."""
    content = spark.read.format("binaryFile").load(path).select("content").first()
    if content is None:
        raise FileNotFoundError(path)
    a = np.load(io.BytesIO(content[0])).astype(np.float32)
    return spark.createDataFrame(((i, r.tolist()) for i, r in enumerate(a)), "row_id long, vec array<float>")


def export_npy(bank: DataFrame) -> bytes:
    """A bank as .npy bytes, rows in order of row_id."""
    rows = bank.orderBy("row_id").select("vec").toPandas()["vec"]
    out = io.BytesIO()
    np.save(out, np.array([np.asarray(r, np.float32) for r in rows], np.float32))
    return out.getvalue()


def parse_band(lines: DataFrame) -> DataFrame:
    """One row ``lower, upper`` from text lines ``value`` (and ``line`` for their
    order): blank lines and lines without ``=`` are skipped, the first ``=``
    splits, the last of repeated names counts."""
    parts = F.regexp_extract("value", r"^\s*([^=]*?)\s*=\s*(.*?)\s*$", 1).alias("k"), F.regexp_extract("value", r"^\s*([^=]*?)\s*=\s*(.*?)\s*$", 2).alias("v")
    kv = lines.where(F.instr("value", "=") > 0).select("line", *parts)
    last = lambda name: F.max_by(F.col("v").cast("double"), F.when(F.col("k") == name, F.col("line")))
    return kv.agg(last("lower").alias("lower"), last("upper").alias("upper"))


def read_band(spark: SparkSession, root: str, model_type: str, version: str) -> tuple[float, float]:
    """Bounds of a version; a missing bound raises KeyError."""
    text = spark.read.option("wholetext", True).text(asset_path(root, model_type, version, "buffer_zone.txt"))
    lines = text.select(F.posexplode(F.split("value", "\n")).alias("line", "value"))
    row = parse_band(lines).first()
    for name in ("lower", "upper"):
        if row[name] is None:
            raise KeyError(name)
    return row["lower"], row["upper"]


def write_band(spark: SparkSession, root: str, model_type: str, version: str, lower: float, upper: float, mode: str = "errorifexists") -> None:
    spark.createDataFrame([(f"lower={lower!r}\nupper={upper!r}",)], "value string").coalesce(1).write.mode(mode).text(asset_path(root, model_type, version, "buffer_zone.txt"))
