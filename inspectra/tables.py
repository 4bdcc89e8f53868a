"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the session's
    checkpoint folder. Only a session on one machine (``local``, tests) may do
    without: it takes a temporary folder. Elsewhere that would lose rows."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir")
    if not base:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set, and the executors share no other folder")
        base = "file://" + tempfile.mkdtemp(prefix="inspectra-")
        sc.setCheckpointDir(base)
    return base


class Tables:
    """Tables as Parquet below the shared folder: writing one cuts the lineage, and
    it outlives the loss of any executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/inspectra/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def save(self, df: DataFrame, name: str, **options) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{name}-{self._n}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def drop(self, table: DataFrame) -> None:
        """Delete a saved table that nothing reads any more."""
        _, path = self._paths.pop(id(table))
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def indexed(df: DataFrame, tables: Tables, name: str = "idx") -> DataFrame:
    """The rows with a number from 0 without gaps, in the order of their
    partitions; only the partitions' sizes reach the driver."""
    marked = tables.save(df.withColumn("_m", F.monotonically_increasing_id()), "marked")
    part = F.shiftright("_m", 33)
    sizes = marked.groupBy(part.alias("p")).count().orderBy("p").collect()
    ahead, total = [], 0
    for r in sizes:
        ahead.append((r.p, total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(ahead or [(0, 0)], "_p long, _o long")
    return marked.join(F.broadcast(offsets), part == F.col("_p")).withColumn(name, F.col("_o") + F.col("_m") - F.shiftleft(part, 33)).drop("_m", "_p", "_o")
