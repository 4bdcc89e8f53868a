"""Shared pieces of the large-corpus operators: intermediate tables in the
cluster's shared folder, table readers, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import shared_dir

#: Words everywhere in this subpackage: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front until none is among the columns."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


class Workspace:
    """Intermediate tables as Parquet below the shared folder.

    A written table cuts the lineage, outlives the loss of any executor and
    needs no second computation of what stands before it.  Tables that nothing
    reads any more are dropped with :meth:`drop`; :meth:`clear` drops all but
    the ones named.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/inspectra/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, tuple[DataFrame, str]] = {}
        self._n = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        self._n += 1
        path = self.path(f"{name}-{self._n}")
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            found = self._paths.pop(id(t), None)
            if found:
                self._delete(found[1])
        free_shuffles(self.spark)

    def clear(self, *keep: DataFrame) -> None:
        kept = {id(t) for t in keep}
        for key in [k for k in self._paths if k not in kept]:
            self._delete(self._paths.pop(key)[1])


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs; it acts when
    the driver collects its garbage, which a large idle heap never does."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def batches_of(records, schema, rows: int = 20000):
    """Record batches of bounded size from column lists gathered elsewhere."""
    import pyarrow as pa

    full = pa.Table.from_pydict(records, schema=schema)
    yield from full.to_batches(max_chunksize=rows)


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and two folds of their hashes: whether a round changed
    anything is told by one pass, without comparing the tables row by row."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.bit_xor(F.xxhash64("b", h))).first())


def components(spark: SparkSession, ws: Workspace, edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``.

    Returns ``(id, component)``, the smallest id reachable, for every id that
    an edge touches.  Alternating large-star and small-star steps: a node's
    larger neighbours (then its smaller ones) are linked to its least
    neighbour, which keeps the number of edges linear and halves the depth of
    trees each time.  A node with many neighbours is met by a partial
    aggregate and a join, never gathered in one list.  Empty edges give an
    empty result; loops and repeated edges are harmless.
    """
    e = ws.save(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    mark = _fingerprint(e)
    for _ in range(rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a node hang on its least one.
        large = (
            e.select(F.col("b").alias("k"), F.col("a").alias("v"))
            .join(least.withColumnRenamed("a", "k"), "k")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        # Small star: the node and its smaller neighbours hang on the least.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        nxt = ws.save(small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        ws.drop(e)
        e, before, mark = nxt, mark, _fingerprint(nxt)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not converge")
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
