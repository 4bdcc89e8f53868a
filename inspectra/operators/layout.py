"""UMAP layouts of any number of rows (McInnes and Healy 2018, cosine distance,
min_dist 0).

The neighbour graph comes from a forest (:func:`.neighbours.forest_k`) on unit
vectors, in time that is linear in their number. The layout
starts from principal components and moves in rounds: vertices are dealt to parts,
a part gets its edges with the places of their far ends, moves its own vertices
for some epochs (far ends in the part move along, others stay until the next
round), and writes their places. Repulsion comes from about ``NEGATIVES`` vertices a
round, drawn by hash. Layouts of other implementations differ
in detail; neighbours and groups are what to compare.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import Tables, indexed
from .fusion import fit_pca, project
from .neighbours import ROWS, distances, forest_k, matrix
from .vectors import l2_normalise

#: The curve of min_dist 0, spread 1; repulsion against attraction.
A, B, REPULSION = 1.9328, 0.7905, 5.0
#: Rounds and epochs of a round; vertices of a part (about).
ROUNDS, EPOCHS, PART = 10, 20, 4_000
#: Vertices that repel in a round (about), and how many of them do in an epoch: the
#: same for all vertices of a part, so that neighbours are pushed alike.
NEGATIVES, DRAWS = 1024, 64
#: Rows of a piece of new rows and of a piece of points that meet; new rows whose
#: distances are held at once.
NEW_PIECE, POINT_PIECE, HELD = 5_000, 5_000, 256


def graph(near: DataFrame, k: int) -> DataFrame:
    """Fuzzy neighbour graph ``a, b, w`` (each edge both ways) of ``idx, near``:
    weights fall from 1 at the nearest point so that they sum to log2 k, and both
    directions are joined as a + b - a b."""

    def weigh(batches):
        for b in batches:
            lists = b["near"]
            if not b.num_rows:
                continue
            n = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten()
            d, j = np.asarray(flat.field(0)) ** 2 / 2, np.asarray(flat.field(1))
            row = np.repeat(np.arange(len(n)), n)
            rho = np.full(len(n), np.inf)
            np.minimum.at(rho, row, d)
            gap = d - rho[row]
            lo, hi = np.zeros(len(n)), np.full(len(n), 1e3)
            for _ in range(64):
                mid = (lo + hi) / 2
                s = np.bincount(row, np.exp(-gap / np.maximum(mid, 1e-12)[row]), len(n))
                big = s > np.log2(max(k, 2))
                hi, lo = np.where(big, mid, hi), np.where(big, lo, mid)
            w = np.exp(-gap / np.maximum((lo + hi) / 2, 1e-12)[row])
            yield pa.RecordBatch.from_pydict({"a": np.asarray(b["idx"])[row], "b": j, "w": w})

    one = near.mapInArrow(weigh, "a long, b long, w double")
    both = one.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("s"), F.min("w").alias("x"), F.max("w").alias("y"), F.count("*").alias("n"))
    both = both.select("a", "b", F.when(F.col("n") == 2, F.col("s") - F.col("x") * F.col("y")).otherwise(F.col("s")).alias("w"))
    return both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def _lists(y: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))


def _moved(y: np.ndarray, head: np.ndarray, w: np.ndarray, tail: np.ndarray, inside: np.ndarray, still: np.ndarray, away: np.ndarray, first: int, epochs: int) -> np.ndarray:
    """Places of a part's vertices after some epochs. ``tail`` is a place in the
    part where ``inside``, else the far end stays at ``still``."""
    n, rng = len(y), np.random.default_rng(first)
    pull_on = np.bincount(head, w, n)
    for e in range(first, first + epochs):
        far = still.copy()
        far[inside] = y[tail[inside]]
        diff = y[head] - far
        q = np.maximum((diff**2).sum(axis=1), 1e-12)
        pull = np.clip((-2 * A * B * q ** (B - 1) / (1 + A * q**B))[:, None] * diff, -4, 4) * w[:, None]
        step = np.stack([np.bincount(head, pull[:, c], n) for c in range(y.shape[1])], axis=1)
        gap = y[:, None] - away[rng.permutation(len(away))[:DRAWS]]
        q = (gap**2).sum(axis=2)
        push = np.clip((2 * B / ((0.001 + q) * (1 + A * q**B)))[:, :, None] * gap, -4, 4).mean(axis=1)
        step += REPULSION * pull_on[:, None] * push
        y = y + (1 - e / (ROUNDS * EPOCHS)) * np.clip(step, -4, 4) * 0.25
    return y


def _start(points: DataFrame, dims: int, seed: int) -> DataFrame:
    """Principal components, the largest value at 10, and a little noise by hash."""
    mean, parts = fit_pca(points, "vec", 1.0)
    parts = np.pad(parts[:, :dims], ((0, 0), (0, max(0, dims - parts.shape[1]))))
    y = project(points, "idx", "vec", mean, parts)
    most = y.select(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0] or 0.0
    noise = lambda i: F.pmod(F.xxhash64("idx", F.lit(seed), i), F.lit(2001)) / 1e7 - 1e-4
    return y.select("idx", F.transform("vec", lambda x, i: x * (10 / max(most, 1e-12)) + noise(i)).alias("y"))


def fit(rows: DataFrame, id_col: str, vec: str, neighbours: int = 15, dims: int = 2, seed: int = 42, part: int = PART, block_rows: int = ROWS) -> DataFrame:
    """``id, vec, y``: unit vectors and their layout. Null vectors are left out."""
    tables = Tables(rows.sparkSession, "layout")
    unit = rows.select(F.col(id_col).alias("id"), l2_normalise(F.col(vec), 1e-12).alias("vec")).where("vec is not null").orderBy("id")
    points = tables.save(indexed(unit, tables), "points")
    count = points.count()
    k = min(neighbours, count - 1)
    if k < 2:
        return points.select(F.col("id").alias(id_col), "vec", F.array_repeat(F.lit(0.0), dims).alias("y"))
    n_parts = -(-count // part)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(n_parts))
    edges = tables.save(graph(forest_k(points, k, tables, rows=block_rows), k), "edges")
    y = tables.save(_start(points, dims, seed), "places")
    every = max(1, count // NEGATIVES)
    for r in range(ROUNDS):
        drawn = y.where(F.pmod(F.xxhash64("idx", F.lit(seed + r)), F.lit(every)) == 0).orderBy(F.xxhash64("idx", F.lit(r))).limit(2 * NEGATIVES)
        first = r * EPOCHS
        away = y.sparkSession.sparkContext.broadcast(np.array([x.y for x in drawn.select("y").collect()], float).reshape(-1, dims))

        def move(t: pa.Table, own: pa.Table) -> pa.Table:
            idx, at = own["idx"].to_numpy(), matrix(own["y"])
            order = np.argsort(idx)
            idx, at = idx[order], at[order]
            if t.num_rows and len(away.value):  # noqa: B023
                head, tail = np.searchsorted(idx, t["a"].to_numpy()), t["b"].to_numpy()
                slot = np.minimum(np.searchsorted(idx, tail), len(idx) - 1)
                at = _moved(at, head, t["w"].to_numpy(), slot, idx[slot] == tail, matrix(t["far"]), away.value, first, EPOCHS)  # noqa: B023
            return pa.table({"idx": pa.array(idx), "y": _lists(at)})

        far = y.select(F.col("idx").alias("b"), F.col("y").alias("far"))
        ends = edges.join(far, "b").select(place("a").alias("part"), "a", "b", "w", "far")
        own = y.select(place("idx").alias("part"), F.col("idx").alias("idx"), F.col("y").alias("y"))
        y = tables.save(ends.groupBy("part").cogroup(own.groupBy("part")).applyInArrow(move, "idx long, y array<double>"), "places")
    return tables.save(points.join(y, "idx").select(F.col("id").alias(id_col), "vec", "y"), "fitted")


def _meet(new: DataFrame, points: DataFrame, k: int, new_piece: int, point_piece: int) -> DataFrame:
    """``idx, near`` of ``new(idx, vec)``: the k nearest points as (d, y), from
    pieces of either side that meet."""
    n_new, n_points = max(1, -(-new.count() // new_piece)), max(1, -(-points.count() // point_piece))
    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = new.withColumn("p", F.pmod("idx", F.lit(n_new)).cast("int")).withColumn("q", deal(n_points))
    right = points.select("vec", "y", F.pmod(F.xxhash64("vec"), F.lit(n_points)).cast("int").alias("q")).withColumn("p", deal(n_new))

    kind = pa.struct([("d", pa.float64()), ("y", pa.list_(pa.float64()))])
    schema = pa.schema([("idx", pa.int64()), ("near", pa.list_(kind))])

    def part(x: pa.Table, at_z: np.ndarray, y: np.ndarray) -> pa.Table:
        d = distances(matrix(x["vec"]), at_z)
        m = min(k, d.shape[1])
        at = np.argpartition(d, m - 1, axis=1)[:, :m]
        flat = pa.StructArray.from_arrays([pa.array(np.take_along_axis(d, at, axis=1).ravel()), _lists(y[at].reshape(-1, y.shape[1]))], fields=list(kind))
        return pa.table({"idx": x["idx"], "near": pa.ListArray.from_arrays(pa.array(np.arange(0, m * len(d) + 1, m), pa.int32()), flat)}, schema=schema)

    def run(x: pa.Table, z: pa.Table) -> pa.Table:
        if not x.num_rows or not z.num_rows:
            return schema.empty_table()
        at, y = matrix(z["vec"]), matrix(z["y"])
        return pa.concat_tables([part(x.slice(s, HELD), at, y) for s in range(0, x.num_rows, HELD)])

    met = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInArrow(run, "idx long, near array<struct<d: double, y: array<double>>>")
    return met.groupBy("idx").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def transform(rows: DataFrame, fitted: DataFrame, id_col: str, vec: str, neighbours: int = 15, new_piece: int = NEW_PIECE, point_piece: int = POINT_PIECE) -> DataFrame:
    """``id, y`` of new rows: the mean of their neighbours' places, weighted by how
    much farther than the nearest they are. Null vectors, and those that are not
    finite, have no place."""
    tables = Tables(rows.sparkSession, "transform")
    finite = lambda v: F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    unit = rows.select(F.col(id_col).alias("id"), l2_normalise(F.col(vec), 1e-12).alias("vec"))
    new = tables.save(indexed(unit, tables), "new")
    found = _meet(new.where(F.col("vec").isNotNull() & finite(F.col("vec"))).select("idx", "vec"), fitted, neighbours, new_piece, point_piece)
    cosine = F.transform("near", lambda s: s["d"] * s["d"] / 2)
    found = found.withColumn("c", cosine).withColumn("spread", F.greatest(F.aggregate("c", F.lit(0.0), lambda a, x: a + x) / F.size("c") - F.get("c", F.lit(0)), F.lit(1e-9)))
    found = found.withColumn("w", F.transform("c", lambda x: F.exp(-(x - F.get("c", F.lit(0))) / F.col("spread"))))

    def mean(c: Column) -> Column:
        part = lambda s, w: F.get(s["y"], c) * w
        return F.aggregate(F.zip_with("near", "w", part), F.lit(0.0), lambda a, x: a + x) / F.aggregate("w", F.lit(0.0), lambda a, x: a + x)

    places = found.select("idx", F.transform(F.sequence(F.lit(0), F.size(F.get("near", F.lit(0))["y"]) - 1), mean).alias("y"))
    return new.select("id", "idx").join(places, "idx", "left").select(F.col("id").alias(id_col), "y")
