"""Points in blocks, and nearest neighbours within and between blocks.

Points go to the nearest of at most ``MOST_PIVOTS`` pivots; a pivot's points are
dealt to blocks of about ``ROWS``, so a dense spot (or a third of all points in one
place) is many blocks. A block's rows are packed into one row, and pairs of blocks
are a nested-loop join of these: tasks read the packed blocks again, so nothing is
copied or shuffled for a pair, and a task sums up what its pairs give (:func:`cross`).
Pairs of pivots whose points are too far apart to matter, by the triangle
inequality, do not meet. :func:`nearest_k` is exact, and where points lie too close
for that inequality its time grows with the square of their number; its disk does
not. :func:`forest_k` is linear instead: neighbours within the blocks of several
dealings by other pivots, most of them the true ones.

The driver holds the pivots, and one number for each pair of them; both are
bounded by ``MOST_PIVOTS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import Tables

#: Points of a block (about), pivots at most.
ROWS, MOST_PIVOTS = 1500, 1024
#: Bytes of a file of packed blocks (about), files at least; rows of distances worked
#: on at once.
FILE, FILES, STRIP = 16 << 20, 8, 64
_POINTS = pa.schema([("idx", pa.int64()), ("vec", pa.list_(pa.float64())), ("pivot", pa.int32()), ("apart", pa.float64())])


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.asarray(column.flatten(), float).reshape(n, -1) if n else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, those of close points from their differences; to 40
    bits, so that a distance is the same wherever it is worked out."""
    size_a, size_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    out = a @ b.T
    for s in range(0, len(a), STRIP):
        square = out[s : s + STRIP]
        size = size_a[s : s + STRIP, None] + size_b
        square *= -2
        square += size
        np.maximum(square, 0, out=square)
        size *= 1e-7
        i, j = np.nonzero(square <= size)
        for t in range(0, len(i), 100_000):
            x, y = i[t : t + 100_000], j[t : t + 100_000]
            square[x, y] = ((a[s + x] - b[y]) ** 2).sum(axis=1)
        np.sqrt(square, out=square)
        bits = square.view(np.int64)
        bits += 1 << 12
        bits >>= 13
        bits <<= 13
    return out


@dataclass
class Blocks:
    """``rows``: idx, vec, pivot, block, read from the table ``dealt``; by pivot its
    place and point, the greatest distance of its points, its number of blocks and of
    the first of them."""

    rows: DataFrame
    dealt: DataFrame
    centres: np.ndarray
    points: np.ndarray
    radius: np.ndarray
    pieces: np.ndarray
    count: int

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.pieces)])[:-1]

    def gaps(self) -> np.ndarray:
        """What the points of two pivots are apart at least."""
        d = distances(self.centres, self.centres) - self.radius[:, None] - self.radius
        d = np.maximum(d - 1e-9 * (1 + np.abs(d)), 0)
        np.fill_diagonal(d, 0)
        return d


def blocks(points: DataFrame, tables: Tables, rows: int = ROWS, most_pivots: int = MOST_PIVOTS, seed: int = 0) -> Blocks:
    """Blocks of ``points(idx, vec)``; pivots are points of least hash."""
    count = points.count()
    n_pivots = min(most_pivots, max(1, -(-count // rows)))
    chosen = points.orderBy(F.xxhash64("idx", F.lit(seed)), "idx").limit(n_pivots).select("idx", "vec").collect()
    centres = np.array([r.vec for r in chosen], float) if chosen else np.zeros((0, 0))
    shared = points.sparkSession.sparkContext.broadcast(centres)

    def deal(batches):
        for b in batches:
            if b.num_rows:
                d = distances(matrix(b["vec"]), shared.value)
                at = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b["idx"], b["vec"], pa.array(at, pa.int32()), pa.array(d[np.arange(len(at)), at])], schema=_POINTS)

    dealt = tables.save(points.select("idx", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(deal, "idx long, vec array<double>, pivot int, apart double"), "dealt")
    pieces, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect():
        pieces[r.pivot], radius[r.pivot] = -(-r.n // rows), r.r
    out = Blocks(dealt, dealt, centres, np.array([r.idx for r in chosen], np.int64), radius, pieces, count)
    spread = points.sparkSession.createDataFrame(pd.DataFrame({"pivot": np.arange(len(centres), dtype=np.int32), "pieces": pieces, "first": out.first}), "pivot int, pieces long, first long")
    out.rows = dealt.join(F.broadcast(spread), "pivot").select("idx", "vec", "pivot", (F.col("first") + F.pmod(F.xxhash64("idx"), F.col("pieces"))).alias("block"))
    return out


def pack(rows: DataFrame, tables: Tables, *keep: str) -> DataFrame:
    """``block``, the ``keep`` columns (one value in a block) and ``held``: the rows
    of each block as Arrow bytes, saved in the order of the blocks."""

    def run(t: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema) as w:
            w.write_table(t.combine_chunks())
        return t.select(["block", *keep]).slice(0, 1).append_column("held", pa.array([sink.getvalue().to_pybytes()], pa.binary()))

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in ("block", *keep))
    packed = tables.save(rows.groupBy("block").applyInArrow(run, kinds + "held binary"), "packed")
    n, size = packed.agg(F.count("*"), F.coalesce(F.sum(F.length("held")), F.lit(0))).first()
    out = tables.save(packed.orderBy("block"), "blocks", maxRecordsPerFile=max(1, -(-n // max(FILES, size // FILE))))
    tables.drop(packed)
    return out


def cross(packs: DataFrame, where: Column, fold, schema: str) -> DataFrame:
    """Every two packed blocks for which ``where`` holds (of columns ``name_l`` and
    ``name_r``) go to ``add(block, its table, other block, its table)`` of a task's
    ``fold()``, whose ``out()`` yields batches in the end. The join's sides are read
    from their files by every task: no shuffle, and no more on the disk."""
    left, right = (packs.select(*(F.col(c).alias(f"{c}_{side}") for c in packs.columns)) for side in "lr")
    pairs = left.hint("shuffle_replicate_nl").join(right, where).select("block_l", "held_l", "block_r", "held_r")

    def run(batches):
        f, name, mine = fold(), None, None
        for b in batches:
            for l, held_l, r, held_r in zip(*(b.column(i) for i in range(4))):
                if l.as_py() != name:
                    name, mine = l.as_py(), pa.ipc.open_stream(pa.BufferReader(held_l.as_buffer().to_pybytes())).read_all()
                f.add(name, mine, r.as_py(), pa.ipc.open_stream(held_r.as_buffer()).read_all())
        yield from f.out()

    return pairs.mapInArrow(run, schema)


def needed(b: Blocks, packs: DataFrame, need: np.ndarray) -> tuple[DataFrame, Column]:
    """Packed blocks with the pivots that theirs needs (a symmetric matrix), and the
    condition of :func:`cross`. A block does not meet itself."""
    less = F.col("block_l") < F.col("block_r")
    live = np.flatnonzero(b.pieces > 0)
    if need[np.ix_(live, live)].all():
        return packs, less
    wants = packs.sparkSession.createDataFrame([(int(p), np.flatnonzero(need[p]).tolist()) for p in live], "pivot int, wants array<int>")
    return packs.join(F.broadcast(wants), "pivot"), less & F.array_contains("wants_l", F.col("pivot_r"))


_NEAR = pa.list_(pa.struct([("d", pa.float64()), ("j", pa.int64())]))


def _lists(d: np.ndarray, names: np.ndarray, k: int, below: np.ndarray) -> pa.Array:
    """The k least entries of each row under its bound, as lists of (d, j)."""
    k = min(k, d.shape[1])
    at = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.tile(np.arange(k), (len(d), 1))
    near = np.take_along_axis(d, at, axis=1)
    good = near < below[:, None]
    flat = pa.StructArray.from_arrays([pa.array(near[good]), pa.array(names[at][good])], ["d", "j"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(good.sum(axis=1))]).astype(np.int32)), flat)


def nearest_k(b: Blocks, k: int, tables: Tables) -> DataFrame:
    """``idx, near``: the k nearest other points (fewer if there are not so many),
    as (d, j) by distance, then j. Exact: a block's own neighbours bound the
    distance to which a point has to look elsewhere."""

    def own(t: pa.Table) -> pa.Table:
        x, idx = matrix(t["vec"]), t["idx"].to_numpy()
        d = distances(x, x)
        np.fill_diagonal(d, np.inf)
        near = _lists(d, idx, k, np.full(len(d), np.inf))
        far = np.sort(np.partition(d, k - 1, axis=1)[:, k - 1 : k], axis=1)[:, 0] if k <= len(d) else np.full(len(d), np.inf)
        return pa.table({"idx": t["idx"], "vec": t["vec"], "pivot": t["pivot"], "block": t["block"], "near": near, "far": pa.array(far)})

    fields = "idx long, vec array<double>, pivot int, block long"
    first = tables.save(b.rows.groupBy("block").applyInArrow(own, f"{fields}, near array<struct<d: double, j: long>>, far double"), "own")
    far = np.zeros(len(b.centres))
    for r in first.groupBy("pivot").agg(F.max("far").alias("far")).collect():
        far[r.pivot] = r.far
    need = b.gaps() < np.maximum(far[:, None], far)

    packs = pack(first.select("idx", "vec", "pivot", "block", "far"), tables, "pivot")
    found = tables.save(cross(*needed(b, packs, need), lambda: _Nearest(k), "idx long, near array<struct<d: double, j: long>>"), "found")
    tables.drop(packs)
    every = first.select("idx", "near").unionByName(found)
    return every.groupBy("idx").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


class _Nearest:
    """The k nearest points that a task's blocks find in one another, under the
    bounds that the rows carry as ``far``."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, p: int, x: pa.Table, q: int, y: pa.Table) -> None:
        d = distances(matrix(x["vec"]), matrix(y["vec"]))
        for name, t, o, e in ((p, x, y, d), (q, y, x, d.T)):
            if name not in self.held:
                n = t.num_rows
                self.held[name] = t["idx"].to_numpy().copy(), t["far"].to_numpy().copy(), np.full((n, self.k), np.inf), np.full((n, self.k), -1)
            _, far, near, who = self.held[name]
            some = np.flatnonzero(e.min(axis=1) < far)
            if not len(some):
                continue
            e, m = e[some], min(self.k, e.shape[1])
            at = np.argpartition(e, m - 1, axis=1)[:, :m]
            found = np.take_along_axis(e, at, axis=1)
            found[found >= far[some, None]] = np.inf
            more, names = np.hstack([near[some], found]), np.hstack([who[some], o["idx"].to_numpy()[at]])
            order = np.argsort(more, axis=1, kind="stable")[:, : self.k]
            near[some], who[some] = np.take_along_axis(more, order, axis=1), np.take_along_axis(names, order, axis=1)
            far[some] = np.minimum(far[some], near[some, -1])

    def out(self):
        for idx, _, near, who in self.held.values():
            good = np.isfinite(near)
            some = good.any(axis=1)
            flat = pa.StructArray.from_arrays([pa.array(near[good]), pa.array(who[good])], ["d", "j"])
            ends = np.concatenate([[0], np.cumsum(good[some].sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(idx[some], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)], ["idx", "near"])


#: Dealings of a forest.
TREES = 8


def forest_k(points: DataFrame, k: int, tables: Tables, trees: int = TREES, rows: int = ROWS) -> DataFrame:
    """``idx, near`` as :func:`nearest_k`, of ``points(idx, vec)``: the nearest points
    that share a block in any of ``trees`` dealings. A table of one block is exact."""

    def own(t: pa.Table) -> pa.Table:
        x, idx = matrix(t["vec"]), t["idx"].to_numpy()
        d = distances(x, x)
        np.fill_diagonal(d, np.inf)
        return pa.table({"idx": t["idx"], "near": _lists(d, idx, k, np.full(len(d), np.inf))})

    every = None
    for seed in range(trees):
        b = blocks(points, tables, rows, seed=seed)
        one = tables.save(b.rows.select("idx", "vec", "block").groupBy("block").applyInArrow(own, "idx long, near array<struct<d: double, j: long>>"), "tree")
        tables.drop(b.dealt)
        every = one if every is None else every.unionByName(one)
        if b.pieces.sum() <= 1:
            break
    near = F.array_distinct(F.array_sort(F.flatten(F.collect_list("near"))))
    return every.groupBy("idx").agg(F.slice(near, 1, k).alias("near"))
