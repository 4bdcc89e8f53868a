"""Clustering benchmark: every metric from one contingency table, noise dropped."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import Tables, indexed
from .neighbours import cross, distances, matrix, pack

NOISE = -1
#: Rows of a piece in the pairwise pass.
PIECE = 4000
#: Rows of distances held at once.
HELD = 256
#: Values of the hypergeometric support in one array.
SUPPORT_PIECE = 65536


def cells(rows: DataFrame, predicted: str = "predicted", truth: str = "truth") -> DataFrame:
    """``p, t, n``: points of each (cluster, class) that occurs, with the
    margins ``a`` and ``b`` and the total ``total``."""
    c = rows.where(F.col(predicted) != NOISE).groupBy(F.col(predicted).alias("p"), F.col(truth).alias("t")).agg(F.count("*").alias("n"))
    a = c.groupBy("p").agg(F.sum("n").alias("a"))
    b = c.groupBy("t").agg(F.sum("n").alias("b"))
    total = c.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    return c.join(a, "p").join(b, "t").withColumn("total", F.lit(total).cast("long"))


def counts(rows: DataFrame, predicted: str = "predicted", truth: str = "truth") -> DataFrame:
    live = F.col(predicted) != NOISE
    return rows.agg(
        F.count("*").alias("n"),
        F.countDistinct(truth).alias("classes"),
        F.countDistinct(F.when(live, F.col(predicted))).alias("clusters"),
        F.count_if(~live).alias("noise"),
        F.round(F.count_if(live) / F.count("*"), 6).alias("coverage"),
    )


def contingency(rows: DataFrame, predicted: str = "predicted", truth: str = "truth") -> DataFrame:
    """Every pair of a found cluster and a class of the whole table, zeros
    included; as many rows as clusters times classes."""
    c = cells(rows, predicted, truth).select("p", "t", "n")
    classes = rows.select(F.col(truth).alias("t")).distinct()
    grid = c.select("p").distinct().withColumn("_", F.lit(1)).join(classes.withColumn("_", F.lit(1)), "_").drop("_")
    return grid.join(c, ["p", "t"], "left").select(F.col("p").alias("cluster"), F.col("t").alias("class"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def main_classes(rows: DataFrame, predicted: str = "predicted", truth: str = "truth") -> DataFrame:
    """Per cluster its size, main class (least class of the largest) and share."""
    top = F.max(F.struct(F.col("n"), (-F.col("t")).alias("neg")))
    c = cells(rows, predicted, truth).groupBy("p").agg(F.sum("n").alias("size"), top.alias("top"))
    return c.select(F.col("p").alias("cluster"), "size", (-F.col("top.neg")).alias("main_class"), F.round(F.col("top.n") / F.col("size"), 2).alias("purity"))


def _pairs(n: Column) -> Column:
    return n * (n - 1) / 2


def pair_metrics(c: DataFrame) -> DataFrame:
    """Adjusted Rand and Fowlkes-Mallows from the cells; a margin's term is
    split over its cells by their share of it."""
    n = F.col("n")
    r = c.agg(
        F.sum(_pairs(n)).alias("s"),
        F.sum(_pairs(F.col("a")) * n / F.col("a")).alias("sa"),
        F.sum(_pairs(F.col("b")) * n / F.col("b")).alias("sb"),
        F.max("total").alias("total"),
    )
    every = _pairs(F.col("total"))
    expected = F.try_divide(F.col("sa") * F.col("sb"), every)
    span = (F.col("sa") + F.col("sb")) / 2 - expected
    ari = F.when(F.coalesce(F.abs(span), F.lit(0.0)) < 1e-12, 1.0).otherwise((F.col("s") - expected) / span)
    fmi = F.when(F.col("s") == 0, 0.0).otherwise(F.col("s") / F.sqrt(F.col("sa") * F.col("sb")))
    return r.select(F.round(ari, 6).alias("ari"), F.round(fmi, 6).alias("fmi"))


def _information(c: DataFrame) -> DataFrame:
    n, a, b, total = (F.col(x).cast("double") for x in ("n", "a", "b", "total"))
    return c.agg(
        F.sum(n / total * F.log(n * total / (a * b))).alias("mi"), (-F.sum(n / total * F.log(a / total))).alias("hp"), (-F.sum(n / total * F.log(b / total))).alias("ht")
    )


def information_metrics(c: DataFrame) -> DataFrame:
    """NMI (arithmetic), homogeneity, completeness, V; no entropy counts as 1."""
    r = _information(c)
    share = lambda x, h: F.when(h < 1e-15, 1.0).otherwise(x / h)
    mi, hp, ht = F.col("mi"), F.col("hp"), F.col("ht")
    homogeneity, completeness = share(mi, ht), share(mi, hp)
    v = F.when(homogeneity + completeness < 1e-15, 0.0).otherwise(2 * homogeneity * completeness / (homogeneity + completeness))
    return r.select(
        F.round(F.when(hp + ht < 1e-15, 1.0).otherwise(2 * mi / (hp + ht)), 6).alias("nmi"),
        F.round(homogeneity, 6).alias("homogeneity"),
        F.round(completeness, 6).alias("completeness"),
        F.round(v, 6).alias("v_measure"),
    )


def ln_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, moved up by ten so that it is exact to
    rounding for every n >= 0; no table of factorials is needed."""
    x = n.cast("double") + 11.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    product = F.lit(0.0)
    for k in range(1, 11):
        product = product + F.log(n.cast("double") + float(k))
    return series - product


def adjusted_mutual_information(c: DataFrame) -> DataFrame:
    """AMI (arithmetic): expected mutual information summed over the support of
    the hypergeometric law of each pair of margins."""
    margins = c.groupBy().agg(F.collect_set(F.struct("p", "a")).alias("ps"), F.collect_set(F.struct("t", "b")).alias("ts"), F.max("total").alias("total"))
    pairs = margins.select(F.explode("ps").alias("p"), "ts", "total").select("p", F.explode("ts").alias("t"), "total").select(F.col("p.a").alias("a"), F.col("t.b").alias("b"), "total")
    first, last = F.greatest(F.lit(1), F.col("a") + F.col("b") - F.col("total")), F.least("a", "b")
    # In pieces, so that no array grows with the table and tasks share a wide margin.
    pieces = pairs.where(first <= last).select("a", "b", "total", last.alias("last"), F.explode(F.sequence(first, last, F.lit(SUPPORT_PIECE).cast("long"))).alias("k0")).repartition("a", "b", "k0")
    law = pieces.select("a", "b", "total", F.explode(F.sequence("k0", F.least(F.col("k0") + SUPPORT_PIECE - 1, "last"))).alias("k"))
    a, b, n, k = (F.col(x) for x in ("a", "b", "total", "k"))
    f = ln_factorial
    weight = F.exp(f(a) + f(b) + f(n - a) + f(n - b) - f(n) - f(k) - f(a - k) - f(b - k) - f(n - a - b + k))
    # Products of counts as doubles: they exceed a long for large tables.
    term = k / n * F.log(n.cast("double") * k / (a.cast("double") * b)) * weight
    expected = law.agg(F.sum(term).alias("emi"))
    r = _information(c).withColumn("_", F.lit(1)).join(expected.withColumn("_", F.lit(1)), "_")
    half = (F.col("hp") + F.col("ht")) / 2
    return r.select(F.round(F.when(F.abs(half - F.col("emi")) < 1e-15, 1.0).otherwise((F.col("mi") - F.col("emi")) / (half - F.col("emi"))), 6).alias("ami"))


def purity(c: DataFrame) -> DataFrame:
    per = c.groupBy("p").agg(F.max("n").alias("n"), F.first("total").alias("total"))
    return per.agg(F.round(F.sum("n") / F.max("total"), 6).alias("purity"))


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost matching of rows to columns (shortest augmenting paths)."""
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for row in range(1, n + 1):
        match[0] = row
        col, least, used, back = 0, np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while match[col]:
            used[col] = True
            r = match[col]
            free = ~used
            free[0] = False
            at = np.flatnonzero(free)
            cur = c[r - 1, at - 1] - u[r] - v[at]
            better = cur < least[at]
            least[at[better]], back[at[better]] = cur[better], col
            nxt = at[np.argmin(least[at])]
            step = least[nxt]
            u[match[used]] += step
            v[used] -= step
            least[free] -= step
            col = nxt
        while col:
            match[col], col = match[back[col]], back[col]
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return [(j, i) for i, j in pairs] if turned else pairs


def hungarian_accuracy(c: DataFrame) -> float:
    """Share of points under the best one-to-one matching of clusters and
    classes. Only the contingency table (clusters x classes) is gathered."""
    got = c.select("p", "t", "n").toPandas()
    if not len(got):
        return float("nan")
    m = got.pivot_table(index="p", columns="t", values="n", fill_value=0).to_numpy(float)
    return float(sum(m[i, j] for i, j in assignment(-m)) / m.sum())


def cluster_sizes(rows: DataFrame, predicted: str = "predicted") -> DataFrame:
    return rows.groupBy(F.col(predicted).alias("cluster")).agg(F.count("*").alias("size"))


class _Sums:
    """Sums of the distances from each row of a task's blocks to the clusters of the
    other blocks. Rows are cut into blocks in the order of their clusters; of clusters
    that a task meets whole only the least mean leaves it, of others the sums."""

    def __init__(self) -> None:
        self.held: dict[int, _Block] = {}

    def block(self, name: int, t: pa.Table) -> _Block:
        if name not in self.held:
            idx, c, n = (t[k].to_numpy().copy() for k in ("idx", "c", "n"))
            first = np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1])
            self.held[name] = _Block(idx, c, n, first, np.diff(np.append(first, len(c))), np.full(len(c), np.inf), np.zeros(len(c)), {})
        return self.held[name]

    def add(self, p: int, x: pa.Table, q: int, y: pa.Table) -> None:
        one, other, at, to = self.block(p, x), self.block(q, y), matrix(x["vec"]), matrix(y["vec"])
        across = np.zeros((len(one.first), len(to)))
        for s in range(0, len(at), HELD):
            d = distances(at[s : s + HELD], to)
            if p == q:
                # A point's distance to itself is exactly nothing.
                d[np.arange(len(d)), np.arange(s, s + len(d))] = 0.0
            one.note(slice(s, s + HELD), other, np.add.reduceat(d, other.first, axis=1).T)
            if p != q:
                c = one.c[s : s + HELD]
                first = np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1])
                across[np.searchsorted(one.c[one.first], c[first])] += np.add.reduceat(d, first, axis=0)
        one.met(other)
        if p != q:
            for s in range(0, len(to), HELD):
                other.note(slice(s, s + HELD), one, across[:, s : s + HELD])
            other.met(one)

    def out(self):
        for b in self.held.values():
            rows = [(b.idx, b.c, b.c, b.own, b.n, np.where(np.isfinite(b.near), b.near, np.nan))]
            for k, (size, _, sums) in b.partial.items():
                some = b.c != k
                m = int(some.sum())
                rows.append((b.idx[some], b.c[some], np.full(m, k), sums[some], np.full(m, size), np.full(m, np.nan)))
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type, from_pandas=f.name == "near") for v, f in zip(row, _SUMS)], schema=_SUMS)


@dataclass
class _Block:
    """Rows in the order of their clusters, ``first`` and ``count`` of each cluster
    here (``n`` in all); by row the least mean, the sum to its own cluster and those
    to clusters of which only some members were met."""

    idx: np.ndarray
    c: np.ndarray
    n: np.ndarray
    first: np.ndarray
    count: np.ndarray
    near: np.ndarray
    own: np.ndarray
    partial: dict[int, list]

    def note(self, part: slice, other: _Block, sums: np.ndarray) -> None:
        """``sums`` of the rows of ``part`` by cluster of the other block."""
        kinds, sizes, whole = other.c[other.first], other.n[other.first], other.count == other.n[other.first]
        same = kinds[:, None] == self.c[part]
        self.own[part] += np.where(same, sums, 0.0).sum(axis=0)
        if whole.any():
            mean = np.where(same[whole], np.inf, sums[whole] / sizes[whole, None])
            self.near[part] = np.minimum(self.near[part], mean.min(axis=0))
        for k in np.flatnonzero(~whole):
            self.partial.setdefault(int(kinds[k]), [int(sizes[k]), 0, np.zeros(len(self.c))])[2][part] += sums[k]

    def met(self, other: _Block) -> None:
        """All rows have met the other block: clusters that are whole now."""
        for k, m in zip(other.c[other.first].tolist(), other.count.tolist()):
            if k in self.partial:
                found = self.partial[k]
                found[1] += m
                if found[1] == found[0]:
                    self.near = np.minimum(self.near, np.where(self.c == k, np.inf, found[2] / found[0]))
                    del self.partial[k]


_SUMS = pa.schema([("idx", pa.int64()), ("c", pa.int64()), ("other", pa.int64()), ("s", pa.float64()), ("n", pa.int64()), ("near", pa.float64())])


def silhouette(rows: DataFrame, id_col: str, cluster: str, vec: str) -> DataFrame:
    """``id, silhouette`` (Euclidean) of every point that is not noise; points
    alone in their cluster, and points without a vector, have 0. Every two blocks of
    rows meet once (:func:`.neighbours.cross`), and nothing is copied for it."""
    tables = Tables(rows.sparkSession, "silhouette")
    live = rows.where(F.col(cluster) != NOISE).select(F.col(id_col).alias("id"), F.col(cluster).cast("long").alias("c"), F.col(vec).cast("array<double>").alias("vec"))
    points = tables.save(indexed(live.orderBy("c", F.col("vec").isNull(), "id"), tables), "points")
    sizes = points.groupBy("c").agg(F.count("*").alias("n"))
    placed = points.where("vec is not null").join(sizes, "c").select("idx", "c", "n", "vec", F.floor(F.col("idx") / PIECE).alias("block"))
    ordered = placed.repartition("block").sortWithinPartitions("block", "idx")
    met = cross(pack(ordered, tables), F.col("block_l") <= F.col("block_r"), _Sums, "idx long, c long, other long, s double, n long, near double")
    per = met.groupBy("idx", "c", "other").agg(F.sum("s").alias("s"), F.max("n").alias("n"), F.min("near").alias("near"))
    own = F.max(F.when(F.col("c") == F.col("other"), F.when(F.col("n") > 1, F.col("s") / (F.col("n") - 1))))
    near = F.least(F.min(F.when(F.col("c") != F.col("other"), F.col("s") / F.col("n"))), F.min("near"))
    r = points.select("idx", "id").join(per.groupBy("idx").agg(own.alias("a"), near.alias("b")), "idx", "left")
    return r.select(F.col("id").alias(id_col), F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)).alias("silhouette"))


def centroid_metrics(rows: DataFrame, cluster: str, vec: str) -> DataFrame:
    """Davies-Bouldin and Calinski-Harabasz of the points that are not noise."""
    live = rows.where(F.col(cluster) != NOISE).select(F.col(cluster).alias("c"), F.col(vec).cast("array<double>").alias("v"))
    long = live.select("c", F.posexplode("v").alias("i", "x"))
    per = long.groupBy("c", "i").agg(F.avg("x").alias("m"), F.count("*").alias("n"))
    centre = per.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p"), F.max("n").alias("n")).select("c", "n", F.col("p.m").alias("m"))
    distance = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    spread = live.join(centre, "c").groupBy("c").agg(F.avg(distance(F.col("v"), F.col("m"))).alias("s"), F.sum(F.pow(distance(F.col("v"), F.col("m")), 2)).alias("w"))
    k = centre.join(spread, "c")
    # Centroids are as few as clusters: their pairs are clusters squared.
    a, b = k.withColumn("_", F.lit(1)).alias("a"), k.withColumn("_", F.lit(1)).alias("b")
    worst = (
        a.join(b, "_").where("a.c <> b.c").select(F.col("a.c").alias("c"), F.try_divide(F.col("a.s") + F.col("b.s"), distance(F.col("a.m"), F.col("b.m"))).alias("r"))
        .groupBy("c").agg(F.max("r").alias("r")).agg(F.avg("r").alias("db"))
    )
    mean = long.groupBy("i").agg(F.avg("x").alias("g"))
    between = per.join(mean, "i").agg(F.sum(F.col("n") * F.pow(F.col("m") - F.col("g"), 2)).alias("b"))
    within = k.agg(F.sum("w").alias("w"), F.count("*").alias("k"), F.sum("n").alias("n"))
    one = lambda d: d.withColumn("_", F.lit(1))
    r = one(worst).join(one(between), "_").join(one(within), "_")
    ch = F.try_divide(F.col("b") * (F.col("n") - F.col("k")), F.col("w") * (F.col("k") - 1))
    return r.select(F.round("db", 6).alias("davies_bouldin"), F.round(ch, 6).alias("calinski_harabasz"))
