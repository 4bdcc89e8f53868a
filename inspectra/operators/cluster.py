"""Density clustering (HDBSCAN), prediction for new points, and UMAP.

:func:`hdbscan` and :func:`umap` take any number of rows (:mod:`.density`,
:mod:`.layout`); :func:`fit_hdbscan` fits points held in memory by the same
definition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import density, layout
from .neighbours import distances

#: Rows of distances held at once.
BLOCK = 256


def _core(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([np.partition(distances(x[s : s + BLOCK], x), k, axis=1)[:, k] for s in range(0, len(x), BLOCK)])


@dataclass
class Hdbscan:
    """A fitted model: points, core distances, labels, strengths and, for each
    cluster, the greatest density at which a point of it left."""

    points: np.ndarray
    core: np.ndarray
    labels: np.ndarray
    probabilities: np.ndarray
    max_lambda: dict[int, float]
    min_samples: int

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and strength of new points: those of the nearest fitted point by
        mutual reachability; noise if that point is noise or too far away."""
        labels, strength = np.full(len(x), -1), np.zeros(len(x))
        k = min(self.min_samples, len(self.points))
        births = np.array([self.births[c] for c in sorted(self.births)] + [np.inf])
        most = np.array([self.max_lambda[c] for c in sorted(self.births)] + [1.0])
        for s in range(0, len(x), BLOCK):
            d = distances(x[s : s + BLOCK], self.points)
            own = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
            reach = np.maximum(np.maximum(d, self.core), own)
            least = reach.min(axis=1)
            at = np.where(reach == least[:, None], d, np.inf).argmin(axis=1)
            lam = np.minimum(np.divide(1, least, out=np.full(len(d), np.inf), where=least > 0), density.MOST_LAMBDA)
            c = self.labels[at]
            good = (c >= 0) & (lam > births[c])
            labels[s : s + BLOCK] = np.where(good, c, -1)
            strength[s : s + BLOCK] = np.where(good, np.where(most[c] >= density.MOST_LAMBDA, 1.0, np.minimum(lam, most[c]) / most[c]), 0.0)
        return labels, strength

    births: dict[int, float] | None = None


def _tree(x: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of a spanning tree by mutual reachability; Prim's algorithm, which
    needs one row of distances at a time."""
    n = len(x)
    inside, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    at, edges = 0, []
    for _ in range(n - 1):
        inside[at] = True
        d = np.maximum(np.maximum(distances(x[at : at + 1], x)[0], core[at]), core)
        closer = ~inside & (d < best)
        best[closer], link[closer] = d[closer], at
        at = int(np.argmin(np.where(inside, np.inf, best)))
        edges.append((int(link[at]), at, best[at]))
    a, b, w = zip(*edges)
    return np.array(a), np.array(b), np.array(w)


def fit_hdbscan(x: np.ndarray, min_cluster_size: int = 3, min_samples: int | None = None) -> Hdbscan:
    """A model of points held in memory (a layout, a test); :func:`hdbscan` fits any
    number of rows. Clusters by excess of mass, the root is never one; steps of one
    length are one step; clusters are numbered by their first point."""
    n = len(x)
    k = min_samples or min_cluster_size
    if n < 2:
        return Hdbscan(x, np.zeros(n), np.full(n, -1), np.zeros(n), {}, k, {})
    core = _core(x, min(k, n - 1))
    found = density.Merger([], min_cluster_size, n).run(*_tree(x, core))
    clusters = {c: (parent, birth, chosen) for kind, c, parent, _, birth, _, chosen, _ in found if kind == "cluster"}
    top = {}
    for c in clusters:
        way, best = c, None
        while way in clusters:
            best = way if clusters[way][2] else best
            way = clusters[way][0]
        top[c] = best
    members = {}
    for kind, p, c, _, lam, *_ in found:
        if kind == "point" and top.get(c) is not None:
            members.setdefault(top[c], []).append((p, lam))
    labels, strength, max_lambda, birth = np.full(n, -1), np.zeros(n), {}, {}
    for name, c in enumerate(sorted(members, key=lambda c: min(members[c]))):
        most = max_lambda[name] = max(lam for _, lam in members[c])
        birth[name] = clusters[c][1]
        for p, lam in members[c]:
            labels[p], strength[p] = name, 1.0 if most >= density.MOST_LAMBDA else lam / most
    return Hdbscan(x, core, labels, strength, max_lambda, k, birth)


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in values])


def hdbscan(rows: DataFrame, id_col: str, vec: str, min_cluster_size: int = 3) -> DataFrame:
    """``id, cluster, probability`` of all rows together (-1 is noise)."""
    return density.fit(rows, id_col, vec, min_cluster_size).select(id_col, "cluster", "probability")


def assign(rows: DataFrame, model: Hdbscan, id_col: str, vec: str) -> DataFrame:
    """Label and strength of new rows under a model held in memory, in parallel
    (:func:`density.assign` takes a fitted table). A model without prediction data
    is refused."""
    if model.births is None or not len(model.points):
        raise ValueError("the model holds no prediction data")
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            if len(b):
                labels, p = shared.value.predict(_matrix(b[vec]))
                yield pd.DataFrame({id_col: b[id_col], "cluster_id": labels, "probability": p})

    return rows.select(id_col, vec).mapInPandas(run, f"{id_col} {kind}, cluster_id int, probability double")


def umap(rows: DataFrame, id_col: str, vec: str, neighbours: int = 15, dims: int = 2, seed: int = 42) -> DataFrame:
    """``id, vec``: the layout of all rows together."""
    return layout.fit(rows, id_col, vec, neighbours, dims, seed).select(id_col, F.col("y").alias("vec"))
