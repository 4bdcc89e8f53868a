"""Scaling, joining and reducing descriptor blocks; the second clustering layer."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Block weights, reductions, and the second layer's gates.
WEIGHT_DEEP, WEIGHT_COLOR, WEIGHT_SHAPE = 1.0, 0.3, 0.3
PCA_VARIANCE, KPCA_COMPONENTS = 0.95, 20
SPLIT_GAP, MIN_SUB, BALANCE = 0.25, 4, 0.30


def block_prep(rows: DataFrame, id_col: str, vec: str, weight: float) -> DataFrame:
    """``id, channel, value``: channels standardised by their population spread
    (a constant channel by 1), times weight over the root of their number."""
    long = rows.select(id_col, F.size(vec).alias("_d"), F.posexplode(F.col(vec).cast("array<double>")).alias("channel", "x"))
    stats = long.groupBy("channel").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    sd = F.when(F.col("sd") > 1e-15, F.col("sd")).otherwise(1.0)
    return long.join(stats, "channel").select(id_col, "channel", ((F.col("x") - F.col("mu")) / sd * weight / F.sqrt("_d")).alias("value"))


def concat_blocks(blocks: list[DataFrame], id_col: str, unit: bool = False) -> DataFrame:
    """``id, vec``: the blocks' channels one after the other; unit rows if asked."""
    every = None
    for i, b in enumerate(blocks):
        b = b.select(id_col, F.lit(i).alias("block"), "channel", "value")
        every = b if every is None else every.unionAll(b)
    out = every.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("block", "channel", "value"))).alias("p")).select(id_col, F.col("p.value").alias("vec"))
    if unit:
        from .vectors import l2_normalise

        out = out.withColumn("vec", l2_normalise(F.col("vec"), 1e-12))
    return out


def _signed(v: np.ndarray) -> np.ndarray:
    """Columns turned so that their entry of largest size is positive."""
    if not v.size:
        return v
    at = np.abs(v).argmax(axis=0)
    return v * np.sign(v[at, np.arange(v.shape[1])])


def _moments(rows: DataFrame, vec: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, sum of their vectors and of their outer products (channels x
    channels). Tasks sum their rows, as few as can run at once; only the sums meet,
    channel by channel, and only their total is gathered."""
    n, d = rows.agg(F.count(vec), F.coalesce(F.max(F.size(vec)), F.lit(0))).first()

    def sums(batches):
        total, outer, count = np.zeros(d), np.zeros((d, d)), 0
        for b in batches:
            if len(b):
                x = np.stack([np.asarray(v, float) for v in b[vec]])
                total, outer, count = total + x.sum(axis=0), outer + x.T @ x, count + len(x)
        for i in range(d if count else 0):
            yield pd.DataFrame({"i": [i], "s": [total[i]], "o": [outer[i].tolist()]})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": part["i"].iloc[:1], "s": [part["s"].sum()], "o": [np.sum(np.stack(part["o"]), axis=0).tolist()]})

    kind = "i int, s double, o array<double>"
    few = rows.select(vec).where(F.col(vec).isNotNull()).coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))
    merged = few.mapInPandas(sums, kind).groupBy("i").applyInPandas(add, kind).toPandas()
    total, outer = np.zeros(d), np.zeros((d, d))
    if len(merged):
        total[merged["i"]], outer[merged["i"]] = merged["s"], np.stack(merged["o"])
    return n, total, outer


def _components(n: int, total: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, variances and components, greatest first."""
    mean = total / max(n, 1)
    value, vector = np.linalg.eigh(outer / max(n, 1) - np.outer(mean, mean))
    return mean, np.maximum(value[::-1], 0), _signed(vector[:, ::-1])


def kernel_pca(rows: DataFrame, id_col: str, vec: str, k: int = KPCA_COMPONENTS) -> DataFrame:
    """``id, vec``: the k leading components of the centred cosine kernel, scaled by
    their spread. That kernel is the linear one of the unit rows, so its components
    are the centred unit rows on the eigenvectors of their covariance (channels x
    channels): exact for any number of rows, none of which leaves its task. Zero
    vectors stay zero; components turn so that their largest loading is positive."""
    from .vectors import l2_normalise

    unit = rows.select(id_col, l2_normalise(F.col(vec), 1e-12).alias("vec"))
    n, total, outer = _moments(unit, "vec")
    mean, _, parts = _components(n, total, outer)
    return project(unit, id_col, "vec", mean, parts[:, : min(k, n)])


def fit_pca(rows: DataFrame, vec: str, variance: float = PCA_VARIANCE) -> tuple[np.ndarray, np.ndarray]:
    """Mean and components (channels x k) that hold the share of variance."""
    mean, value, parts = _components(*_moments(rows, vec))
    share = np.cumsum(value) / max(value.sum(), 1e-300)
    return mean, parts[:, : int(np.searchsorted(share, variance) + 1)]


def project(rows: DataFrame, id_col: str, vec: str, mean: np.ndarray, parts: np.ndarray) -> DataFrame:
    """Centred rows on the components; the model is small and broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast((mean, parts))

    def run(batches):
        m, p = shared.value
        for b in batches:
            if len(b):
                yield pd.DataFrame({id_col: b[id_col], "vec": list(map(list, (np.stack([np.asarray(v, float) for v in b[vec]]) - m) @ p))})

    return rows.select(id_col, vec).mapInPandas(run, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, vec array<double>")


def split_1d(rows: DataFrame, group: str, value: str, id_col: str) -> DataFrame:
    """Best two-means split of one column within each group: the cut of sorted
    values with the least sum of squares (first such cut). Adds ``high``, and
    the halves' sizes and means. Groups of one value have no high half."""
    w = Window.partitionBy(group).orderBy(value, id_col)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group)
    x = F.col(value).cast("double")
    r = rows.withColumn("_i", F.row_number().over(w)).withColumn("_s", F.sum(x).over(upto)).withColumn("_q", F.sum(x * x).over(upto))
    r = r.withColumn("_n", F.count("*").over(whole)).withColumn("_ts", F.sum(x).over(whole)).withColumn("_tq", F.sum(x * x).over(whole)).withColumn("_next", F.lead(x).over(w))
    rest = F.col("_n") - F.col("_i")
    sse = F.col("_q") - F.col("_s") * F.col("_s") / F.col("_i") + F.when(rest > 0, (F.col("_tq") - F.col("_q")) - F.pow(F.col("_ts") - F.col("_s"), 2) / rest).otherwise(0.0)
    r = r.withColumn("_sse", F.when(F.col("_next") > x, F.round(sse, 9)))
    best = r.where("_sse is not null").groupBy(group).agg(F.min(F.struct("_sse", "_i")).alias("_b")).select(group, F.col("_b._i").alias("_cut"))
    r = r.join(best, group, "left").withColumn("high", F.coalesce(F.col("_i") > F.col("_cut"), F.lit(False)))
    return r.select(
        *rows.columns,
        "high",
        F.sum(F.when(~F.col("high"), 1).otherwise(0)).over(whole).alias("n_low"),
        F.sum(F.when(F.col("high"), 1).otherwise(0)).over(whole).alias("n_high"),
        F.avg(F.when(~F.col("high"), x)).over(whole).alias("mean_low"),
        F.avg(F.when(F.col("high"), x)).over(whole).alias("mean_high"),
    )


def refine(rows: DataFrame, id_col: str = "item_id", cluster: str = "cluster", ecc: str = "ecc", color: str | None = "color_mag") -> DataFrame:
    """Second layer: the group whose eccentricity splits best gives its smaller
    half a new id (halves of one size: the higher one moves).  With ``color``,
    groups whose mean exceeds the median of the groups' means stay."""
    live = rows.where(F.col(cluster) != -1)
    halves = split_1d(live.select(id_col, cluster, ecc), cluster, ecc, id_col)
    per = halves.groupBy(cluster).agg(F.count("*").alias("n"), F.first("n_low").alias("n_low"), F.first("n_high").alias("n_high"), F.first("mean_low").alias("ml"), F.first("mean_high").alias("mh"))
    minor = F.least("n_low", "n_high")
    gate = (F.col("n") >= 2 * MIN_SUB) & (F.col("mh") - F.col("ml") >= SPLIT_GAP) & (minor >= F.greatest(F.lit(float(MIN_SUB)), BALANCE * F.col("n")))
    if color:
        mags = live.groupBy(cluster).agg(F.avg(color).alias("mag"))
        median = float(mags.agg(F.percentile("mag", 0.5)).first()[0] or 0.0)
        per = per.join(mags, cluster)
        gate = gate & (F.col("mag") <= median)
    # At most one group is chosen: its id and which half moves.
    chosen = per.where(gate).orderBy(minor.desc(), F.col(cluster)).limit(1).select(F.col(cluster), (F.col("n_high") <= F.col("n_low")).alias("up")).collect()
    if not chosen:
        return rows.withColumn("refined", F.col(cluster))
    k, up = chosen[0]
    new = rows.agg(F.max(cluster)).first()[0] + 1
    moved = halves.where((F.col(cluster) == k) & (F.col("high") == F.lit(up))).select(id_col, F.lit(True).alias("_moved"))
    return rows.join(moved, id_col, "left").withColumn("refined", F.when(F.col("_moved"), F.lit(new)).otherwise(F.col(cluster))).drop("_moved")
