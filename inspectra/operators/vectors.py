"""Nearest-neighbour scoring against a memory bank, coresets and calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A bank of at most so many bytes is sent whole to every task; a larger one is
#: cut into pieces that meet the patches in a shuffle.
BROADCAST_BYTES = 64 << 20
#: Rows of a bank piece and of a patch piece in that shuffle.
BANK_PIECE, PATCH_PIECE = 20_000, 50_000
#: One of so many patches of an image goes into the bank.
CORESET_DIVISOR = 98


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vec), F.lit(0.0), lambda a, x: a + x * x))


def l2_normalise(vec: Column, epsilon: float | None = None) -> Column:
    """Unit vectors; a zero vector gives NaN, or zeros with an ``epsilon``."""
    n = norm(vec)
    if epsilon is not None:
        n = F.greatest(n, F.lit(epsilon))
    return F.transform(as_double(vec), lambda x: F.when(n == 0, F.lit(float("nan"))).otherwise(F.try_divide(x, n)))


def _distances(x: np.ndarray, bank: np.ndarray, metric: str, k: int) -> np.ndarray:
    """Distance of rows of x to the bank: least Euclidean (squared), or the k
    greatest cosines, by blocks of bounded size."""
    out = np.empty((len(x), 1 if metric == "l2" else k))
    step = max(1, (8 << 20) // max(1, len(bank)))
    if metric == "l2":
        square = (bank**2).sum(axis=1)
        for i in range(0, len(x), step):
            a = x[i : i + step]
            # The expansion picks the neighbour, the difference measures it.
            at = np.argmin(square - 2 * (a @ bank.T), axis=1)
            out[i : i + step, 0] = ((a - bank[at]) ** 2).sum(axis=1)
        return out
    for i in range(0, len(x), step):
        s = x[i : i + step] @ bank.T
        out[i : i + step] = -np.sort(np.partition(-s, k - 1, axis=1)[:, :k], axis=1) if k < s.shape[1] else -np.sort(-s, axis=1)
    return out


def _unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _stack(values) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in values])


def _bank_bytes(bank: DataFrame) -> tuple[int, int]:
    r = bank.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("d")).first()
    return r.n, r.n * r.d * 8


def nearest(patches: DataFrame, bank: DataFrame, keys: list[str], metric: str = "l2", k: int = 1, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keys`` and ``distance`` of every patch (columns ``keys`` and ``vec``).

    ``l2``: distance to the nearest bank row (``vec``).  ``cosine``: 1 minus the
    mean of the k greatest cosines, k being cut to the bank's size.  Null
    vectors have a null distance; an empty bank gives null distances.
    """
    n, size = _bank_bytes(bank)
    live = patches.where("vec is not null").select(*keys, "vec")
    fields = ", ".join(f"`{c}` {patches.schema[c].dataType.simpleString()}" for c in keys)
    k = min(k, n)
    prepare = _unit_rows if metric == "cosine" else (lambda x: x)
    if n == 0:
        return patches.select(*keys, F.lit(None).cast("double").alias("distance"))
    finish = (lambda d: np.sqrt(d[:, 0])) if metric == "l2" else (lambda d: 1 - d.mean(axis=1))
    if size <= broadcast_bytes:
        shared = patches.sparkSession.sparkContext.broadcast(prepare(_stack(bank.select("vec").toPandas()["vec"])))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield b[keys].assign(distance=finish(_distances(prepare(_stack(b["vec"])), shared.value, metric, k)))

        found = live.mapInPandas(run, f"{fields}, distance double")
    else:
        found = _nearest_in_pieces(live, bank, keys, fields, metric, k, n, prepare)
    return found.unionByName(patches.where("vec is null").select(*keys, F.lit(None).cast("double").alias("distance")))


def _nearest_in_pieces(live: DataFrame, bank: DataFrame, keys: list[str], fields: str, metric: str, k: int, n: int, prepare) -> DataFrame:
    """Every bank piece meets every patch piece once; best values are merged."""
    pieces = -(-n // BANK_PIECE)
    parts = max(1, -(-live.count() // PATCH_PIECE))
    key = F.xxhash64(*keys)
    left = live.withColumn("_part", F.pmod(key, F.lit(parts))).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    right = bank.select("vec", F.pmod(F.xxhash64("vec"), F.lit(pieces)).cast("int").alias("_piece")).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=[*keys, "best"])
        found = _distances(prepare(_stack(a["vec"])), prepare(_stack(b["vec"])), metric, min(k, len(b)))
        return a[keys].assign(best=list(found))

    met = left.groupBy("_piece", "_part").cogroup(right.groupBy("_piece", "_part")).applyInPandas(meet, f"{fields}, best array<double>")
    best = met.groupBy(*keys).agg(F.flatten(F.collect_list("best")).alias("best"))
    if metric == "l2":
        return best.select(*keys, F.sqrt(F.array_min("best")).alias("distance"))
    top = F.slice(F.sort_array("best", asc=False), 1, k)
    return best.select(*keys, (1 - F.aggregate(top, F.lit(0.0), lambda a, x: a + x) / F.size(top)).alias("distance"))


def image_scores(distances: DataFrame, image: str = "image_id") -> DataFrame:
    """An image's score: the greatest distance of its patches."""
    return distances.groupBy(image).agg(F.max("distance").alias("anomaly_score"))


def coreset(patches: DataFrame, rank: Column, image: str = "image_id", divisor: int = CORESET_DIVISOR) -> DataFrame:
    """``max(1, n // divisor)`` patches of each image, those of least rank."""
    ordered = Window.partitionBy(image).orderBy(rank)
    whole = Window.partitionBy(image)
    return (
        patches.withColumn("_rn", F.row_number().over(ordered))
        .withColumn("_n", F.count("*").over(whole))
        .where(F.col("_rn") <= F.greatest(F.lit(1), F.floor(F.col("_n") / divisor)))
        .drop("_rn", "_n")
    )


def capped_bank(patches: DataFrame, cap: int, level: str = "level", seed: int = 42) -> DataFrame:
    """Normalised bank of at most ``cap`` rows a level, chosen by seeded hash.
    The threshold rank is a top-k per level, not a sort of the level."""
    from pyspark.sql.functions import xxhash64

    unit = patches.withColumn("vec", l2_normalise(F.col("vec"), 1e-12)).withColumn("_r", xxhash64(F.lit(seed), *[c for c in patches.columns if c != "vec"]))
    return unit.withColumn("_rn", F.row_number().over(Window.partitionBy(level).orderBy("_r"))).where(F.col("_rn") <= cap).drop("_r", "_rn")


def append_bank(bank: DataFrame, new: DataFrame) -> DataFrame:
    return bank.unionByName(new)


def calibrate(scores: DataFrame, previous: tuple[float, float], at: tuple[float, float] = (0.75, 0.99), score: str = "anomaly_score") -> DataFrame:
    """One row ``lower, upper``: exact percentiles by linear interpolation, the
    previous bounds where there is no score."""
    p = F.percentile(score, F.array(*(F.lit(x) for x in at)))
    return scores.agg(p.alias("p")).select(*(F.coalesce(F.col("p")[i], F.lit(float(previous[i]))).alias(n) for i, n in enumerate(("lower", "upper"))))
