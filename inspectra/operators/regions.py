"""Defect masks as relational work: connected regions over run-length rows.

A task smooths and cuts its own maps; what is left of an image are the pixels of
its closed mask, at most a few in a hundred. From there on masks are rows:

1. Pixels that follow each other in a line are one run (gaps and islands).
2. Runs of neighbouring lines that touch by side or corner are linked, and the
   least run spreads along the links, with jumps over what is known already, until
   nothing changes. A run's number is the place of its first pixel.
3. A region's size, box and second moments are sums over its runs in closed form;
   its convex hull needs the ends of its lines only.
4. Per image the region with the highest point of the smoothed map is kept, else
   the largest one, of equals the one that starts first.

Shuffles are by image, or by image and line or run, so no key holds more than one
map's runs; each round is a written table. Rows of maps are told apart by a number of their own, so ids may
repeat or be null; an empty table gives an empty result. Maps without a value fail.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..tables import Tables
from .descriptors import BACKGROUND_PERCENTILE, SHAPE_DEFAULT, closing, cut_map, hull_pixels

COLOR = ("red", "green", "blue", "brightness", "spread")
SHAPE = ("area", "eccentricity", "solidity", "extent", "aspect")
#: Pixels that a region needs for a colour, for a shape; calm ones for a background.
COLOR_PIXELS, SHAPE_PIXELS, CALM_PIXELS = 3, 4, 10

_PIXEL = "struct<y: long, x: long, r: double, g: double, b: double>"
_SUMS = "struct<n: long, r: double, g: double, b: double, spread: double>"


def _sums(rgb: np.ndarray, at: np.ndarray) -> dict:
    p = rgb[at]
    r, g, b = p.sum(axis=0)
    return {"n": len(p), "r": r, "g": g, "b": b, "spread": np.ptp(p, axis=1).sum()}


def masks(maps: DataFrame, image: str, height: str, width: str, values: str, pixels: str | None) -> DataFrame:
    """Per map its id, size, the place of the smoothed map's peak, the ``spots`` of
    its closed mask, and colour sums over the calm, the hottest and all pixels."""
    kind = maps.schema[image].dataType.simpleString()

    def run(batches):
        for frame in batches:
            rows = []
            for r in frame.itertuples(index=False):
                a = np.asarray(r.v, float).reshape(int(r.h), int(r.w))
                rgb = np.asarray(r.p, float).reshape(*a.shape, 3) if pixels else np.repeat(a[:, :, None], 3, axis=2)
                smooth, hot = cut_map(a)
                half, top = np.percentile(smooth, (BACKGROUND_PERCENTILE, 99))
                closed = np.argwhere(closing(hot))
                spots = [{"y": y, "x": x, "r": rgb[y, x, 0], "g": rgb[y, x, 1], "b": rgb[y, x, 2]} for y, x in closed.tolist()]
                rows.append((r.i, int(r.h), int(r.w), int(smooth.argmax()), spots, _sums(rgb, smooth <= half), _sums(rgb, smooth >= top), _sums(rgb, smooth == smooth)))
            yield pd.DataFrame(rows, columns=["id", "h", "w", "peak", "spots", "calm", "top", "whole"])

    cols = [F.col(image).alias("i"), F.col(height).alias("h"), F.col(width).alias("w"), F.col(values).alias("v"), *([F.col(pixels).alias("p")] if pixels else [])]
    return maps.select(*cols).mapInPandas(run, f"id {kind}, h long, w long, peak long, spots array<{_PIXEL}>, calm {_SUMS}, top {_SUMS}, whole {_SUMS}").withColumn("key", F.monotonically_increasing_id())


def runs(masked: DataFrame) -> DataFrame:
    """Runs of pixels: ``key, y, x0, x1``, the place ``run`` of the first pixel,
    whether the peak lies in it, and colour sums."""
    px = masked.select("key", "w", "peak", F.inline("spots"))
    spread = F.greatest("r", "g", "b") - F.least("r", "g", "b")
    island = F.col("x") - F.row_number().over(Window.partitionBy("key", "y").orderBy("x"))
    out = px.withColumn("island", island).groupBy("key", "w", "peak", "y", "island").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), *(F.sum(c).alias(c) for c in "rgb"), F.sum(spread).alias("spread")
    )
    place = F.col("y") * F.col("w")
    return out.select("key", "y", "x0", "x1", (place + F.col("x0")).alias("run"), F.col("peak").between(place + F.col("x0"), place + F.col("x1")).alias("peak"), "r", "g", "b", "spread")


def touching(r: DataFrame) -> DataFrame:
    """``key, run, other`` of runs that touch by side or corner, both ways."""
    a, b = r.select("key", "y", "x0", "x1", "run").alias("a"), r.select("key", "y", "x0", "x1", "run").alias("b")
    near = (F.col("a.x0") <= F.col("b.x1") + 1) & (F.col("b.x0") <= F.col("a.x1") + 1)
    down = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.y") + 1 == F.col("b.y")) & near)
    pairs = F.array(F.struct(F.col("a.run").alias("run"), F.col("b.run").alias("other")), F.struct(F.col("b.run").alias("run"), F.col("a.run").alias("other")))
    return down.select(F.col("a.key").alias("key"), F.inline(pairs))


def label(r: DataFrame, tables: Tables) -> DataFrame:
    """``key, run, region``: the least run that can be reached."""
    links = tables.save(touching(r), "links")
    now = tables.save(r.select("key", "run", F.col("run").alias("region")), "regions")
    while True:
        seen = links.join(now.withColumnRenamed("run", "other"), ["key", "other"]).groupBy("key", "run").agg(F.min("region").alias("least"))
        low = now.join(seen, ["key", "run"], "left").withColumn("next", F.least("region", "least"))
        # What the run that is named knows, one step further along.
        far = low.select("key", F.col("run").alias("next"), F.col("next").alias("jump"))
        nxt = tables.save(low.join(far, ["key", "next"]).select("key", "run", F.least("next", "jump").alias("region"), (F.least("next", "jump") != F.col("region")).alias("changed")), "regions")
        changed = not nxt.where("changed").isEmpty()
        tables.drop(now)
        now = nxt.drop("changed") if not changed else nxt
        if not changed:
            return now


def _squares(k: Column) -> Column:
    """Sum of the squares from 1 to k."""
    return k * (k + 1) * (2 * k + 1) / 6


def measure(r: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per region: pixels, box, moments, colour sums, and the ends of its lines."""
    n, x0, x1, y = F.col("x1") - F.col("x0") + 1, F.col("x0"), F.col("x1"), F.col("y")
    sx = (x0 + x1) * n / 2
    lines = r.join(labelled, ["key", "run"]).groupBy("key", "region", "y").agg(
        F.max("peak").alias("peak"), F.sum(n).alias("n"), F.min(x0).alias("x0"), F.max(x1).alias("x1"), F.sum(sx).alias("sx"), F.sum(_squares(x1) - _squares(x0 - 1)).alias("sxx"),
        *(F.sum(c).alias(c) for c in ("r", "g", "b", "spread")),
    )
    return lines.groupBy("key", "region").agg(
        F.max("peak").alias("peak"), F.sum("n").alias("n"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1"),
        F.sum("sx").alias("sx"), F.sum("sxx").alias("sxx"), F.sum(y * F.col("n")).alias("sy"), F.sum(y * y * F.col("n")).alias("syy"), F.sum(y * F.col("sx")).alias("sxy"),
        *(F.sum(c).alias(c) for c in ("r", "g", "b", "spread")), F.collect_list(F.struct("y", "x0", "x1")).alias("lines"),
    )


@F.pandas_udf(DoubleType())
def _hull(lines: pd.Series) -> pd.Series:
    """Pixels in the hull of a region, from the ends of its lines."""
    ends = lambda a: np.array([(p["y"], p[e]) for p in a for e in ("x0", "x1")])
    return pd.Series([hull_pixels(ends(a)) for a in lines], dtype=float)


def _shape() -> list[Column]:
    """The shape columns of a region; pixels are unit squares, each adds 1/12."""
    n = F.col("n")
    var = lambda ss, a, b: (n * F.col(ss) - F.col(a) * F.col(b)) / (n * n)
    xx, yy, xy = var("sxx", "sx", "sx") + 1 / 12, var("syy", "sy", "sy") + 1 / 12, var("sxy", "sx", "sy")
    half, root = (xx + yy) / 2, F.sqrt(F.pow((xx - yy) / 2, 2) + xy * xy)
    tall, wide = F.col("y1") - F.col("y0") + 1, F.col("x1") - F.col("x0") + 1
    found = (
        n / (F.col("h") * F.col("w")),
        F.sqrt(F.greatest(F.lit(0.0), 1 - (half - root) / (half + root))),
        n / F.greatest("hull", F.lit(1.0)),
        n / (tall * wide),
        F.greatest(tall, wide) / (F.least(tall, wide) + 1e-6),
    )
    return [F.when(n >= SHAPE_PIXELS, c).otherwise(F.lit(d)).alias(name) for name, c, d in zip(SHAPE, found, SHAPE_DEFAULT, strict=True)]


def _color() -> list[Column]:
    """The defect's mean colour less the background's, and its mean spread."""
    own = F.coalesce(F.col("n"), F.lit(0)) >= COLOR_PIXELS
    hot = {c: F.when(own, F.col(c)).otherwise(F.col(f"top.{c}")) for c in ("n", "r", "g", "b", "spread")}
    calm = F.col("calm.n") >= CALM_PIXELS
    rest = F.col("whole.n") - hot["n"]
    tone = [hot[c] / hot["n"] - F.when(calm, F.col(f"calm.{c}") / F.col("calm.n")).otherwise((F.col(f"whole.{c}") - hot[c]) / F.nullif(rest, F.lit(0))) for c in "rgb"]
    return [c.alias(name) for name, c in zip(COLOR, (*tone, (tone[0] + tone[1] + tone[2]) / 3, hot["spread"] / hot["n"]), strict=True)]


def describe(maps: DataFrame, image: str = "image_id", height: str = "h", width: str = "w", values: str = "values", pixels: str | None = None) -> DataFrame:
    """One row a map: id, ``mask_pixels``, the columns of COLOR and SHAPE. Maps are
    row-major ``values``, ``pixels`` row-major RGB; without them the map itself is
    the picture. A map whose mask closes to nothing has 0 pixels, the default shape
    and the colour of its hottest pixels."""
    tables = Tables(maps.sparkSession, "regions")
    masked = tables.save(masks(maps, image, height, width, values, pixels), "masks")
    lines = tables.save(runs(masked), "runs")
    found = measure(lines, label(lines, tables))
    best = found.groupBy("key").agg(F.max_by(F.struct(*found.columns[1:]), F.struct("peak", "n", -F.col("region"))).alias("best")).select("key", "best.*")
    best = best.withColumn("hull", _hull("lines")).drop("peak", "lines")
    rows = masked.drop("spots").join(best, "key", "left")
    return rows.select(F.col("id").alias(image), F.coalesce("n", F.lit(0)).cast("long").alias("mask_pixels"), *_color(), *_shape())
