import numpy as np
import pytest
from pyspark.sql import functions as F

from inspectra.operators import descriptors, regions
from inspectra.tables import Tables

MAPS = "image_id long, h int, w int, values array<double>, rgb array<double>"


def some_maps():
    rng = np.random.default_rng(3)
    out = []
    for i, (h, w) in enumerate([(24, 40), (50, 17), (33, 33), (8, 8), (64, 64), (40, 24)] * 2):
        a = rng.random((h, w)) ** 3
        for _ in range(i % 4):
            y, x = rng.integers(h), rng.integers(w)
            a[max(0, y - 4) : y + 5, max(0, x - 2) : x + 9] += rng.random() * 3
        rgb = rng.random((h, w, 3))
        # Ids repeat, and one is null.
        out.append((None if i == 5 else i // 2, h, w, a.ravel().tolist(), rgb.ravel().tolist()))
    out.append((99, 12, 12, [0.0] * 144, [0.5] * 432))
    return out


def rows(df, names):
    return sorted((tuple(-1 if r[c] is None else round(float(r[c]), 7) + 0.0 for c in names) for r in df.collect()), key=repr)


def test_equals_rasters(spark):
    """Row by row the same as the raster code, repeated and null ids included."""
    maps = spark.createDataFrame(some_maps(), MAPS)
    names = ["image_id", "mask_pixels", *regions.COLOR, *regions.SHAPE]
    plain = descriptors.describe_maps(maps, pixels="rgb")
    flat = [F.get("color", F.lit(i)).alias(c) for i, c in enumerate(regions.COLOR)] + [F.get("shape", F.lit(i)).alias(c) for i, c in enumerate(regions.SHAPE)]
    want = rows(plain.select("image_id", "mask_pixels", *flat), names)
    assert rows(regions.describe(maps, pixels="rgb"), names) == want
    assert len({w[1] for w in want}) > 3


def pictures(spark, masks):
    spots = [(k, m.shape[0], m.shape[1], 0, [(int(y), int(x), 0.0, 0.0, 0.0) for y, x in np.argwhere(m)]) for k, m in enumerate(masks)]
    return spark.createDataFrame(spots, "key long, h long, w long, peak long, spots array<struct<y: long, x: long, r: double, g: double, b: double>>")


def test_regions_of_spirals_and_noise(spark):
    """Long bent regions settle; regions are those of plain labelling."""
    spiral = np.zeros((41, 41), bool)
    y = x = 20
    spiral[y, x] = True
    for i in range(1, 39):
        dy, dx = ((0, 1), (1, 0), (0, -1), (-1, 0))[(i - 1) % 4]
        for _ in range(2 * ((i + 1) // 2)):
            if 0 <= y + dy < 41 and 0 <= x + dx < 41:
                y, x = y + dy, x + dx
                spiral[y, x] = True
    comb = np.zeros((20, 40), bool)
    comb[:, ::4] = True
    comb[-1] = True
    noise = [np.random.default_rng(i).random((30, 30)) < 0.35 for i in range(4)]
    masks = [spiral, comb, *noise, np.zeros((5, 5), bool)]
    tables = Tables(spark, "regions-test")
    lines = tables.save(regions.runs(pictures(spark, masks)), "runs")
    found = regions.measure(lines, regions.label(lines, tables)).select("key", "region", "n", "y0", "y1", "x0", "x1").collect()
    want = []
    for k, m in enumerate(masks):
        names = descriptors.label(m)
        for i in range(1, names.max() + 1):
            p = np.argwhere(names == i)
            lo, hi = p.min(axis=0), p.max(axis=0)
            want.append((k, int(p[0][0] * m.shape[1] + p[0][1]), len(p), lo[0], hi[0], lo[1], hi[1]))
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert len(want) > 50


def test_empty_table(spark):
    assert regions.describe(spark.createDataFrame([], MAPS)).count() == 0


def test_a_map_that_does_not_fit_fails(spark):
    with pytest.raises(Exception, match="reshape"):
        regions.describe(spark.createDataFrame([(1, 3, 3, [1.0], None)], MAPS)).count()
