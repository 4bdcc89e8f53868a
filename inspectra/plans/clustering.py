"""Defect clusters: production assignment, and the offline experiment."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster, density, descriptors, fusion, layout
from ..operators.vectors import l2_normalise, nearest
from ..tables import Tables


@dataclass
class Clusterer:
    """A fitted second-stage model: principal components, and the tables of the
    layout (``vec, y``) and of the clusters in it."""

    mean: np.ndarray
    parts: np.ndarray
    places: DataFrame
    clusters: DataFrame
    neighbours: int
    min_cluster_size: int


def fit_clusterer(rows: DataFrame, vec: str, components: int = 50, min_cluster_size: int = 3, neighbours: int = 15) -> Clusterer:
    """Unit vectors, principal components, layout, densities, over all rows."""
    unit = rows.select(F.monotonically_increasing_id().alias("row"), l2_normalise(F.col(vec)).alias("v"))
    mean, parts = fusion.fit_pca(unit, "v", 1.0)
    parts = parts[:, :components]
    places = layout.fit(fusion.project(unit, "row", "v", mean, parts), "row", "vec", neighbours)
    return Clusterer(mean, parts, places, density.fit(places, "row", "y", min_cluster_size), neighbours, min_cluster_size)


def assign_clusters(rows: DataFrame, model: Clusterer, id_col: str, vec: str) -> DataFrame:
    """``id, cluster_id, probability``; -1 is noise. A zero vector has no
    direction and is noise. A model without prediction data is refused."""
    if model.clusters is None or model.clusters.isEmpty():
        raise ValueError("the model holds no prediction data")
    unit = rows.select(id_col, l2_normalise(F.col(vec)).alias("v"))
    reduced = fusion.project(unit.where("not exists(v, x -> isnan(x))"), id_col, "v", model.mean, model.parts)
    placed = layout.transform(reduced, model.places, id_col, "vec", model.neighbours)
    lost = unit.where("v is null or exists(v, x -> isnan(x))").select(id_col, F.lit(None).cast("array<double>").alias("y"))
    return density.assign(placed.unionByName(lost), model.clusters, id_col, "y", model.min_cluster_size)


def experiment(patches: DataFrame, bank: DataFrame, colors: DataFrame, shapes: DataFrame, min_cluster_size: int = 3, components: int = fusion.KPCA_COMPONENTS, shape_block: bool = False) -> DataFrame:
    """First and second clustering layer of an experiment's images. With
    ``shape_block`` shapes are a block of their own beside depths and colours, and
    the joined rows get unit length.

    ``patches``: ``image_id, level, patch_idx, vec``; ``bank``: ``level, vec``;
    ``colors`` and ``shapes``: ``image_id`` with ``color`` and ``shape`` arrays.
    Returns ``image_id, cluster, refined``.
    """
    pooled = None
    for (level,) in patches.select("level").distinct().orderBy("level").collect():
        p = patches.where(F.col("level") == level)
        scored = p.join(nearest(p, bank.where(F.col("level") == level), ["image_id", "patch_idx"], "cosine").withColumnRenamed("distance", "score"), ["image_id", "patch_idx"])
        one = descriptors.weighted_pool(scored, ["image_id"]).select("image_id", F.lit(level).alias("level"), "channel", F.col("pooled").alias("value"))
        pooled = one if pooled is None else pooled.unionAll(one)
    deep = descriptors.deep_vectors(pooled, ["image_id"])
    blocks = [fusion.block_prep(deep, "image_id", "deep", fusion.WEIGHT_DEEP), fusion.block_prep(colors, "image_id", "color", fusion.WEIGHT_COLOR)]
    if shape_block:
        blocks.append(fusion.block_prep(shapes, "image_id", "shape", fusion.WEIGHT_SHAPE))
    reduced = fusion.kernel_pca(fusion.concat_blocks(blocks, "image_id", unit=shape_block), "image_id", "vec", components)
    first = cluster.hdbscan(cluster.umap(reduced, "image_id", "vec"), "image_id", "vec", min_cluster_size)
    magnitude = F.sqrt(F.aggregate("color", F.lit(0.0), lambda a, x: a + x * x))
    rows = first.join(colors.select("image_id", magnitude.alias("color_mag")), "image_id").join(shapes.select("image_id", F.col("shape")[1].alias("ecc")), "image_id")
    return fusion.refine(rows, "image_id").select("image_id", "cluster", "refined")


def experiment_of_maps(patches: DataFrame, bank: DataFrame, maps: DataFrame, min_cluster_size: int = 3, components: int = fusion.KPCA_COMPONENTS, shape_block: bool = False) -> DataFrame:
    """The experiment from its score maps (``image_id, h, w, values``): the defect's
    mask in each map gives the image's colour and shape. They are described once,
    into a table."""
    described = Tables(maps.sparkSession, "experiment").save(descriptors.describe_maps(maps).select("image_id", "color", "shape"), "described")
    return experiment(patches, bank, described.select("image_id", "color"), described.select("image_id", "shape"), min_cluster_size, components, shape_block)
