"""Queries over result tables: lists, candidates, summary, joined verdicts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.verdict import STATUSES, display_score

DEFAULT_LIMIT, MOST = 50, 500


def recent_good(results: DataFrame, registry: DataFrame, model_type: str, n: int = 200, once: bool = False) -> DataFrame:
    """The n newest normal results of a type, event_id breaking ties.  ``once``
    keeps only the newest result of each image.  The registry is a few rows a
    model version; Catalyst broadcasts it by its size."""
    types = registry.where(F.col("model_type") == model_type).select("model_id").distinct()
    good = results.where("status = 'normal'").join(types, "model_id", "left_semi")
    if once:
        newest = good.groupBy("object_key").agg(F.max(F.struct("inferred_at", "event_id")).alias("k"))
        good = good.join(newest.select(F.col("k.event_id").alias("event_id")), "event_id", "left_semi")
    return good.orderBy(F.col("inferred_at").desc(), F.col("event_id")).limit(n)


def recent(results: DataFrame, status: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest results first, for display; arguments out of range raise ValueError."""
    if not 1 <= limit <= MOST:
        raise ValueError(f"limit must be 1..{MOST}")
    if status is not None and status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    rows = results if status is None else results.where(F.col("status") == status)
    return rows.orderBy(F.col("inferred_at").desc(), F.col("event_id")).limit(limit).select(
        "event_id",
        "image_id",
        "model_id",
        "object_key",
        "anomaly_score",
        "status",
        "heatmap_key",
        F.date_format("inferred_at", "yyyy-MM-dd'T'HH:mm:ss").alias("inferred_at"),
        display_score(F.col("anomaly_score")).alias("score_text"),
        F.upper("status").alias("verdict"),
        (F.col("status") == "pending").alias("selectable"),
    )


def retrain_candidates(results: DataFrame, registry: DataFrame, event_ids: Iterable[str] | DataFrame) -> DataFrame:
    """Still-pending results among the chosen events, with their model's type.
    Ids may be a table, for selections that are not a handful."""
    if isinstance(event_ids, DataFrame):
        chosen = results.join(event_ids.select("event_id").distinct(), "event_id", "left_semi")
    else:
        ids = list(event_ids)
        if not ids:
            raise ValueError("no event ids")
        chosen = results.where(F.col("event_id").isin(ids))
    return chosen.where("status = 'pending'").join(registry.select("model_id", "model_type"), "model_id").select("event_id", "model_type", "bucket", "object_key")


def verdict_summary(results: DataFrame) -> DataFrame:
    """Counts of the three verdicts, zeros included, and their total: one pass,
    one row a task to the final sum."""
    counted = results.agg(*(F.count_if(F.col("status") == s).alias(s) for s in STATUSES))
    total = sum((F.col(s) for s in STATUSES[1:]), F.col(STATUSES[0]))
    rows = [F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES]
    return counted.select(F.explode(F.array(*rows, F.struct(F.lit("total").alias("status"), total.alias("n")))).alias("r")).select("r.status", "r.n")


def with_clusters(results: DataFrame, clusters: DataFrame) -> DataFrame:
    """Results with the second stage's verdict: ``not_run`` where it has no row,
    ``noise`` for -1, else ``cluster``. The newest cluster row of an image counts."""
    newest = clusters.groupBy("image_id").agg(F.max(F.struct("clustered_at", "event_id", "cluster_id", "probability")).alias("c"))
    stage = F.when(F.col("c").isNull(), "not_run").when(F.col("c.cluster_id") == -1, "noise").otherwise("cluster")
    return results.join(newest, "image_id", "left").select(
        "event_id", "image_id", "status", stage.alias("stage"), F.col("c.cluster_id").alias("cluster_id"), F.col("c.probability").alias("probability")
    )
