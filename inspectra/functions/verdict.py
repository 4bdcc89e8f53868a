"""Verdicts: scores against a decision band with inclusive bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The closed set of verdicts, and the band shipped with the first model.
STATUSES = ("normal", "pending", "anomaly")
SHIPPED_LOWER, SHIPPED_UPPER = 16.2815, 17.6712


def classify(score: Column, lower: Column, upper: Column) -> Column:
    """Below the band normal, above it anomaly, else pending.  NaN is pending:
    it is below and above nothing, although it sorts last; null stays null."""
    return (
        F.when(score.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(score), "pending")
        .when(score < lower, "normal")
        .when(score > upper, "anomaly")
        .otherwise("pending")
    )


def display_score(score: Column) -> Column:
    """Three decimals, as the dashboard shows it."""
    return F.call_function("format_number", score, F.lit("0.000"))


def keyword_predict(data: Column) -> Column:
    """1 if the text holds "alert" in any case, else 0; null and empty give 0."""
    return F.coalesce(F.lower(data).contains("alert"), F.lit(False)).cast("int")
