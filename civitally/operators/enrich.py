"""Closure flag, resolution time and imputation quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import display_round, ratio_pct
from ..functions.timeparts import hours_between
from .impute import ZIP_FLAG


def enrich(df: DataFrame) -> DataFrame:
    """Closed means a closing date exists; the status text is never consulted."""
    return df.withColumns(
        {
            "is_closed": F.col("closed_date").isNotNull(),
            "resolution_time_in_hours": hours_between(F.col("created_date"), F.col("closed_date")),
        }
    ).drop(ZIP_FLAG)


def imputation_metrics() -> list[Column]:
    """Aggregates behind the statistics; a write may observe them as its rows pass."""
    return [
        F.count("*").alias("total"),
        F.count_if(ZIP_FLAG).alias("filled"),
        F.count_if(F.col("incident_zip").isNull()).alias("still_null"),
    ]


def imputation_shares(counts: DataFrame) -> DataFrame:
    """The statistics from their aggregates."""
    counts = counts.withColumn("originally_null", F.col("filled") + F.col("still_null"))
    share = {
        f"{c}_pct": display_round(ratio_pct(F.col(c), F.col("total")), 1)
        for c in ("originally_null", "filled", "still_null")
    }
    return counts.withColumns(share).select("total", "originally_null", "filled", "still_null", *share)


def imputation_stats(cleaned: DataFrame) -> DataFrame:
    """One row: how many zips were null, got filled, or stayed null, with shares."""
    return imputation_shares(cleaned.agg(*imputation_metrics()))
