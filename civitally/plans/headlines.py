"""Dashboard roll-ups: small tables computed from the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import display_round, or_zero, ratio_pct, trend

BANDS = ["lt_7d", "d7_to_30", "d30_to_90", "gt_90d"]


def overview_headline(daily_30d: DataFrame, weekly: DataFrame) -> DataFrame:
    """Week totals and changes, the latest day, and the 30-day open total."""
    latest = F.max_by(
        F.struct("total_count", "closed_count", "pct_closure_daily"), "request_date"
    )
    zero = F.lit(0).cast("bigint")
    series = daily_30d.agg(
        latest.alias("latest"), F.coalesce(F.sum("open_count"), zero).alias("open_30d")
    )
    d_requests = or_zero(F.col("prev_week_change_in_requests_pct"))
    d_closed = or_zero(F.col("prev_week_change_in_closed_requests_pct"))
    d_hours = or_zero(F.col("prev_week_avg_resolution_time_in_hours_pct"))
    return weekly.crossJoin(series).select(
        F.coalesce("week_total_requests", zero).alias("total_7d"),
        d_requests.alias("change_in_requests_pct"),
        trend(d_requests).alias("requests_trend"),
        d_closed.alias("change_in_closed_requests_pct"),
        trend(d_closed).alias("closed_trend"),
        F.coalesce(F.col("latest.total_count"), zero).alias("latest_day_total"),
        F.coalesce(F.col("latest.closed_count"), zero).alias("latest_day_closed"),
        display_round(or_zero(F.col("latest.pct_closure_daily")), 1).alias("latest_day_pct_closed"),
        display_round(or_zero(F.col("week_avg_resolution_time_in_hours")), 1).alias(
            "week_avg_resolution_hours"
        ),
        d_hours.alias("change_in_avg_resolution_pct"),
        trend(d_hours, lower_is_better=True).alias("resolution_trend"),
        F.col("open_30d"),
    )


def top_by_volume(view: DataFrame, key: str, n: int = 10) -> DataFrame:
    return view.orderBy(F.col("total_count").desc(), F.col(key)).limit(n)


def agency_headline(by_agency: DataFrame) -> DataFrame:
    """Agency count, unweighted mean of the percent closed, total open backlog."""
    return by_agency.agg(
        F.count("*").alias("agencies"),
        display_round(or_zero(F.avg("pct_closed")), 1).alias("avg_pct_closed"),
        F.coalesce(F.sum("open_backlog"), F.lit(0).cast("bigint")).alias("total_open_backlog"),
    )


def _best(columns: list[str], rank: Column, key: str) -> Column:
    """The row with the largest rank; ties go to the smallest key."""
    return F.min_by(F.struct(*columns), F.when(rank.isNotNull(), F.struct(-rank, F.col(key))))


def complaints_headline(by_type: DataFrame) -> DataFrame:
    """Number of types, the busiest one, and the slowest one by 90th percentile."""
    key = "complaint_type"
    return by_type.agg(
        F.count("*").alias("complaint_types"),
        _best([key, "total_count"], F.col("total_count"), key).alias("busy"),
        _best([key, "p90_resolution_hours"], F.col("p90_resolution_hours"), key).alias("slow"),
    ).select(
        "complaint_types",
        F.col(f"busy.{key}").alias("busiest_type"),
        F.col("busy.total_count").alias("busiest_total"),
        F.col(f"slow.{key}").alias("slowest_type"),
        display_round(F.col("slow.p90_resolution_hours"), 0).alias("slowest_p90_hours"),
    )


def backlog_share(aging: DataFrame) -> DataFrame:
    """Long form of the age bands with their share of the open total."""
    total = sum((F.col(b) for b in BANDS[1:]), F.col(BANDS[0]))
    long = aging.withColumn("total_open", total).unpivot(
        ["total_open"], BANDS, "bucket", "open_requests"
    )
    share = display_round(ratio_pct(F.col("open_requests"), F.col("total_open")), 1)
    return long.select("bucket", "open_requests", share.alias("share_pct"), "total_open")


def borough_cards(by_borough: DataFrame) -> DataFrame:
    return by_borough.select(
        "borough", "total_count", display_round(F.col("pct_closed"), 1).alias("pct_closed")
    )
