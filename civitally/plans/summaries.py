"""Published period summaries over the daily metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import change_pct, published, ratio_pct, round2
from ..functions.timeparts import before, month_day_label, month_of
from ..operators.metrics import COUNT
from .views import COUNTS, as_published, created_from, daily_metrics, in_order


def _midnight(day: str = "request_date") -> Column:
    return F.col(day).cast("timestamp_ntz")


def _days_from(facts: DataFrame, as_of: datetime | None, days: int, metrics: list[str]) -> DataFrame:
    """Daily metrics of days whose midnight is within the window, from facts or counts by day.

    The bound on the raw timestamp reaches the scan of facts, the one on the month prunes folders;
    the one on the day drops the partial first day.
    """
    start = before(as_of, days)
    if COUNT in facts.columns:
        recent = facts.where(F.col("created_month") >= month_of(start))
    else:
        recent = created_from(facts, start)
    return daily_metrics(recent, metrics).where(_midnight() >= start)


def daily_30d_summary(facts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return in_order(daily_30d_series(facts, as_of), "request_date")


def daily_30d_series(facts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The summary, unordered."""
    metrics = COUNTS + ["pct_closed", "avg_resolution_hours", "median_resolution_hours"]
    return as_published(_days_from(facts, as_of, 30, metrics)).select(
        "request_date",
        *COUNTS,
        F.col("pct_closed").alias("pct_closure_daily"),
        F.col("avg_resolution_hours").alias("avg_resolution_time_in_hours"),
        F.col("median_resolution_hours").alias("median_resolution_time_in_hours"),
    )


def daily_chart_series(facts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The 30-day series with month-day labels, oldest first."""
    return daily_30d_summary(facts, as_of).select(
        month_day_label(F.col("request_date")).alias("date"),
        F.col("closed_count").alias("closed_requests"),
        F.col("open_count").alias("open_requests"),
        F.col("pct_closure_daily").alias("pct_closed"),
        F.col("avg_resolution_time_in_hours").alias("avg_resolution_time_hours"),
        F.col("median_resolution_time_in_hours").alias("median_resolution_time_hours"),
    )


def weekly_summary(facts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """This week against the one before: one scan, conditional sums per week.

    Week means are unweighted means of the rounded daily means.
    """
    daily = _days_from(
        facts, as_of, 14, ["total_count", "closed_count", "avg_resolution_hours"]
    )
    this_week = _midnight() >= before(as_of, 7)

    def over(week: Column, column: str) -> Column:
        return F.when(week, F.col(column))

    sums = daily.agg(
        F.min(over(this_week, "request_date")).alias("start"),
        *[
            agg(over(week, src)).alias(f"{prefix}_{name}")
            for prefix, week in (("cur", this_week), ("prev", ~this_week))
            for name, src, agg in (
                ("total", "total_count", F.sum),
                ("closed", "closed_count", F.sum),
                ("mean", "avg_resolution_hours", lambda c: round2(F.avg(c))),
            )
        ],
    )
    c = F.col
    return sums.select(
        c("start").alias("week_start"),
        c("cur_total").alias("week_total_requests"),
        c("cur_closed").alias("week_closed_requests"),
        published(round2(ratio_pct(c("cur_closed"), c("cur_total")))).alias(
            "week_closed_requests_pct"
        ),
        published(c("cur_mean")).alias("week_avg_resolution_time_in_hours"),
        c("prev_total").alias("prev_week_total_requests"),
        c("prev_closed").alias("prev_week_total_closed_requests"),
        published(round2(change_pct(c("cur_total"), c("prev_total")))).alias(
            "prev_week_change_in_requests_pct"
        ),
        published(round2(change_pct(c("cur_closed"), c("prev_closed")))).alias(
            "prev_week_change_in_closed_requests_pct"
        ),
        published(c("prev_mean")).alias("prev_week_avg_resolution_time_in_hours"),
        published(round2(change_pct(c("cur_mean"), c("prev_mean")))).alias(
            "prev_week_avg_resolution_time_in_hours_pct"
        ),
    )
