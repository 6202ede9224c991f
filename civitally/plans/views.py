"""The eight metric views over the gold tables.

Every view is a function of the fact table or of counted requests, a dimension where it
groups by one, and ``as_of`` where it looks back from now; None means the time of asking. The
views of a gold folder read its counts, and facts only for the part of a day at which a
window begins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import published
from ..functions.timeparts import before, month_of
from ..operators.metrics import COUNT, counted, request_metrics
from ..sources.gold import Gold

COUNTS = ["total_count", "closed_count", "open_count"]
ALL_METRICS = COUNTS + [
    "pct_closed",
    "avg_resolution_hours",
    "median_resolution_hours",
    "p90_resolution_hours",
]


def as_published(df: DataFrame) -> DataFrame:
    """Decimal metrics leave as double."""
    return df.select(
        *[
            published(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "decimal" else f.name
            for f in df.schema
        ]
    )


def created_from(facts: DataFrame, start: Column) -> DataFrame:
    """Row-time lower bound; the month bound prunes folders, the other row groups."""
    recent = facts.where(F.col("created_date") >= start)
    if "created_month" in facts.columns:
        recent = recent.where(F.col("created_month") >= month_of(start))
    return recent


def daily_metrics(facts: DataFrame, metrics: list[str]) -> DataFrame:
    if COUNT not in facts.columns:
        facts = facts.withColumn("request_date", F.to_date("created_date"))
    return request_metrics(facts, ["request_date"], metrics)


def in_order(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Global order of a grouped result.

    A range sort first samples its input, which would run the ranking behind the
    metrics twice. The hash exchange in front lets it sample the few result rows.
    """
    return df.repartition(F.col(df.columns[0])).orderBy(*columns)


def requests_daily(facts: DataFrame) -> DataFrame:
    return in_order(as_published(daily_metrics(facts, ALL_METRICS)), F.col("request_date").desc())


def trailing_window(
    facts: DataFrame, as_of: datetime | None, days: int, by_day: DataFrame | None = None
) -> DataFrame:
    """Requests created in so many days before ``as_of``; with counts by day, facts of the first day only."""
    start = before(as_of, days)
    recent = created_from(facts, start)
    if by_day is not None:
        first = F.to_date(start)
        part = counted(recent.where(F.col("created_date") < F.date_add(first, 1).cast("timestamp_ntz")), [])
        whole = by_day.where((F.col("request_date") > first) & (F.col("created_month") >= month_of(start)))
        recent = part.unionByName(whole.select(*part.columns))
    return as_published(request_metrics(recent, [], ALL_METRICS))


def requests_7d(facts: DataFrame, as_of: datetime | None = None, by_day: DataFrame | None = None) -> DataFrame:
    return trailing_window(facts, as_of, 7, by_day)


def requests_30d(facts: DataFrame, as_of: datetime | None = None, by_day: DataFrame | None = None) -> DataFrame:
    return trailing_window(facts, as_of, 30, by_day)


def by_volume(df: DataFrame, key: str) -> DataFrame:
    return in_order(df, F.col("total_count").desc(), F.col(key))


def requests_by_borough(facts: DataFrame, dim_location: DataFrame) -> DataFrame:
    places = dim_location.select("location_id", "borough")
    placed = counted(facts, ["location_id"]).join(places, "location_id")
    metrics = COUNTS + ["pct_closed", "avg_resolution_hours", "median_resolution_hours"]
    return by_volume(as_published(request_metrics(placed, ["borough"], metrics)), "borough")


def requests_by_complaint_type(facts: DataFrame, dim_complaint_type: DataFrame) -> DataFrame:
    return by_volume(complaint_type_metrics(facts, dim_complaint_type), "complaint_type")


def requests_by_agency(facts: DataFrame, dim_agency: DataFrame) -> DataFrame:
    return by_volume(agency_metrics(facts, dim_agency), "agency_code")


def complaint_type_metrics(facts: DataFrame, dim_complaint_type: DataFrame) -> DataFrame:
    """Descriptors of one complaint type collapse into it; unordered."""
    types = dim_complaint_type.select("complaint_type_id", "complaint_type")
    typed = counted(facts, ["complaint_type_id"]).join(types, "complaint_type_id")
    metrics = [m for m in ALL_METRICS if m != "open_count"]
    return as_published(request_metrics(typed, ["complaint_type"], metrics))


def agency_metrics(facts: DataFrame, dim_agency: DataFrame) -> DataFrame:
    """Requests without an agency drop out here; unordered."""
    owned = counted(facts, ["agency_id"]).join(dim_agency, "agency_id")
    metrics = [m for m in ALL_METRICS if m != "median_resolution_hours"]
    result = request_metrics(owned, ["agency_code"], metrics)
    return as_published(result).withColumnRenamed("open_count", "open_backlog")


def requests_by_day_of_week(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_id", "day_of_week", "day_name")
    dated = counted(facts, ["date_id"]).join(days, "date_id")
    metrics = ["total_count", "pct_closed", "avg_resolution_hours"]
    result = request_metrics(dated, ["day_of_week", "day_name"], metrics)
    return in_order(as_published(result), "day_of_week")


def backlog_aging(
    facts: DataFrame, as_of: datetime | None = None, by_day: DataFrame | None = None
) -> DataFrame:
    """Open requests in four age bands; a creation date ahead of now counts as youngest.

    With counts by day, facts are read of the three days only at which a band begins.
    """
    edges = {"_7": before(as_of, 7), "_30": before(as_of, 30), "_90": before(as_of, 90)}
    rows = facts.where(~F.col("is_closed"))
    created = F.col("created_date")
    if by_day is not None:
        days = [F.to_date(e) for e in edges.values()]
        inside = [(created >= d.cast("timestamp_ntz")) & (created < F.date_add(d, 1).cast("timestamp_ntz")) for d in days]
        rows = rows.where(inside[0] | inside[1] | inside[2])
        rows = rows.where(F.col("created_month").isin([month_of(e) for e in edges.values()]))
    found = rows.select(F.lit(1).cast("long").alias(COUNT), *[(created > e).alias(c) for c, e in edges.items()])
    if by_day is not None:
        whole = by_day.where(~F.col("is_closed") & ~F.col("request_date").isin(days))
        found = found.unionByName(
            whole.select(COUNT, *[(F.col("request_date") > F.to_date(e)).alias(c) for c, e in edges.items()])
        )
    younger = [F.col(c) for c in edges]
    bands = {
        "lt_7d": younger[0],
        "d7_to_30": ~younger[0] & younger[1],
        "d30_to_90": ~younger[1] & younger[2],
        "gt_90d": ~younger[2],
    }
    return found.agg(*[F.sum(F.when(inside, F.col(COUNT)).otherwise(0)).alias(name) for name, inside in bands.items()])


def all_views(gold: Gold, as_of: datetime | None) -> dict[str, DataFrame]:
    folders = gold.current_folders()[1]  # all views of one version
    facts, dims, by_day = gold.facts(folders), gold.dimensions(), gold.counted("day", folders)
    return {
        "v_requests_daily": requests_daily(by_day),
        "v_requests_7d": requests_7d(facts, as_of, by_day),
        "v_requests_30d": requests_30d(facts, as_of, by_day),
        "v_requests_by_borough": requests_by_borough(gold.counted("location", folders), dims["dim_location"]),
        "v_requests_by_complaint_type": requests_by_complaint_type(
            gold.counted("complaint_type", folders), dims["dim_complaint_type"]
        ),
        "v_requests_by_agency": requests_by_agency(gold.counted("agency", folders), dims["dim_agency"]),
        "v_requests_by_day_of_week": requests_by_day_of_week(by_day, dims["dim_date"]),
        "v_backlog_aging": backlog_aging(facts, as_of, by_day),
    }


def register_views(gold: Gold, as_of: datetime | None = None) -> list[str]:
    """Replace the session's temp views; called after every load, batch or stream.

    Without ``as_of`` each query of a view looks back from its own time.
    """
    views = all_views(gold, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
