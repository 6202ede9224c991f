"""Naive local time: nothing here depends on the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_zone(moment: datetime) -> datetime:
    """Drop the zone without shifting the wall clock."""
    return moment.replace(tzinfo=None)


def ntz(moment: datetime) -> Column:
    return F.lit(strip_zone(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(moment: datetime, days: int) -> datetime:
    return strip_zone(moment) - timedelta(days=days)


# Fixed value: the zone whose wall clock the requests are kept in.
CITY_ZONE = "America/New_York"


def city_now() -> Column:
    """The city's wall clock when the plan runs, not when it is built."""
    return F.convert_timezone(F.current_timezone(), F.lit(CITY_ZONE), F.localtimestamp())


def before(as_of: datetime | None, days: int) -> Column:
    """So many days before ``as_of``, or before now where there is none."""
    if as_of is not None:
        return ntz(days_before(as_of, days))
    return city_now() - F.make_dt_interval(F.lit(days))


def midnight(moment: datetime) -> datetime:
    return strip_zone(moment).replace(hour=0, minute=0, second=0, microsecond=0)


def month_text(moment: datetime) -> str:
    return moment.strftime("%Y-%m")


def month_of(ts: Column) -> Column:
    """'yyyy-MM' of a naive timestamp."""
    return F.substring(ts.cast("string"), 1, 7)


def seconds_between(start: Column, end: Column) -> Column:
    """Exact elapsed seconds, with microseconds, as a decimal."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("decimal(18,0)") * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
        + F.extract(F.lit("SECOND"), gap)
    )


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(3600.0)


def stored_hours(hours: Column) -> Column:
    """Hours as the fact table keeps them: DECIMAL(10,2)."""
    return hours.cast("decimal(20,8)").cast("decimal(10,2)")


def iso_text(ts: Column) -> Column:
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def parse_iso(text: str) -> datetime:
    return strip_zone(datetime.fromisoformat(text))


def month_day_label(day: Column) -> Column:
    return F.substring(day.cast("string"), 6, 5)


def calendar_parts(day: Column) -> list[Column]:
    """Everything the date dimension says about a day; Monday is 1."""
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    ]
