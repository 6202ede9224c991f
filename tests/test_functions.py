from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitally.functions import casts, rounding, timeparts

TEXT = T.StringType()


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_numbers_are_lenient(spark):
    texts = ["10001", "10001.0", "10001-1234", "10001.5", "00083", " 7 ", "1e3", "NaN", "", None, "x"]
    longs = column(spark, texts, lambda c: casts.lenient_long(c, TEXT))
    assert longs == [10001, 10001, None, None, 83, 7, 1000, None, None, None, None]
    doubles = column(spark, ["40.5", "nan", "-73.9", "abc", None, ".5", "inf"], lambda c: casts.lenient_double(c, TEXT))
    assert doubles == [40.5, None, -73.9, None, None, 0.5, float("inf")]


def test_big_keys_stay_exact(spark):
    assert column(spark, ["9007199254740993"], lambda c: casts.lenient_long(c, TEXT)) == [9007199254740993]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_are_strict(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = ["2024-01-05T10:00:00.000", "2024-01-05 10:00:00", None]
        day = datetime(2024, 1, 5, 10)
        assert column(spark, good, lambda c: casts.strict_timestamp(c, TEXT)) == [day, day, None]
        with pytest.raises(Exception, match="not a timestamp"):
            column(spark, ["01/05"], lambda c: casts.strict_timestamp(c, TEXT))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_ignore_the_session_zone(spark, zone):
    """The US clock change of 2024-03-10 must not show in naive time."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "select timestamp_ntz'2024-03-09 12:00:00' a, timestamp_ntz'2024-03-10 12:00:00.5' b"
        )
        row = df.select(
            timeparts.seconds_between(F.col("a"), F.col("b")).alias("s"),
            timeparts.seconds_between(F.col("b"), F.col("a")).alias("neg"),
            timeparts.stored_hours(timeparts.hours_between(F.col("a"), F.col("b"))).alias("h"),
            timeparts.month_of(F.col("b")).alias("m"),
            timeparts.iso_text(F.col("a")).alias("iso"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert float(row["s"]) == 86400.5 and float(row["neg"]) == -86400.5
    assert (float(row["h"]), row["m"], row["iso"]) == (24.0, "2024-03", "2024-03-09T12:00:00")


def test_zone_is_stripped_not_shifted():
    aware = datetime(2024, 1, 1, 23, 30, tzinfo=timezone.utc)
    assert timeparts.strip_zone(aware) == datetime(2024, 1, 1, 23, 30)
    assert timeparts.midnight(aware) == datetime(2024, 1, 1)
    assert timeparts.parse_iso("2024-01-01T05:00:00+05:00") == datetime(2024, 1, 1, 5)


def test_rounding_and_ratios(spark):
    df = spark.sql("select 0.125D a, -0.125D b, 1.005D c, 2.675D d")
    assert [float(x) for x in df.select(*[rounding.round2(F.col(c)) for c in "abcd"]).first()] == [
        0.13, -0.13, 1.01, 2.68,
    ]
    row = spark.sql("select 3L part, 0L none, 4L whole").select(
        rounding.ratio_pct(F.col("part"), F.col("whole")),
        rounding.ratio_pct(F.col("part"), F.col("none")),
        rounding.change_pct(F.col("part"), F.col("whole")),
        rounding.change_pct(F.col("part"), F.col("none")),
    ).first()
    assert list(row) == [75.0, None, -25.0, None]


def test_trend_and_labels(spark):
    df = spark.createDataFrame([(2.0,), (-1.0,), (0.0,)], "d double")
    rows = df.select(rounding.trend(F.col("d")), rounding.trend(F.col("d"), True)).collect()
    assert [tuple(r) for r in rows] == [("up", "down"), ("down", "up"), ("flat", "flat")]
    label = spark.sql("select date'2024-04-18' d").select(timeparts.month_day_label(F.col("d")))
    assert label.first()[0] == "04-18"


def test_calendar_parts(spark):
    row = spark.sql("select date'2024-12-29' d").select(*timeparts.calendar_parts(F.col("d"))).first()
    assert list(row) == [2024, 4, 12, "December", 29, 7, "Sunday"]
