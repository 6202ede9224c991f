"""Request-shaped views of the driver's tables.

``history``: orders joined to their place, with gaps in most columns, over seven years.
``dense``: events, thirty busy days.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import hours_between, iso_text, ntz, stored_hours
from ..schemas import REQUIRED_COLUMNS

HISTORY_AS_OF = datetime(2001, 8, 2, 6, 0, 0)
DENSE_AS_OF = datetime(2024, 1, 30, 12, 0, 0)
# Moments used to cut the data into an earlier snapshot and a later extract.
HISTORY_CUT = datetime(1999, 6, 15, 8, 30, 0)
DENSE_CUT = datetime(2024, 1, 15, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _after(ts: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    nation = F.col("c_nationkey").cast("bigint")
    created = _after(F.col("o_orderdate"), (key * 7919) % 86400)
    closed = _after(F.col("o_orderdate"), (key * 7919) % 86400 + (key * 104729) % 2000003)

    def unless_every(n: int, value: Column) -> Column:
        return F.when(key % n != 0, value)

    def tagged(prefix: str, n: int) -> Column:
        return F.concat(F.lit(prefix), (key % n).cast("string"))

    is_open = F.col("o_orderstatus") == "O"
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("unique_key"),
            unless_every(11, F.col("o_orderpriority")).alias("agency"),
            F.col("c_mktsegment").alias("complaint_type"),
            unless_every(13, tagged("D", 4)).alias("descriptor"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("community_board"),
            unless_every(5, F.lit(10000) + nation * 10 + key % 3).alias("incident_zip"),
            unless_every(6, F.concat(F.lit("CITY_"), "n_name")).alias("city"),
            unless_every(8, tagged("AT_", 3)).alias("address_type"),
            unless_every(9, tagged("LT_", 5)).alias("location_type"),
            unless_every(10, nation + 1).alias("council_district"),
            F.concat(F.lit("Precinct "), F.col("c_nationkey").cast("string")).alias(
                "police_precinct"
            ),
            unless_every(4, nation.cast("double") + (key % 7) / F.lit(10.0)).alias("latitude"),
            unless_every(4, -nation.cast("double") - (key % 3) / F.lit(10.0)).alias("longitude"),
            F.when(is_open, "Open").otherwise("Closed").alias("status"),
            created.alias("created_date"),
            F.when(~is_open, closed).alias("closed_date"),
        )
        .withColumn("resolution_action_updated_date", F.col("closed_date"))
    )


def _to_second(ts: Column) -> Column:
    micros = (F.extract(F.lit("SECOND"), ts) % 1).cast("decimal(18,6)")
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, micros)


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    created = _to_second(F.col("ts"))
    duration = F.floor(F.col("value") * 1000)
    return (
        table(spark, sf_dir, "events")
        .select(
            key.alias("unique_key"),
            F.concat(F.lit("AG"), (F.col("user_id") % 7).cast("string")).alias("agency"),
            F.col("event_type").alias("complaint_type"),
            created.alias("created_date"),
            F.when(key % 4 != 0, _after(created, duration)).alias("closed_date"),
        )
        .withColumn("resolution_action_updated_date", F.col("closed_date"))
    )


def with_metrics_columns(df: DataFrame) -> DataFrame:
    """Closure flag and stored hours, as the fact table keeps them."""
    hours = hours_between(F.col("created_date"), F.col("closed_date"))
    return df.withColumns(
        {
            "is_closed": F.col("closed_date").isNotNull(),
            "resolution_time_in_hours": stored_hours(hours),
        }
    )


def snapshot(df: DataFrame, moment: datetime) -> DataFrame:
    """The requests as they stood then: not yet created absent, not yet closed open."""
    done = F.coalesce(F.col("closed_date") <= ntz(moment), F.lit(False))
    seen = df.where(F.col("created_date") < ntz(moment)).withColumn(
        "closed_date", F.when(done, F.col("closed_date"))
    )
    if "status" in df.columns:
        seen = seen.withColumn("status", F.when(done, F.col("status")).otherwise("Open"))
    return seen.withColumn("resolution_action_updated_date", F.col("closed_date"))


def as_text(df: DataFrame) -> DataFrame:
    """The raw page form: every column text, with columns the pipeline drops.

    Zips arrive as '10001.0' on some rows; one dropped column holds commas,
    quotes and line breaks.
    """
    texts = {}
    for f in df.schema:
        kind = f.dataType.typeName()
        text = F.col(f.name).cast("string")
        if kind == "timestamp_ntz":
            text = iso_text(F.col(f.name))
        if f.name == "incident_zip":
            text = F.when(F.col("unique_key") % 2 == 0, F.concat(text, F.lit(".0"))).otherwise(text)
        texts[f.name] = text
    return df.withColumns(
        {
            "agency_name": F.concat(F.lit("Dept "), F.coalesce("agency", F.lit("?"))),
            "bbl": F.col("unique_key").cast("string"),
            "resolution_description": F.lit('Said "done",\nthen left.'),
        }
    ).select(
        *[texts.get(c, F.col(c)).alias(c) for c in [*df.columns]],
        "agency_name",
        "bbl",
        "resolution_description",
    )


def with_required_columns(df: DataFrame) -> DataFrame:
    """The dense adapter lacks columns a page must have; they become null text."""
    absent = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent})
