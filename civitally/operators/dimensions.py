"""Dimension members found in a batch, and stable ids for new ones."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.casts import norm_int, norm_text
from ..functions.timeparts import calendar_parts
from ..schemas import COMPLAINT_KEY, LOCATION_KEY, UNKNOWN

ID_LANES = 64


def date_members(df: DataFrame) -> DataFrame:
    days = df.select(F.to_date("created_date").alias("full_date")).dropna().distinct()
    return days.select("full_date", *calendar_parts(F.col("full_date")))


def agency_members(df: DataFrame) -> DataFrame:
    return df.select(F.col("agency").alias("agency_code")).dropna().distinct()


def normalized_complaint(df: DataFrame) -> DataFrame:
    return df.withColumns({c: norm_text(F.col(c)) for c in COMPLAINT_KEY})


def normalized_location(df: DataFrame) -> DataFrame:
    """The six location columns with their sentinels; absent columns count as null."""
    absent = {c: F.lit(None).cast("string") for c in LOCATION_KEY if c not in df.columns}
    return df.withColumns(absent).withColumns(
        {
            "borough": norm_text(F.col("borough"), UNKNOWN),
            "community_board": norm_text(F.col("community_board")),
            "incident_zip": norm_text(F.col("incident_zip")),
            "city": norm_text(F.col("city"), UNKNOWN),
            "council_district": norm_int(F.col("council_district")),
            "police_precinct": norm_text(F.col("police_precinct")),
        }
    )


def complaint_type_members(df: DataFrame) -> DataFrame:
    return normalized_complaint(df).select(*COMPLAINT_KEY).distinct()


def location_members(df: DataFrame) -> DataFrame:
    return normalized_location(df).select(*LOCATION_KEY).distinct()


@dataclass(frozen=True)
class Dimension:
    name: str
    schema: T.StructType
    id_column: str
    key: list[str]
    members: Callable[[DataFrame], DataFrame]


DIMENSIONS = [
    Dimension("dim_date", schemas.DIM_DATE, "date_id", ["full_date"], date_members),
    Dimension("dim_agency", schemas.DIM_AGENCY, "agency_id", ["agency_code"], agency_members),
    Dimension(
        "dim_complaint_type",
        schemas.DIM_COMPLAINT_TYPE,
        "complaint_type_id",
        COMPLAINT_KEY,
        complaint_type_members,
    ),
    Dimension("dim_location", schemas.DIM_LOCATION, "location_id", LOCATION_KEY, location_members),
]


def new_members(members: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Insert-if-absent: members whose natural key is not stored yet."""
    return members.join(existing.select(*key), key, "left_anti")


def met_by(existing: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
    """The stored members that a batch refers to; ``members`` is the batch's staged list of them.

    A daily batch meets few of the places ever seen. What is left of the dimension is small
    enough to send to the wide rows, even where the dimension itself is not.
    """
    return existing.join(members.select(*key), key, "left_semi")


def with_ids(fresh: DataFrame, dim: Dimension, highest: int) -> DataFrame:
    """Number new members above ``highest``; stored ids never change.

    Members are hashed into lanes and ranked inside their lane; interleaving the
    lanes gives unique ids without ever ordering all members in one task.
    """
    lane = F.pmod(F.xxhash64(*dim.key), F.lit(ID_LANES))
    rank = F.row_number().over(Window.partitionBy("_lane").orderBy(*dim.key))
    numbered = fresh.withColumn("_lane", lane).withColumn(
        dim.id_column, F.lit(highest + 1) + (rank.cast("bigint") - 1) * ID_LANES + F.col("_lane")
    )
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])
