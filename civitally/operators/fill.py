"""Fill nulls of a column from the first non-null value of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def first_per_group(
    df: DataFrame, keys: list[str], value: str, order: str, name: str
) -> DataFrame:
    """The first non-null ``value`` of each fully known group, in row order.

    Two steps: the least row order of every (group, value) pair is a plain hash
    aggregation with map-side combining, so a hot group costs one row per task
    and distinct value; the choice among the few pairs left comes after it.
    """
    pairs = (
        df.where(all_present([*keys, value]))
        .groupBy(*keys, value)
        .agg(F.min(order).alias("_first_row"))
    )
    return pairs.groupBy(*keys).agg(F.min_by(value, "_first_row").alias(name))


def fill_from_group(
    df: DataFrame,
    col: str,
    keys: list[str],
    order: str = "row_order",
    scope: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with nulls of ``col`` filled per group; absent group columns are ignored.

    Only rows that can be filled meet the lookup. The others, among them every
    row with a null key, pass by without a shuffle.
    """
    known = [k for k in keys if k in df.columns]
    if not known:
        return df
    on = [*scope, *known]
    lookup = first_per_group(df, on, col, order, "_fill")
    fillable = F.col(col).isNull() & all_present(known)
    filled = (
        df.where(fillable)
        .join(lookup, on, "left")
        .withColumn(col, F.col("_fill"))
        .select(*df.columns)
    )
    return df.where(~fillable).unionByName(filled)
