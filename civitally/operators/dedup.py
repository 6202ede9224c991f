"""Keep the first (or last) row of each key in row order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..workspace import Workspace


def same_key(columns: list[str], prefix: str) -> Column:
    """Equality of the columns with those of the other side, whose names have the prefix; nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns])


def _with(columns: list[str], order: str) -> list[str]:
    return [*columns, *([order] if order not in columns else [])]


def without(df: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without the rows that agree with ``rows`` on ``columns``; nulls agree with each other.

    Few rows are broadcast, by their written size; many are joined by all the columns, so that a
    key shared by very many rows is spread by its order.
    """
    found = rows.select(*[F.col(c).alias(f"_not_{c}") for c in columns])
    return df.join(found, same_key(columns, "_not_"), "left_anti")


def repeated_rows(
    df: DataFrame,
    ws: Workspace,
    key: str = "unique_key",
    order: str = "row_order",
    scope: tuple[str, ...] = (),
    keep: str = "first",
    name: str = "repeated",
) -> DataFrame:
    """Key, scope and order of all rows whose key has several, and whether a row is ``_lost``.

    Keys are counted first, by themselves: a hash aggregation of fixed-size values. Only rows of keys
    held by several rows are met again, in a join that adaptive execution splits by size, and only
    their orders are compared, by a map-side combined minimum. The result is a written table.
    ``df`` must give the same rows each time it is read.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    columns = [*scope, key]
    best = F.min(order) if keep == "first" else F.max(order)
    several = df.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
    several = ws.stage(several.select(*[F.col(c).alias(f"_of_{c}") for c in columns]), f"{name}-keys")
    met = df.select(*_with(columns, order)).join(several, same_key(columns, "_of_"), "left_semi")
    met = ws.stage(met, f"{name}-rows")
    bests = met.groupBy(*columns).agg(best.alias("_best"))
    bests = bests.select(*[F.col(c).alias(f"_of_{c}") for c in columns], "_best")
    met = met.join(bests, same_key(columns, "_of_"))
    return ws.stage(met.select(*_with(columns, order), (F.col(order) != F.col("_best")).alias("_lost")), name)


def keep_one_per_key(
    df: DataFrame,
    ws: Workspace,
    key: str = "unique_key",
    order: str = "row_order",
    scope: tuple[str, ...] = (),
    keep: str = "first",
    name: str = "repeated",
    found_in: DataFrame | None = None,
) -> DataFrame:
    """One row per key (and scope); null keys count as equal.

    The rows to drop are found by their keys alone; wide rows are not shuffled unless the
    dropped rows are too many to broadcast. Rows of a key that also tie in their order are
    told apart by a ranking of just these rows. ``found_in`` may name a cheaper table with the
    same keys and orders to look for them.
    """
    columns = [*scope, key]
    met = repeated_rows(df if found_in is None else found_in, ws, key, order, scope, keep, name)
    both = _with(columns, order)
    kept = without(df, met.where("_lost"), both)
    tied = met.where("not _lost").groupBy(*both).agg(F.count("*").alias("_n")).where("_n > 1")
    if tied.isEmpty():
        return kept
    tied = ws.stage(tied.select(*both), f"{name}-tied")
    nth = F.row_number().over(Window.partitionBy(*columns).orderBy(order))
    again = tied.select(*[F.col(c).alias(f"_not_{c}") for c in both])
    ranked = kept.join(again, same_key(both, "_not_"), "left_semi").withColumn("_nth", nth)
    one = ranked.where(F.col("_nth") == 1).drop("_nth")
    return without(kept, tied, both).unionByName(one)
