"""From raw text pages to typed, deduplicated, imputed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import lenient_double, lenient_long, strict_timestamp
from ..schemas import DROPPED_COLUMNS, OPTIONAL_COLUMNS, REQUIRED_COLUMNS
from ..workspace import Workspace
from .dedup import keep_one_per_key
from .impute import impute

_CASTS = {
    "created_date": strict_timestamp,
    "closed_date": strict_timestamp,
    "latitude": lenient_double,
    "longitude": lenient_double,
    "unique_key": lenient_long,
    "incident_zip": lenient_long,
    "council_district": lenient_long,
}


def cast_columns(df: DataFrame) -> DataFrame:
    """Typed columns; required ones must exist, optional ones become null, extras pass."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    df = df.withColumns(
        {c: F.lit(None).cast(t) for c, t in OPTIONAL_COLUMNS.items() if c not in df.columns}
    )
    kinds: dict[str, T.DataType] = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: cast(F.col(c), kinds[c]) for c, cast in _CASTS.items()})


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*DROPPED_COLUMNS)


def typed_rows(df: DataFrame, ws: Workspace) -> DataFrame:
    """Cast rows with the columns that are kept, written once; what follows reads this table."""
    return ws.stage(drop_unused(cast_columns(df)), "typed")


def clean(
    df: DataFrame,
    ws: Workspace,
    order: str = "row_order",
    scope: tuple[str, ...] = (),
    keep: str = "first",
    across: bool = True,
) -> DataFrame:
    """Cast, drop, deduplicate, impute.

    With an empty scope the whole batch is one unit and is deduplicated first, so
    a duplicate never donates a value. With a page column as scope, rows are
    deduplicated and filled within their page, then once more across pages unless
    ``across`` is false.
    """
    return clean_typed(typed_rows(df, ws), ws, order, scope, keep, across)


def clean_typed(
    typed: DataFrame,
    ws: Workspace,
    order: str = "row_order",
    scope: tuple[str, ...] = (),
    keep: str = "first",
    across: bool = True,
) -> DataFrame:
    """``clean`` for rows already cast and written."""
    base = keep_one_per_key(typed, ws, order=order, scope=scope, keep=keep)
    filled = impute(base, ws, order, scope)
    if scope and across:  # fills touch neither keys nor orders, so repeats are found before them
        filled = keep_one_per_key(filled, ws, order=order, keep=keep, name="across", found_in=base)
    return filled
