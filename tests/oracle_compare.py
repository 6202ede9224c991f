"""Compare Spark rows with DuckDB rows, order-insensitively and column by name."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb

TABLES = [p.stem for p in Path("/root/testdata/sf0.001").glob("*.parquet")]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def rows_by_name(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


# Spark type name to DuckDB type name.
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(spark_df, rel) -> dict:
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    got = {c: TYPE_NAMES.get(t, t.upper()) for c, t in got.items()}
    return {c: (got[c], want.get(c)) for c in got if got[c] != want.get(c)}


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    rel = con.sql(sql)
    types = type_differences(spark_df, rel)
    if types:
        return f"types (found, expected): {types}"
    want_cols, want = rows_by_name(rel.columns, rel.fetchall())
    got_cols, got = rows_by_name(spark_df.columns, spark_df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    diffs = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(diffs)} rows differ, first {diffs[0]}" if diffs else None
