"""What several operators share: table reads, span text, and Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and nothing else, on UTF-8 bytes.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes, empty for null, so that Python gets no decoded copy."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def whole_rows(docs: DataFrame, *more: Column | str) -> DataFrame:
    """Each row as one struct ``row`` beside further columns, so that no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def unwrapped(rows: DataFrame) -> DataFrame:
    """The rows that ``whole_rows`` wrapped."""
    return rows.select("row.*")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Identify a document where ids may repeat or be null: its id and its text's hash."""
    return [F.col(doc_id), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key")]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield record_batch(schema, *zip(*held))
            held = []
    if held:
        yield record_batch(schema, *zip(*held))
