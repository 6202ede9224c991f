"""Ingest state: the last high-water mark, appended once per finished run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import iso_text, parse_iso
from ..schemas import INGEST_STATE

FIRST_RUN_LOOKBACK = timedelta(days=2)


def save_state(mark: DataFrame, path: str, updated_at: datetime | None = None) -> None:
    """Append one JSON row. Appending a single file is atomic; replacing one is not."""
    stamp = (updated_at or datetime.now(timezone.utc)).isoformat()
    mark.select(
        iso_text(F.col("latest_watermark")).alias("latest_watermark"),
        F.col("total_records_fetched").cast("bigint").alias("total_records_fetched"),
        F.lit(stamp).alias("updated_at"),
    ).write.mode("append").json(path)


def load_state(spark: SparkSession, path: str) -> datetime | None:
    """Latest saved mark, or None when no run has finished yet. Other errors propagate."""
    try:
        states = spark.read.schema(INGEST_STATE).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    row = states.agg(F.max_by("latest_watermark", "updated_at").alias("mark")).first()
    return parse_iso(row["mark"]) if row["mark"] else None


def choose_start(
    spark: SparkSession, state_path: str, start: datetime | None, now: datetime
) -> datetime:
    """Explicit start (backfill), else the saved mark, else two days back."""
    if start is not None:
        return start
    return load_state(spark, state_path) or now - FIRST_RUN_LOOKBACK
