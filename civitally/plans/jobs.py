"""Batch jobs: ingest to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from ..functions.timeparts import strip_zone
from ..operators.cleaning import clean
from ..operators.enrich import enrich, imputation_metrics
from ..operators.extract import changed_since, next_mark
from ..sources.bronze import DEFAULT_FILE_ROWS, PAGE_ROWS, land_pages, read_pages
from ..sources.gold import Gold, upsert
from ..sources.state import choose_start, save_state
from ..workspace import Workspace, local_table
from .views import register_views

#: What is measured while pages are landed.
OBSERVED = T.StructType(
    [T.StructField("newest", T.TimestampNTZType()), T.StructField("total_records_fetched", T.LongType())]
)


def ingest(
    source: DataFrame,
    bronze_key: str,
    state_path: str,
    now: datetime,
    start: datetime | None = None,
    file_rows: int = DEFAULT_FILE_ROWS,
    keep_state: bool = True,
) -> tuple[str, datetime]:
    """Extract what changed, land it, then save the new mark; returns (pages, mark).

    An explicit ``start`` makes this a backfill. Give it its own state path, or
    ``keep_state=False``, so that it does not move the daily mark.
    """
    spark = source.sparkSession
    begin = choose_start(spark, state_path, start, now)
    seen = Observation()
    pages = land_pages(changed_since(source, begin), bronze_key, begin, file_rows, seen)
    found = [[seen.get[c]] for c in OBSERVED.names]  # measured while the rows were written
    mark = next_mark(local_table(spark, OBSERVED, found), begin, now)
    if keep_state:  # last: a failed landing leaves the old mark in place
        save_state(mark, state_path)
    return pages, strip_zone(mark.first()["latest_watermark"])


def silver_path(bronze_path: str) -> str:
    """Same path with the first 'bronze/' turned into 'silver/'."""
    return bronze_path.replace("bronze/", "silver/", 1).rstrip("/") + "/requests.parquet"


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    scope: str = "batch",
    keep: str = "first",
    page_rows: int = PAGE_ROWS,
    since: date | None = None,
    until: date | None = None,
    stats: Observation | None = None,
) -> str:
    """Read pages, clean, enrich, write Parquet; returns the silver path.

    ``since`` and ``until`` bound the run dates that are read. ``stats`` receives the imputation
    statistics, measured while the rows are written.

    ``scope='page'`` fills every page (``page_rows`` rows of a run in landing order) from
    its own rows only, as a page-by-page run would; ``'batch'`` fills from everything read.
    """
    if scope not in ("batch", "page"):
        raise ValueError("scope must be 'batch' or 'page'")
    pages = read_pages(spark, bronze_path, page_rows=page_rows, since=since, until=until)
    target = silver_path(bronze_path)
    with Workspace(spark, "silver") as ws:
        cleaned = clean(pages, ws, scope=("page",) if scope == "page" else (), keep=keep)
        if stats is not None:
            cleaned = cleaned.observe(stats, *imputation_metrics())
        enrich(cleaned).drop("run", "page", "row_order").write.mode("overwrite").parquet(target)
    return target


def load_gold(
    spark: SparkSession,
    silver: str,
    gold_root: str,
    now: datetime,
    load_id: str | None = None,
) -> int:
    """Upsert silver into the star schema and refresh the views; returns rows loaded.

    The views look back from the time of asking, not from ``now``.
    """
    gold = Gold(spark, gold_root)
    with Workspace(spark, "load") as ws:
        rows = upsert(gold, spark.read.parquet(silver), ws, load_id or uuid.uuid4().hex[:12], now)
    register_views(gold)
    return rows
