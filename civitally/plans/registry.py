"""Every query by name, as ``(spark, sf_dir) -> DataFrame``.

Views and roll-ups read gold tables, as they do in production; the tables are
derived from the given data by the batch jobs, once per session and folder.
"""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache, partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import strip_zone
from ..operators import checks
from ..operators.cleaning import cast_columns, clean, drop_unused
from ..operators.dedup import keep_one_per_key
from ..operators.dimensions import DIMENSIONS
from ..operators.enrich import enrich, imputation_stats
from ..operators.extract import advance_watermark, changed_since
from ..operators.fill import fill_from_group
from ..operators.impute import CATEGORICAL, ZIP_FLAG, impute
from ..operators.keys import resolve_keys
from ..operators.merge import merge_by_key
from ..sources import adapters as src
from ..sources.bronze import land_pages, read_pages
from ..sources.gold import Gold, upsert
from ..streaming.incremental import run_incremental
from ..workspace import Workspace, concurrently
from . import headlines, jobs, summaries, views

Query = Callable[[SparkSession, str], DataFrame]

A_NOW, B_NOW = src.HISTORY_AS_OF, src.DENSE_AS_OF
A_CUT, B_CUT = src.HISTORY_CUT, src.DENSE_CUT
BEGINNING = datetime(1990, 1, 1)

REQUEST_COLUMNS = [
    "unique_key", "agency", "complaint_type", "descriptor", "borough", "community_board",
    "incident_zip", "city", "address_type", "location_type", "council_district",
    "police_precinct", "latitude", "longitude", "status", "created_date", "closed_date",
]


# ---- gold tables derived from the given data ------------------------------------


def _build_gold(spark: SparkSession, sf_dir: str, which: str) -> Gold:
    if which == "history":
        source, now = src.history(spark, sf_dir), A_NOW
    else:
        source, now = src.with_required_columns(src.dense(spark, sf_dir)), B_NOW
    gold = Gold(spark, f"{Workspace(spark, f'gold-{which}').path}/gold")
    with Workspace(spark, "load") as ws:
        upsert(gold, enrich(clean(source, ws, order="unique_key")), ws, "first", now)
    return gold


@lru_cache(maxsize=None)
def _gold(spark: SparkSession, sf_dir: str, which: str) -> Gold:
    return _build_gold(spark, sf_dir, which)


@lru_cache(maxsize=None)
def _raw_dimensions(spark: SparkSession, sf_dir: str) -> Gold:
    """Dimensions of the unimputed history, filled by an early and a full batch."""
    ws = Workspace(spark, "dims")
    gold = Gold(spark, f"{ws.path}/gold")
    with Workspace(spark, "dims-source") as read:
        full = read.stage(src.history(spark, sf_dir), "history")  # eight listings read it
        for batch in (src.snapshot(full, A_CUT), full):
            concurrently(spark, *[partial(gold.append_new_members, dim, batch) for dim in DIMENSIONS])
    return gold


def _star(gold: Gold) -> DataFrame:
    """Facts with the natural keys of their dimensions."""
    facts, dims = gold.facts(), gold.dimensions()
    for dim in DIMENSIONS:
        facts = facts.join(dims[dim.name], dim.id_column, "left")
    return facts


# ---- helpers to register view queries --------------------------------------------


def _on_days(which: str, fn: Callable[..., DataFrame], *args) -> Query:
    """Over the counts by day alone."""
    return lambda spark, d: fn(_gold(spark, d, which).counted("day"), *args)


def _trailing(which: str, fn: Callable[..., DataFrame], as_of: datetime) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        gold = _gold(spark, d, which)
        folders = gold.current_folders()[1]
        return fn(gold.facts(folders), as_of, gold.counted("day", folders))

    return run


def _on_dim(fn: Callable[..., DataFrame], dim: str, kind: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        gold = _gold(spark, d, "history")
        return fn(gold.counted(kind), gold.dimensions()[dim])

    return run


def _then(query: Query, fn: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, d: fn(query(spark, d), *args)


BY_BOROUGH = _on_dim(views.requests_by_borough, "dim_location", "location")
BY_TYPE = _on_dim(views.requests_by_complaint_type, "dim_complaint_type", "complaint_type")
BY_AGENCY = _on_dim(views.requests_by_agency, "dim_agency", "agency")
# the same without their order, for what aggregates or orders them anew
TYPES = _on_dim(views.complaint_type_metrics, "dim_complaint_type", "complaint_type")
AGENCIES = _on_dim(views.agency_metrics, "dim_agency", "agency")


def overview_headline(spark: SparkSession, d: str) -> DataFrame:
    days = _gold(spark, d, "dense").counted("day")
    return headlines.overview_headline(
        summaries.daily_30d_series(days, B_NOW), summaries.weekly_summary(days, B_NOW)
    )


# ---- ingest ------------------------------------------------------------------------


def incremental_extract(spark: SparkSession, d: str) -> DataFrame:
    return changed_since(src.history(spark, d), A_CUT)


def backfill_extract(spark: SparkSession, d: str) -> DataFrame:
    """Backfill job up to bronze, read back: everything from an explicit date."""
    ws = Workspace(spark, "backfill")
    pages, _ = jobs.ingest(
        src.as_text(src.history(spark, d)),
        f"{ws.path}/bronze/historical",
        f"{ws.path}/state",
        A_NOW,
        start=datetime(1996, 2, 29, 17, 45),
        keep_state=False,
    )
    typed = cast_columns(read_pages(spark, pages))
    return typed.select("unique_key", "created_date", "closed_date", "agency", "incident_zip")


def watermark_advance(spark: SparkSession, d: str) -> DataFrame:
    start = strip_zone(A_CUT)
    return advance_watermark(changed_since(src.history(spark, d), start), start, A_NOW)


def bronze_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    ws = Workspace(spark, "bronze")
    pages = land_pages(src.as_text(src.history(spark, d)), f"{ws.path}/bronze", BEGINNING)
    return drop_unused(cast_columns(read_pages(spark, pages))).select(*REQUEST_COLUMNS)


# ---- clean -------------------------------------------------------------------------


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """An early snapshot followed by a full extract; the earlier row of a key wins."""
    full = src.history(spark, d)
    both = (
        src.snapshot(full, A_CUT)
        .withColumn("row_order", F.col("unique_key"))
        .unionByName(full.withColumn("row_order", F.col("unique_key") + F.lit(1 << 40)))
    )
    return keep_one_per_key(both, Workspace(spark, "dedup")).select(*REQUEST_COLUMNS)


def _imputed(spark: SparkSession, d: str, *fills: str) -> DataFrame:
    return impute(src.history(spark, d), Workspace(spark, "fills"), "unique_key", fills=fills)


def impute_zip(spark: SparkSession, d: str) -> DataFrame:
    return _imputed(spark, d, "zip").select(
        "unique_key", "incident_zip", F.col(ZIP_FLAG).alias("imputed")
    )


def impute_categorical(spark: SparkSession, d: str) -> DataFrame:
    return _imputed(spark, d, "categories").select("unique_key", *CATEGORICAL)


def impute_district(spark: SparkSession, d: str) -> DataFrame:
    return _imputed(spark, d, "district").select("unique_key", "council_district")


def _rounded(df: DataFrame) -> DataFrame:
    """Means are float sums: six places after removing binary noise."""
    return df.withColumns(
        {
            c: F.round(F.col(c).cast("decimal(20,10)"), 6).cast("double")
            for c in ("latitude", "longitude")
        }
    )


def impute_coordinates(spark: SparkSession, d: str) -> DataFrame:
    filled = _imputed(spark, d, "coordinates")
    return _rounded(filled.select("unique_key", "latitude", "longitude"))


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    raw = src.as_text(src.history(spark, d)).withColumn("row_order", F.expr("cast(unique_key as bigint)"))
    return clean(raw, Workspace(spark, "clean"))


def clean_requests(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_cleaned(spark, d).select(*REQUEST_COLUMNS))


def clean_by_page(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 1000 rows, each filled from its own rows only."""
    paged = src.history(spark, d).withColumn("page", F.floor(F.col("unique_key") / 1000))
    ws = Workspace(spark, "paged")
    return _rounded(clean(paged, ws, order="unique_key", scope=("page",)).select(*REQUEST_COLUMNS))


def fill_zip_from_point(spark: SparkSession, d: str) -> DataFrame:
    point = ["latitude", "longitude"]
    filled = fill_from_group(src.history(spark, d), "incident_zip", point, order="unique_key")
    return filled.select("unique_key", "incident_zip")


def imputation_quality(spark: SparkSession, d: str) -> DataFrame:
    return imputation_stats(_cleaned(spark, d))


def enrich_requests(spark: SparkSession, d: str) -> DataFrame:
    both = src.with_metrics_columns(src.history(spark, d))
    return both.select("unique_key", "is_closed", "resolution_time_in_hours")


def _two_runs(spark: SparkSession, ws: Workspace, full: DataFrame, cut: datetime) -> str:
    """Pages of an early run and of a later one, below one shared folder."""
    bronze = f"{ws.path}/bronze/historical"
    full = ws.stage(full, "source")  # both runs read it, and each sort samples before it sorts
    land_pages(src.as_text(src.snapshot(full, cut)), bronze, BEGINNING)
    land_pages(src.as_text(changed_since(full, cut)), bronze, cut)
    return bronze


def silver_requests(spark: SparkSession, d: str) -> DataFrame:
    ws = Workspace(spark, "silver")
    bronze = _two_runs(spark, ws, src.history(spark, d), A_CUT)
    silver = spark.read.parquet(jobs.build_silver(spark, bronze))
    hours = F.col("resolution_time_in_hours").cast("decimal(20,6)")
    return _rounded(
        silver.select(*REQUEST_COLUMNS, "is_closed", hours.alias("resolution_time_in_hours"))
    )


# ---- star schema -------------------------------------------------------------------


def _dimension(index: int) -> Query:
    dim = DIMENSIONS[index]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _raw_dimensions(spark, d).dimension(dim).drop(dim.id_column)

    return run


def fact_keys(spark: SparkSession, d: str) -> DataFrame:
    dims = _raw_dimensions(spark, d).dimensions()
    keyed = resolve_keys(src.with_metrics_columns(src.history(spark, d)), dims)
    for dim in DIMENSIONS:
        keyed = keyed.join(dims[dim.name].select(dim.id_column, *dim.key), dim.id_column, "left")
    return keyed.select("unique_key", *[c for dim in DIMENSIONS for c in dim.key])


MERGED = ["unique_key", "agency", "created_date", "closed_date", "status", "is_closed", "resolution_time_in_hours"]


def _stored_and_incoming(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Stored snapshot, and an extract with reopened requests and changed agencies."""
    full = src.history(spark, d)
    old = src.with_metrics_columns(src.snapshot(full, A_CUT)).select(*MERGED)
    reopened = F.col("unique_key") % 7 == 0
    new = changed_since(full, A_CUT).withColumns(
        {
            "closed_date": F.when(~reopened, F.col("closed_date")),
            "status": F.when(reopened, "Open").otherwise(F.col("status")),
            "agency": F.coalesce("agency", F.lit("X")),
        }
    )
    return old, src.with_metrics_columns(new).select(*MERGED)


def fact_upsert(spark: SparkSession, d: str) -> DataFrame:
    return merge_by_key(*_stored_and_incoming(spark, d))


def replay_idempotent(spark: SparkSession, d: str) -> DataFrame:
    old, new = _stored_and_incoming(spark, d)
    return merge_by_key(merge_by_key(old, new), new)


STAR = [
    "unique_key", "agency_code", "complaint_type", "created_date", "closed_date", "is_closed",
    "resolution_time_in_hours",
]


def gold_load(spark: SparkSession, d: str) -> DataFrame:
    star = _star(_build_gold(spark, d, "history"))
    return _rounded(
        star.select(
            *STAR, "full_date", "day_of_week", "descriptor", *DIMENSIONS[3].key, "latitude",
            "longitude", "location_type", "address_type", "status",
        )
    )


def late_closure_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Two daily runs of the whole job chain; the second starts at the saved mark."""
    ws = Workspace(spark, "late")
    full = ws.stage(src.history(spark, d), "source")  # both runs read it, and each sort samples before it sorts
    root, state = f"{ws.path}/gold", f"{ws.path}/state"
    runs = [(src.snapshot(full, A_CUT), A_CUT, BEGINNING), (full, A_NOW, None)]
    for i, (source, now, start) in enumerate(runs):
        bronze = f"{ws.path}/bronze/daily/date={now:%Y-%m-%d}"
        jobs.ingest(src.as_text(source), bronze, state, now, start=start)
        silver = jobs.build_silver(spark, bronze)
        jobs.load_gold(spark, silver, root, now, load_id=f"run-{i}")
    return _star(Gold(spark, root)).select(*STAR, "status")


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Pages landed in two steps, each followed by a run of the stream."""
    ws = Workspace(spark, "stream")
    full = src.with_required_columns(src.dense(spark, d))
    bronze, root = f"{ws.path}/bronze/daily", f"{ws.path}/gold"
    for pages, start, now in (
        (src.snapshot(full, B_CUT), BEGINNING, B_CUT),
        (changed_since(full, B_CUT), B_CUT, B_NOW),
    ):
        land_pages(src.as_text(pages), bronze, start)
        run_incremental(spark, bronze, root, f"{ws.path}/checkpoint", now)
    return _star(Gold(spark, root)).select(*STAR)


def stream_catch_up(spark: SparkSession, d: str) -> DataFrame:
    """Two runs landed before the stream starts once: late closures of the second count."""
    ws = Workspace(spark, "catch-up")
    full = src.with_required_columns(src.dense(spark, d))
    bronze, root = f"{ws.path}/bronze/daily", f"{ws.path}/gold"
    land_pages(src.as_text(src.snapshot(full, B_CUT)), bronze, BEGINNING)
    land_pages(src.as_text(changed_since(full, B_CUT)), bronze, B_CUT)
    run_incremental(spark, bronze, root, f"{ws.path}/checkpoint", B_NOW)
    return _star(Gold(spark, root)).select(*STAR)


def stream_fills(spark: SparkSession, d: str) -> DataFrame:
    """A stream over pages of the history with gaps, each filled from its own rows."""
    ws = Workspace(spark, "stream-fills")
    bronze, root = f"{ws.path}/bronze/daily", f"{ws.path}/gold"
    land_pages(src.as_text(src.history(spark, d)), bronze, BEGINNING)
    run_incremental(spark, bronze, root, f"{ws.path}/checkpoint", A_NOW, max_files=2)
    filled = [c.name for c in DIMENSIONS[3].schema if c.name in ("incident_zip", "city", "council_district")]
    return _rounded(
        _star(Gold(spark, root)).select(*STAR, *filled, "latitude", "longitude", "location_type", "address_type")
    )


def silver_by_page(spark: SparkSession, d: str) -> DataFrame:
    """Two runs through landed files, each page filled from its own rows."""
    ws = Workspace(spark, "silver-pages")
    bronze = _two_runs(spark, ws, src.history(spark, d), A_CUT)
    silver = spark.read.parquet(jobs.build_silver(spark, bronze, scope="page"))
    return _rounded(silver.select(*REQUEST_COLUMNS))


def silver_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    """Two runs below one folder; the first lacks optional columns and orders others anew."""
    ws = Workspace(spark, "mixed")
    full, bronze = src.history(spark, d), f"{ws.path}/bronze/historical"
    early = src.as_text(src.snapshot(full, A_CUT)).drop("incident_zip", "latitude", "longitude")
    land_pages(early.select(*reversed(early.columns)), bronze, BEGINNING)
    land_pages(src.as_text(changed_since(full, A_CUT)), bronze, A_CUT)
    silver = spark.read.parquet(jobs.build_silver(spark, bronze))
    return _rounded(silver.select(*REQUEST_COLUMNS))


def load_folds_repeats(spark: SparkSession, d: str) -> DataFrame:
    """One load that holds early and late rows of a request stores it once."""
    requests = cast_columns(src.with_required_columns(src.dense(spark, d)))
    early = src.with_metrics_columns(src.snapshot(requests, B_CUT))
    late = src.with_metrics_columns(requests).where("closed_date is not null or unique_key % 3 = 0").withColumn("agency", F.lit("late"))
    both = early.withColumn("turn", F.lit(1)).unionByName(late.withColumn("turn", F.lit(2)))
    ws = Workspace(spark, "fold")
    gold = Gold(spark, f"{ws.path}/gold")
    upsert(gold, both, ws, "only", B_NOW, order="turn")
    return _star(gold).select(*STAR)


# ---- checks ------------------------------------------------------------------------


def check_fact_key(spark: SparkSession, d: str) -> DataFrame:
    old, new = _stored_and_incoming(spark, d)
    facts = _gold(spark, d, "history").facts()
    return checks.key_violations(facts, "facts").unionByName(
        checks.key_violations(old.unionByName(new), "unmerged")
    )


def check_fact_fks(spark: SparkSession, d: str) -> DataFrame:
    gold = _gold(spark, d, "history")
    return checks.fk_violations(gold.facts(), gold.dimensions())


def check_dim_keys(spark: SparkSession, d: str) -> DataFrame:
    return checks.dim_key_violations(_raw_dimensions(spark, d).dimensions())


QUERIES: dict[str, Query] = {
    # ingest
    "incremental_extract": incremental_extract,
    "backfill_extract": backfill_extract,
    "watermark_advance": watermark_advance,
    "bronze_roundtrip": bronze_roundtrip,
    # clean and enrich
    "dedup_first": dedup_first,
    "impute_zip": impute_zip,
    "impute_categorical": impute_categorical,
    "impute_district": impute_district,
    "impute_coordinates": impute_coordinates,
    "fill_from_group": fill_zip_from_point,
    "clean_requests": clean_requests,
    "clean_by_page": clean_by_page,
    "imputation_stats": imputation_quality,
    "enrich_requests": enrich_requests,
    "silver_requests": silver_requests,
    "silver_by_page": silver_by_page,
    "silver_mixed_headers": silver_mixed_headers,
    # star schema
    "dim_date": _dimension(0),
    "dim_agency": _dimension(1),
    "dim_complaint_type": _dimension(2),
    "dim_location": _dimension(3),
    "fact_keys": fact_keys,
    "fact_upsert": fact_upsert,
    "replay_idempotent": replay_idempotent,
    "gold_load": gold_load,
    "late_closure_upsert": late_closure_upsert,
    "stream_upsert": stream_upsert,
    "stream_catch_up": stream_catch_up,
    "stream_fills": stream_fills,
    "load_folds_repeats": load_folds_repeats,
    "check_fact_key": check_fact_key,
    "check_fact_fks": check_fact_fks,
    "check_dim_keys": check_dim_keys,
    # metric views
    "requests_daily": _on_days("dense", views.requests_daily),
    "requests_daily_history": _on_days("history", views.requests_daily),
    "requests_7d": _trailing("dense", views.requests_7d, B_NOW),
    "requests_7d_history": _trailing("history", views.requests_7d, A_NOW),
    "requests_30d": _trailing("dense", views.requests_30d, B_NOW),
    "requests_by_borough": BY_BOROUGH,
    "requests_by_complaint_type": BY_TYPE,
    "requests_by_agency": BY_AGENCY,
    "requests_by_day_of_week": _on_dim(views.requests_by_day_of_week, "dim_date", "day"),
    "backlog_aging": _trailing("history", views.backlog_aging, A_NOW),
    "backlog_aging_dense": _trailing("dense", views.backlog_aging, B_NOW),
    # published summaries and roll-ups
    "daily_30d_summary": _on_days("dense", summaries.daily_30d_summary, B_NOW),
    "daily_chart_series": _on_days("dense", summaries.daily_chart_series, B_NOW),
    "weekly_summary": _on_days("dense", summaries.weekly_summary, B_NOW),
    "weekly_summary_history": _on_days("history", summaries.weekly_summary, A_NOW),
    "overview_headline": overview_headline,
    "top10_complaint_types": _then(TYPES, headlines.top_by_volume, "complaint_type"),
    "top10_agencies": _then(AGENCIES, headlines.top_by_volume, "agency_code"),
    "agency_headline": _then(AGENCIES, headlines.agency_headline),
    "complaints_headline": _then(TYPES, headlines.complaints_headline),
    "backlog_share": _then(
        _trailing("history", views.backlog_aging, A_NOW), headlines.backlog_share
    ),
    "borough_cards": _then(BY_BOROUGH, headlines.borough_cards),
}
