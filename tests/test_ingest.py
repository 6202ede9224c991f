from datetime import date, datetime, timedelta, timezone
import json
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from civitally.operators.extract import advance_watermark, changed_since
from civitally.plans import jobs
from civitally.plans.registry import _star
from civitally.sources import adapters as src
from civitally.sources import bronze as bronze_module
from civitally.sources.bronze import land_pages, read_pages
from civitally.sources.gold import Gold
from civitally.sources.state import choose_start, load_state, save_state
from civitally.streaming.incremental import LoadReport, run_incremental

LATER = datetime(2030, 1, 1)
DDL = "unique_key bigint, created_date string, resolution_action_updated_date string"
DATES = ("created_date", "resolution_action_updated_date")


def rows(*pairs):
    return [(i, c, u) for i, (c, u) in enumerate(pairs)]


CASES = {
    "empty": (datetime(2024, 1, 1), [], datetime(2024, 1, 1)),
    "update wins": (
        datetime(2024, 1, 1),
        rows(("2024-01-03T08:00:00", "2024-01-05T10:00:00"), ("2024-01-04T09:00:00", None)),
        datetime(2024, 1, 5, 10),
    ),
    "late closure": (
        datetime(2024, 1, 9),
        rows(("2024-01-10T09:00:00", None), ("2024-01-01T08:00:00", "2024-01-10T08:00:00")),
        datetime(2024, 1, 10, 9),
    ),
    "two pages": (
        datetime(2024, 1, 1),
        rows(("2024-01-05T10:00:00", None), ("2024-01-08T12:00:00", "2024-01-10T12:00:00")),
        datetime(2024, 1, 10, 12),
    ),
    "zone is dropped": (datetime(2024, 1, 1, tzinfo=timezone(timedelta(hours=-5))), [], datetime(2024, 1, 1)),
}


@pytest.mark.parametrize("case", list(CASES))
def test_ingest_watermark_and_state(spark, tmp_path, case):
    start, data, want = CASES[case]
    source = spark.createDataFrame(data, DDL)
    _, mark = jobs.ingest(source, f"{tmp_path}/bronze/x", f"{tmp_path}/state", LATER, start=start, file_rows=1)
    assert mark == want and mark.tzinfo is None
    assert load_state(spark, f"{tmp_path}/state") == want
    state = json.loads(next(Path(f"{tmp_path}/state").glob("*.json")).read_text())
    assert set(state) == {"latest_watermark", "total_records_fetched", "updated_at"}
    assert state["total_records_fetched"] == len(data)


def test_mark_never_moves_back_nor_past_now(spark, ntz_rows):
    df = ntz_rows(rows(("2024-01-03 00:00:00", "2031-01-01 00:00:00")), DDL, *DATES)
    now = datetime(2024, 6, 1)
    assert advance_watermark(df, datetime(2024, 1, 1), now).first()[0] == now
    assert advance_watermark(df, datetime(2025, 1, 1), now).first()[0] == datetime(2025, 1, 1)


def test_start_is_cut_to_midnight_and_either_date_counts(spark, ntz_rows):
    df = ntz_rows(
        rows(
            ("2024-01-09 00:00:00", None), ("2024-01-08 23:59:59", None),
            ("2020-01-01 00:00:00", "2024-01-09 00:00:00"), ("2020-01-01 00:00:00", "2024-01-08 00:00:00"),
        ),
        DDL, *DATES,
    )
    assert [r[0] for r in changed_since(df, datetime(2024, 1, 9, 17, 30)).collect()] == [0, 2]


def test_extract_filter_reaches_the_scan(spark, tmp_path, ntz_rows):
    ntz_rows(rows(("2024-01-09 00:00:00", None)), DDL, *DATES).write.parquet(f"{tmp_path}/t")
    plan = changed_since(spark.read.parquet(f"{tmp_path}/t"), datetime(2024, 1, 9))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(resolution_action_updated_date" in text


def test_failed_landing_saves_no_state(spark, tmp_path):
    source = spark.createDataFrame(rows(("2024-01-03T08:00:00", None)), DDL).withColumn(
        "boom", F.raise_error(F.lit("disk full")).cast("string")
    )
    with pytest.raises(Exception, match="disk full"):
        jobs.ingest(source, f"{tmp_path}/bronze/x", f"{tmp_path}/state", LATER, start=datetime(2024, 1, 1))
    assert load_state(spark, f"{tmp_path}/state") is None


def test_failed_state_write_propagates(spark, tmp_path):
    (tmp_path / "state").write_text("a file where the folder should be")
    source = spark.createDataFrame(rows(("2024-01-03T08:00:00", None)), DDL)
    with pytest.raises(Exception):
        jobs.ingest(source, f"{tmp_path}/bronze/x", f"{tmp_path}/state", LATER, start=datetime(2024, 1, 1))


def test_choice_of_start(spark, tmp_path):
    state, now = f"{tmp_path}/state", datetime(2024, 5, 3)
    assert choose_start(spark, state, None, now) == datetime(2024, 5, 1)
    for i, day in enumerate(("2024-04-01", "2024-04-09")):
        mark = spark.sql(f"select timestamp_ntz'{day} 01:02:03' latest_watermark, 5L total_records_fetched")
        save_state(mark, state, datetime(2024, 5, 1 + i, tzinfo=timezone.utc))
    assert choose_start(spark, state, None, now) == datetime(2024, 4, 9, 1, 2, 3)
    assert choose_start(spark, state, datetime(2020, 1, 1), now) == datetime(2020, 1, 1)


def test_backfill_leaves_the_daily_mark(spark, tmp_path):
    source = spark.createDataFrame(rows(("2024-01-03T08:00:00", None)), DDL)
    jobs.ingest(source, f"{tmp_path}/bronze/h", f"{tmp_path}/state", LATER, start=datetime(2020, 1, 1), keep_state=False)
    assert load_state(spark, f"{tmp_path}/state") is None


def test_no_pages_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV files"):
        read_pages(spark, f"{tmp_path}/nothing")
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "metadata.json").write_text("{}")
    with pytest.raises(ValueError, match="no CSV files"):
        read_pages(spark, f"{tmp_path}/only")


def test_pages_keep_order_skip_other_files_and_read_missing_texts(spark, tmp_path):
    for day, body in (("2024-01-02", "k,v\n3,N/A\n4,x\n"), ("2024-01-01", 'k,v\n1,"a ""b"",\nc"\n2,\n')):
        (tmp_path / f"my day={day}").mkdir()
        (tmp_path / f"my day={day}" / "p.csv").write_text(body)
    (tmp_path / "metadata.json").write_text('{"a": 1}')
    rows = read_pages(spark, str(tmp_path)).orderBy("row_order").collect()
    assert [(r["k"], r["v"]) for r in rows] == [("1", 'a "b",\nc'), ("2", None), ("3", None), ("4", "x")]
    assert [r["page"][-16:] for r in rows] == ["2024-01-01/p.csv"] * 2 + ["2024-01-02/p.csv"] * 2


def test_runs_with_other_headers_join_by_name(spark, tmp_path):
    for name, body in (("a", "k,v\n1,x\n"), ("b", "v,w,k\ny,z,2\n"), ("b/inner", "w,k\nq,3\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "p.csv").write_text(body)
    df = read_pages(spark, str(tmp_path))
    got = [tuple(r) for r in df.select("k", "v", "w").orderBy("row_order").collect()]
    assert got == [("1", "x", None), ("2", "y", "z"), ("3", None, "q")]
    (tmp_path / "a" / "q.csv").write_text("v,k\n1,x\n")
    with pytest.raises(Exception):  # one folder never mixes up columns silently
        read_pages(spark, f"{tmp_path}/a").collect()


def test_file_size_and_newest_first(spark, tmp_path):
    df = spark.range(25).selectExpr("cast(id as string) unique_key", "concat('2024-01-', lpad(id + 1, 2, '0')) created_date")
    pages = land_pages(df, f"{tmp_path}/bronze", datetime(2024, 1, 1), file_rows=4)
    sizes = [len(p.read_text().splitlines()) - 1 for p in Path(pages).glob("*.csv")]
    assert max(sizes) <= 4 and sum(sizes) == 25
    back = read_pages(spark, pages, page_rows=10)
    assert [int(r["unique_key"]) for r in back.orderBy("row_order").collect()] == list(range(24, -1, -1))
    assert sorted(r["count"] for r in back.groupBy("page").count().collect()) == [5, 10, 10]


def test_landed_cells_are_verbatim(spark, tmp_path):
    cells = [" lead", "trail ", "  ", "\ttab\t", 'q"uo"te', "a,b", "two\nlines", "cr\r\nlf", "", None, '"', "\\"]
    df = spark.createDataFrame([(str(i), f"2024-01-{i + 1:02d}", c) for i, c in enumerate(cells)], "unique_key string, created_date string, v string")
    back = read_pages(spark, land_pages(df, f"{tmp_path}/b", datetime(2024, 1, 1)))
    got = {int(r["unique_key"]): r["v"] for r in back.collect()}
    assert [got[i] for i in range(len(cells))] == [c or None for c in cells]


def test_stream_equals_batch_and_restart_is_idle(spark, tmp_path):
    full = src.with_required_columns(src.dense(spark, "/root/testdata/sf0.001"))
    text = src.as_text(full)
    bronze = f"{tmp_path}/bronze/d"
    # three pages, whole data
    text.repartition(3).write.option("header", True).option("escape", '"').csv(bronze)

    def run():
        return run_incremental(
            spark, bronze, f"{tmp_path}/gold", f"{tmp_path}/cp", src.DENSE_AS_OF, max_files=1
        )

    assert run() == 3
    facts = Gold(spark, f"{tmp_path}/gold").facts().drop("created_month")
    before = sorted(map(tuple, facts.collect()), key=str)
    assert run() == 0
    assert sorted(map(tuple, Gold(spark, f"{tmp_path}/gold").facts().drop("created_month").collect()), key=str) == before

    # a new checkpoint replays every page under new load ids and changes nothing
    ids = {r[0].rsplit("-", 1)[0] for r in spark.read.json(f"{tmp_path}/gold/loads").select("load_id").collect()}
    assert len(ids) == 1 and "None" not in ids
    again = run_incremental(spark, bronze, f"{tmp_path}/gold", f"{tmp_path}/cp2", src.DENSE_AS_OF)
    assert again == 1
    assert sorted(map(tuple, Gold(spark, f"{tmp_path}/gold").facts().drop("created_month").collect()), key=str) == before

    silver = jobs.build_silver(spark, bronze)
    assert jobs.load_gold(spark, silver, f"{tmp_path}/gold2", src.DENSE_AS_OF) == full.count()
    cols = ["unique_key", "agency_code", "complaint_type", "created_date", "closed_date", "is_closed"]
    a, b = (sorted(map(tuple, _star(Gold(spark, f"{tmp_path}/{g}")).select(*cols).collect()), key=str) for g in ("gold", "gold2"))
    assert a == b


def test_silver_scopes(spark, tmp_path):
    full = src.as_text(src.history(spark, "/root/testdata/sf0.001"))
    pages = land_pages(full, f"{tmp_path}/bronze/s", datetime(1990, 1, 1), file_rows=200)
    n = full.count()
    for scope in ("batch", "page"):
        silver = spark.read.parquet(jobs.build_silver(spark, pages, scope))
        assert silver.count() == n
        assert silver.where("city is null or address_type is null or location_type is null").isEmpty()
    with pytest.raises(ValueError):
        jobs.build_silver(spark, pages, "planet")


def test_page_scope_does_not_depend_on_files(spark, tmp_path):
    full = src.as_text(src.history(spark, "/root/testdata/sf0.001"))
    found = []
    for i, file_rows in enumerate((170, 100_000)):
        pages = land_pages(full, f"{tmp_path}/bronze/s{i}", datetime(1990, 1, 1), file_rows=file_rows)
        silver = spark.read.parquet(jobs.build_silver(spark, pages, "page", page_rows=100))
        found.append(sorted(map(str, silver.collect())))
    assert found[0] == found[1]


def test_stream_does_not_depend_on_batch_size(spark, tmp_path):
    """Two runs with gaps and late closures; files hold whole pages."""
    full = src.history(spark, "/root/testdata/sf0.001")
    bronze = f"{tmp_path}/bronze/d"
    for source, start in ((src.snapshot(full, src.HISTORY_CUT), datetime(1990, 1, 1)), (changed_since(full, src.HISTORY_CUT), src.HISTORY_CUT)):
        land_pages(src.as_text(source), bronze, start, file_rows=300)
    found = []
    for n in (1, 3, 1000):
        run_incremental(spark, bronze, f"{tmp_path}/g{n}", f"{tmp_path}/cp{n}", src.HISTORY_AS_OF, max_files=n, page_rows=100)
        star = _star(Gold(spark, f"{tmp_path}/g{n}"))
        cols = [c for c in star.columns if not c.endswith("_id")]
        found.append(sorted(map(str, star.select(*cols).collect())))
    assert found[0] == found[1] == found[2]
    closed = full.where("closed_date is not null").count()
    assert sum("is_closed=True" in r for r in found[0]) == closed


def test_views_move_with_the_clock_and_see_the_stream(spark, tmp_path):
    now = spark.sql("select convert_timezone(current_timezone(), 'America/New_York', localtimestamp())").first()[0]
    base = src.as_text(src.with_required_columns(src.dense(spark, "/root/testdata/sf0.001")).limit(3))
    keyed = base.withColumn("unique_key", F.monotonically_increasing_id().cast("string"))
    bronze = f"{tmp_path}/bronze/d"

    def land(days, run):
        rows = keyed.withColumn("created_date", F.lit((now - timedelta(days=days)).isoformat(timespec="seconds")))
        rows = rows.withColumns({"closed_date": F.lit(None).cast("string"), "unique_key": F.concat(F.lit(str(days)), "unique_key")})
        land_pages(rows, bronze, datetime(2024, 1, run))
        run_incremental(spark, bronze, f"{tmp_path}/g", f"{tmp_path}/cp", now)
        return spark.table("v_requests_7d").first()["total_count"]

    assert land(1, 1) == 3
    assert land(20, 2) == 3  # outside the window
    assert land(2, 3) == 6


def test_ingest_measures_while_it_lands(spark, tmp_path, monkeypatch):
    """Nothing landed is read back for the mark or the count."""
    monkeypatch.setattr(jobs, "read_pages", lambda *_, **__: pytest.fail("read back"))
    monkeypatch.setattr(bronze_module, "_read_alike", lambda *_: pytest.fail("read back"))
    data = rows(*[(f"2024-01-{1 + i % 9:02d}T08:00:00", "2024-01-20T10:00:00" if i == 77 else None) for i in range(300)])
    source = spark.createDataFrame(data, DDL).repartition(5)
    _, mark = jobs.ingest(source, f"{tmp_path}/bronze/x", f"{tmp_path}/state", LATER, start=datetime(2024, 1, 1))
    assert mark == datetime(2024, 1, 20, 10)
    state = json.loads(next(Path(f"{tmp_path}/state").glob("*.json")).read_text())
    assert state["total_records_fetched"] == 300


def test_silver_write_measures_imputation(spark, tmp_path):
    full = src.history(spark, "/root/testdata/sf0.001")
    pages = land_pages(src.as_text(full), f"{tmp_path}/bronze/s", datetime(1990, 1, 1))
    stats = Observation()
    silver = spark.read.parquet(jobs.build_silver(spark, pages, stats=stats))
    lacking = full.where("incident_zip is null").count()
    assert stats.get["total"] == full.count() == silver.count()
    assert stats.get["filled"] + stats.get["still_null"] == lacking
    assert stats.get["still_null"] == silver.where("incident_zip is null").count()


def test_a_bounded_read_opens_only_its_runs(spark, tmp_path):
    df = spark.range(3).selectExpr("cast(id as string) unique_key", "'2024-01-01' created_date", "cast(null as string) v")
    for month in (1, 2, 3):
        land_pages(df, f"{tmp_path}/bronze/daily", datetime(2024, month, 1))
    nested = land_pages(df, f"{tmp_path}/bronze/other/date=2024-02-01", datetime(2024, 1, 15))
    (tmp_path / "bronze/daily/2024-03-01/broken.csv").write_text("x,y\n1,2\n")  # would stop a read of that run
    (tmp_path / "bronze/loose.csv").write_text("unique_key\n9\n")
    bound = {"since": date(2024, 1, 2), "until": date(2024, 2, 28)}
    got = read_pages(spark, f"{tmp_path}/bronze", **bound)
    assert {f.rsplit("/bronze/", 1)[1].split("/part")[0] for f in got.inputFiles()} == {
        "daily/2024-02-01", "other/date=2024-02-01/2024-01-15",
    }
    assert got.count() == 6 and nested.endswith("2024-01-15")
    with pytest.raises(ValueError, match="no CSV files"):
        read_pages(spark, f"{tmp_path}/bronze", since=date(2025, 1, 1))
    with pytest.raises(Exception):
        read_pages(spark, f"{tmp_path}/bronze/daily", since=date(2024, 3, 1)).collect()


def test_row_number_column_is_not_overwritten(spark, tmp_path):
    df = spark.sql("select '1' unique_key, '2024-01-01' created_date, 'mine' _row")
    with pytest.raises(ValueError, match="_row"):
        land_pages(df, f"{tmp_path}/b", datetime(2024, 1, 1))


def test_stream_pages_are_whole_whatever_the_file_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze_module, "PAGE_ROWS", 100)
    full = src.history(spark, "/root/testdata/sf0.001")
    bronze, found, reports = f"{tmp_path}/bronze/d", [], []
    land_pages(src.as_text(full), bronze, datetime(1990, 1, 1), file_rows=750)  # seven pages and a half
    for n in (1, 1000):
        report = LoadReport()
        run_incremental(
            spark, bronze, f"{tmp_path}/g{n}", f"{tmp_path}/cp{n}", src.HISTORY_AS_OF, max_files=n, page_rows=100, report=report
        )
        star = _star(Gold(spark, f"{tmp_path}/g{n}"))
        found.append(sorted(map(str, star.select(*[c for c in star.columns if not c.endswith("_id")]).collect())))
        reports.append(report)
    assert found[0] == found[1]
    n = full.count()
    files = -(-n // 700)
    assert [(r.batches, r.rows_loaded) for r in reports] == [(files, n), (1, n)]
    assert [sum(r.files.values()) for r in reports] == [files, files] and set(reports[0].files) == set(reports[0].rows)


def test_stream_refuses_cut_pages(spark, tmp_path):
    bronze = f"{tmp_path}/bronze/d"
    land_pages(src.as_text(src.history(spark, "/root/testdata/sf0.001").limit(100)), bronze, datetime(1990, 1, 1), file_rows=30)
    with pytest.raises(Exception, match="cut pages"):
        run_incremental(spark, bronze, f"{tmp_path}/g", f"{tmp_path}/cp", src.HISTORY_AS_OF, max_files=1, page_rows=100)
    assert Gold(spark, f"{tmp_path}/g").facts().isEmpty()
