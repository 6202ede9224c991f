from datetime import datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from civitally.operators.dimensions import DIMENSIONS
from civitally.operators.enrich import enrich
from civitally.operators.merge import fold_by_key, fold_repeats, merge_by_key
from civitally.plans import jobs
from civitally.plans.registry import _star
from civitally.sources import adapters as src
from civitally.sources import gold as gold_module
from civitally.sources.gold import Gold, upsert
from civitally.workspace import Workspace

NOW = datetime(2024, 5, 1)
SCHEMA = (
    "unique_key bigint, created_date string, closed_date string, agency string, complaint_type string,"
    " descriptor string, borough string, community_board string, incident_zip bigint, city string,"
    " council_district bigint, police_precinct string, latitude double, longitude double,"
    " location_type string, address_type string, status string"
)


def request(key, created, closed=None, agency="A", status="Open", borough="B"):
    return (key, created, closed, agency, "noise", None, borough, "01", 10001, "NY", None, None, 1.0, 2.0, "st", "ad", status)


@pytest.fixture
def silver(ntz_rows):
    return lambda *rows: enrich(ntz_rows(list(rows), SCHEMA, "created_date", "closed_date"))


@pytest.fixture
def load(spark, tmp_path):
    gold = Gold(spark, f"{tmp_path}/gold")

    def run(batch, load_id, now=NOW):
        return upsert(gold, batch, Workspace(spark), load_id, now)

    run.gold = gold
    return run


def table(gold):
    return sorted(map(tuple, gold.facts().drop("created_month").collect()), key=str)


def test_conflict_rule_per_column(silver, load):
    load(silver(request(1, "2024-01-01 00:00:00", "2024-01-01 05:00:00", None, "Closed"), request(2, "2024-02-01 00:00:00")), "a")
    load(
        silver(
            request(1, "2024-03-09 00:00:00", None, "Z", "Open", "other"),
            request(2, "2024-02-01 00:00:00", "2024-02-02 00:00:00", "Z", "Closed"),
            request(3, "2024-02-03 00:00:00"),
        ),
        "b",
        datetime(2024, 6, 1),
    )
    rows = {r["unique_key"]: r for r in _star(load.gold).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    # reopened: flag and status follow, closing date and hours stay, the rest is frozen
    assert (one["is_closed"], one["status"], str(one["closed_date"])) == (False, "Open", "2024-01-01 05:00:00")
    assert float(one["resolution_time_in_hours"]) == 5.0
    assert one["agency_code"] is None and one["borough"] == "B" and str(one["created_date"])[:7] == "2024-01"
    assert (two["is_closed"], two["agency_code"], float(two["resolution_time_in_hours"])) == (True, "A", 24.0)
    assert [str(r["created_at"])[:10] for r in (one, two, three)] == ["2024-05-01", "2024-05-01", "2024-06-01"]
    assert "2024-03" not in load.gold.current_folders()[1]


def test_only_touched_months_are_rewritten(silver, load):
    load(silver(request(1, "2024-01-01 00:00:00"), request(2, "2024-02-01 00:00:00")), "a")
    load(silver(request(2, "2024-02-01 00:00:00", "2024-02-02 00:00:00")), "b")
    assert load.gold.current_folders()[1] == {"2024-01": "a", "2024-02": "b"}


def test_replay_changes_nothing(silver, load):
    batch = silver(request(1, "2024-01-01 00:00:00"), request(2, "2024-02-01 00:00:00", "2024-02-02 00:00:00"))
    assert load(batch, "a") == 2
    first = table(load.gold)
    dims = {d.name: sorted(map(tuple, load.gold.dimension(d).collect()), key=str) for d in DIMENSIONS}
    assert load(batch, "a") == 0  # already published
    assert load(batch, "b", datetime(2024, 7, 1)) == 2
    assert table(load.gold) == first
    assert dims == {d.name: sorted(map(tuple, load.gold.dimension(d).collect()), key=str) for d in DIMENSIONS}


def test_unfinished_load_is_invisible_and_repeatable(silver, load, monkeypatch):
    load(silver(request(1, "2024-01-01 00:00:00")), "a")
    batch = silver(request(1, "2024-01-01 00:00:00", "2024-01-03 00:00:00"), request(9, "2024-04-01 00:00:00"))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(gold_module.Gold, "_publish", crash)
        with pytest.raises(RuntimeError):
            load(batch, "b")
    assert [r[0] for r in table(load.gold)] == [1]
    assert load(batch, "b") == 2
    assert [(r[0], r[12]) for r in table(load.gold)] == [(1, True), (9, False)]


def test_null_key_stops_the_load(silver, load):
    with pytest.raises(ValueError, match="unique_key"):
        load(silver(request(None, "2024-01-01 00:00:00")), "a")


def test_ids_are_stable_and_unique(silver, load):
    load(silver(*[request(i, "2024-01-01 00:00:00", borough=f"B{i}") for i in range(40)]), "a")
    location = DIMENSIONS[3]
    before = {r["borough"]: r["location_id"] for r in load.gold.dimension(location).collect()}
    load(silver(*[request(i, "2024-01-02 00:00:00", borough=f"B{i}") for i in range(20, 90)]), "b")
    after = {r["borough"]: r["location_id"] for r in load.gold.dimension(location).collect()}
    assert {b: after[b] for b in before} == before
    assert len(after) == 90 == len(set(after.values()))


def test_snapshot_fixture(spark):
    """Half-overlapping snapshots of the history: late closures, reopened, new keys."""
    full = src.with_metrics_columns(src.history(spark, "/root/testdata/sf0.01"))
    cols = ["unique_key", "agency", "closed_date", "status", "is_closed", "resolution_time_in_hours"]

    def opened(df, n):
        keep = F.col("unique_key") % n != 0
        return df.withColumns({c: F.when(keep, F.col(c)) for c in ("closed_date", "resolution_time_in_hours")}).withColumn(
            "is_closed", F.col("is_closed") & keep
        )

    old = opened(full.where("unique_key < 10000"), 3).select(*cols)
    new = opened(full.where("unique_key >= 5000"), 7).withColumn("agency", F.coalesce("agency", F.lit("X"))).select(*cols)
    merged = merge_by_key(old, new)
    assert merged.count() == 15000
    assert merged.where("closed_date is not null and not is_closed").count() == 306
    assert merged.where("agency = 'X' and unique_key < 10000").isEmpty()


def test_silver_path():
    assert jobs.silver_path("s/bronze/daily/bronze/x") == "s/silver/daily/bronze/x/requests.parquet"


def test_repeated_keys_in_one_load_are_folded(silver, load):
    """As if the rows had come one after the other."""
    rows = [
        request(1, "2024-01-01 00:00:00", None, "A", "Open"),
        request(1, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "B", "Closed"),
        request(1, "2024-01-01 00:00:00", None, None, "Reopened"),
        request(2, "2024-02-01 00:00:00"),
    ]
    assert load(silver(*rows).coalesce(1), "a") == 2
    one, two = sorted(_star(load.gold).collect(), key=lambda r: r["unique_key"])
    assert (one["agency_code"], one["status"], one["is_closed"]) == ("A", "Reopened", False)
    assert str(one["closed_date"]) == "2024-01-02 00:00:00" and float(one["resolution_time_in_hours"]) == 24.0
    assert {r["agency_code"] for r in load.gold.dimension(DIMENSIONS[1]).collect()} == {"A"}
    load(silver(*rows[:2]).coalesce(1), "b")
    assert len(table(load.gold)) == 2


def test_months_are_sorted_for_time_windows(spark, silver, load, tmp_path):
    load(silver(*[request(i, f"2024-01-{1 + (i * 7) % 28:02d} 00:00:00") for i in range(60)]), "a")
    for path in tmp_path.glob("gold/facts/created_month=*/load_id=*/*.parquet"):
        dates = [r[0] for r in spark.read.parquet(str(path)).select("created_date").collect()]
        assert dates == sorted(dates)


def test_no_local_folder_on_a_cluster():
    from civitally import workspace

    elsewhere = MagicMock()
    elsewhere.conf.get.return_value = None
    elsewhere.sparkContext.master = "spark://host:7077"
    chosen = elsewhere.sparkContext._jsc.sc.return_value.getCheckpointDir.return_value
    chosen.isDefined.return_value = False
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(elsewhere)
    chosen.isDefined.return_value = True
    chosen.get.return_value = "hdfs://x/y/"
    assert workspace.shared_root(elsewhere) == "hdfs://x/y"


def test_only_repeated_keys_are_folded(spark):
    for repeats in (0, 3, 40):  # none, a few, most
        rows = [(i, 2 * i, f"s{i}", None if i % 3 else f"c{i}") for i in range(50)]
        rows += [(i, 2 * i + 1, f"t{i}", f"d{i}" if i % 2 else None) for i in range(repeats)]
        rows += [(None, 200, "n", None), (None, 201, "m", "x")][: 2 if repeats else 1]
        df = spark.createDataFrame(rows, "unique_key long, at long, status string, closed_date string")
        got = fold_repeats(df, "at", Workspace(spark))
        want = fold_by_key(df, "at")
        assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("Aggregate" in plan) == (repeats == 40) and (repeats > 0 or "Exchange" not in plan)


def test_large_batches_meet_stored_keys_once(silver, load, monkeypatch):
    """Sixty keys would ask the filters of six months 360 times; the months hold sixty keys."""
    rows = [request(i, f"2024-{1 + i % 6:02d}-10 10:00:00") for i in range(60)]
    load(silver(*rows), "a")
    counts = load.gold.counted("agency")
    assert counts.count() <= load.gold.facts().count()  # once, not once per dimension
    monkeypatch.setattr(gold_module, "may_hold", MagicMock(side_effect=AssertionError))
    load(silver(*[request(i, "2024-07-01 00:00:00") for i in range(30, 90)]), "b")
    assert sorted(load.gold.current_folders()[1]) == [f"2024-{m:02d}" for m in range(1, 8)]
    assert load.gold.facts().count() == 90
