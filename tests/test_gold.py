"""What is kept beside the facts: key filters, counts, and the checks of a load."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_load import load, request, silver  # noqa: F401

from civitally.operators import checks
from civitally.operators.dimensions import met_by
from civitally.operators.key_filter import BITS_PER_KEY, BLOCK_BITS, blocks_for, build_filters, may_hold
from civitally.operators.keys import resolve_keys
from civitally.operators.metrics import counted
from civitally.plans import views
from civitally.sources.gold import KINDS, BrokenConstraint, Gold
from civitally.workspace import Workspace

AS_OF = datetime(2024, 6, 20, 15, 30)


def test_filters_know_every_key_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.pmod("id", F.lit(6)).alias("g"))
    sizes = {r["g"]: blocks_for(r["count"]) for r in keys.groupBy("g").count().collect()}
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("g"))
    keys = keys.withColumn("blocks", size.cast("long"))
    filters = build_filters(keys, "k", ["g"], "blocks")
    assert filters.count() <= sum(sizes.values())
    assert may_hold(keys, "k", filters, "g", "blocks").count() == keys.count()
    strange = keys.withColumn("k", F.col("k") + 1)
    assert may_hold(strange, "k", filters, "g", "blocks").count() < 0.01 * keys.count()
    assert blocks_for(0) == 1 and blocks_for(10**6) * BLOCK_BITS >= 10**6 * BITS_PER_KEY


@pytest.fixture
def half_year(silver, load):  # noqa: F811
    """Sixty requests whose keys are spread over all months, so that key ranges tell nothing."""
    rows = [request(1000 + (i * 37) % 61, f"2024-{1 + i % 6:02d}-{1 + i % 28:02d} 10:00:00",
                    f"2024-{1 + i % 6:02d}-{1 + i % 28:02d} {11 + i % 9}:00:00" if i % 3 else None,
                    f"A{i % 3}" if i % 5 else None, "Closed" if i % 3 else "Open", f"B{i % 4}") for i in range(60)]
    load(silver(*rows), "a")
    return rows


def test_only_months_that_may_hold_a_key_are_opened(silver, load, half_year, monkeypatch):  # noqa: F811
    opened = []
    months = Gold._months
    with monkeypatch.context() as m:
        m.setattr(Gold, "_located", lambda self, *a, f=Gold._located: (opened.clear(), f(self, *a), opened.append("located"))[1])
        m.setattr(Gold, "_months", lambda self, wanted: (opened.append(sorted(wanted)), months(self, wanted))[1])
        late = half_year[2]  # a request of March
        load(silver(request(late[0], late[1], "2024-06-01 00:00:00"), request(5000, "2024-07-01 00:00:00")), "b")
    assert opened[: opened.index("located")] == [["2024-03"]]
    folders = load.gold.current_folders()[1]
    assert {m for m, v in folders.items() if v == "b"} == {"2024-03", "2024-07"}
    assert load.gold.facts().count() == 61
    state = load.gold.manifest()[1]["2024-07"]
    assert (state["keys"], state["low"], state["high"], state["blocks"]) == (1, 5000, 5000, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_counts_follow_the_facts(silver, load, half_year):  # noqa: F811
    reopened, closed = half_year[1], half_year[3]
    load(
        silver(
            request(reopened[0], reopened[1], None, "Z", "Open"),  # keeps its hours, loses its flag
            request(closed[0], closed[1], "2024-06-19 10:00:00", "Z", "Closed"),
            request(5000, "2024-06-13 15:30:00"), request(5001, "2024-06-13 15:29:59"), request(5002, "2024-06-20 15:00:00"),
        ),
        "b",
    )
    gold = load.gold
    facts = gold.facts().withColumn("request_date", F.to_date("created_date"))
    for kind, columns in KINDS.items():
        kept = counted(gold.counted(kind), columns)
        assert rows(kept) == rows(counted(facts, columns).select(*kept.columns))
    dims = gold.dimensions()
    from_facts = {
        "v_requests_daily": views.requests_daily(facts),
        "v_requests_7d": views.requests_7d(facts, AS_OF),
        "v_requests_30d": views.requests_30d(facts, AS_OF),
        "v_requests_by_borough": views.requests_by_borough(facts, dims["dim_location"]),
        "v_requests_by_complaint_type": views.requests_by_complaint_type(facts, dims["dim_complaint_type"]),
        "v_requests_by_agency": views.requests_by_agency(facts, dims["dim_agency"]),
        "v_requests_by_day_of_week": views.requests_by_day_of_week(facts, dims["dim_date"]),
        "v_backlog_aging": views.backlog_aging(facts, AS_OF),
    }
    kept = views.all_views(gold, AS_OF)
    for name, want in from_facts.items():
        assert (kept[name].columns, rows(kept[name])) == (want.columns, rows(want))
    assert kept["v_requests_7d"].first()["total_count"] >= 2


def test_views_read_counts(load, half_year):  # noqa: F811
    for name, view in views.all_views(load.gold, AS_OF).items():
        plan = view._jdf.queryExecution().executedPlan().toString()
        if name in ("v_requests_7d", "v_requests_30d", "v_backlog_aging"):
            bounds = [x.split("]")[0] for x in plan.split("PushedFilters: [")[1:] if "created_date" in x.split("]")[0]]
            assert bounds and all("GreaterThanOrEqual(created_date" in b for b in bounds)
            assert name == "v_backlog_aging" or all("LessThan(created_dat" in b for b in bounds)
        else:
            assert "/facts" not in plan and "/counts" in plan


def test_broken_constraints_publish_nothing(silver, load, half_year, ntz_rows):  # noqa: F811
    gold = load.gold
    before = (gold.current_folders(), rows(gold.facts()))
    keyed = resolve_keys(silver(request(7000, "2024-02-01 00:00:00")), gold.dimensions())
    broken = {
        "dangling_location_id": keyed.withColumn("location_id", F.lit(10**6).cast("long")),
        "dangling_date_id": keyed.withColumn("date_id", F.lit(10**6).cast("long")),
        "null_is_closed": keyed.withColumn("is_closed", F.lit(None).cast("boolean")),
        "duplicate_keys": keyed.union(keyed),
    }
    for problem, batch in broken.items():
        with pytest.raises(BrokenConstraint, match=problem):
            gold.upsert_facts(batch, f"bad-{problem}", AS_OF)
        assert not gold.loaded(f"bad-{problem}")
    assert (gold.current_folders(), rows(gold.facts())) == before
    assert gold.upsert_facts(keyed, "good", AS_OF) == 1
    assert checks.key_violations(gold.facts(), "facts").first().asDict() | {"table_name": ""} == {
        "table_name": "", "null_keys": 0, "duplicate_keys": 0, "null_created_date": 0, "null_is_closed": 0,
    }


def test_only_members_a_batch_refers_to_are_read(spark, silver, load):  # noqa: F811
    load(silver(*[request(i, "2024-01-01 00:00:00", borough=f"B{i}") for i in range(200)]), "a")
    batch = silver(request(900, "2024-01-05 00:00:00", borough="B7"), request(901, "2024-01-01 00:00:00", borough="new"))
    met = load.gold.dimensions_of(batch, Workspace(spark))
    assert {n: df.count() for n, df in met.items()} == {"dim_date": 2, "dim_agency": 1, "dim_complaint_type": 1, "dim_location": 2}
    stored = load.gold.dimensions()["dim_location"]
    assert stored.count() == 201
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = met_by(stored, batch.select("borough").withColumn("x", F.lit(1)), ["borough"])
        assert "LeftSemi" in plan._jdf.queryExecution().executedPlan().toString()
        want = rows(resolve_keys(batch, load.gold.dimensions()))
        assert rows(resolve_keys(batch, met)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert load(batch, "b") == 2
