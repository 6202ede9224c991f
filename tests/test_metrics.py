import random
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest

from civitally.operators import checks
from civitally.operators.metrics import request_metrics
from civitally.plans import headlines, summaries, views
from civitally.plans.registry import QUERIES, _gold
from civitally.schemas import CONTRACTS
from civitally.sources import adapters as src

SF = "/root/testdata/sf0.01"
FACT_DDL = "g string, created_date timestamp_ntz, is_closed boolean, resolution_time_in_hours decimal(10,2)"


def round2(x):
    return None if x is None else float(Decimal(repr(round(x, 8))).quantize(Decimal("0.01"), "ROUND_HALF_UP"))


def test_percentiles_are_exact_on_skewed_groups(spark):
    rnd = random.Random(1)
    day = datetime(2024, 1, 1)
    groups = {"hot": 3000, "one": 1, "two": 2, "open": 0, "odd": 37}
    rows, values = [], {}
    for g, n in groups.items():
        values[g] = [round(rnd.choice([rnd.uniform(-5, 90), 7.25]), 2) for _ in range(n)]
        rows += [(g, day, True, Decimal(str(v))) for v in values[g]] + [(g, day, False, None)] * 2
    metrics = ["total_count", "closed_count", "open_count", "avg_resolution_hours", "median_resolution_hours", "p90_resolution_hours"]
    got = request_metrics(spark.createDataFrame(rows, FACT_DDL), ["g"], metrics)
    for r in got.collect():
        v = values[r["g"]]
        assert (r["total_count"], r["closed_count"], r["open_count"]) == (len(v) + 2, len(v), 2)
        want = [None] * 3 if not v else [np.mean(v), np.quantile(v, 0.5), np.quantile(v, 0.9)]
        got3 = [None if r[m] is None else float(r[m]) for m in metrics[3:]]
        assert got3 == [round2(None if x is None else float(x)) for x in want]


def test_one_row_over_no_rows(spark):
    empty = spark.createDataFrame([], FACT_DDL)
    row = views.requests_7d(empty, datetime(2024, 1, 8)).first()
    assert (row["total_count"], row["closed_count"], row["open_count"]) == (0, 0, 0)
    assert row["pct_closed"] is None and row["p90_resolution_hours"] is None
    weekly = summaries.weekly_summary(empty, datetime(2024, 1, 8)).first()
    assert all(v is None for v in weekly)
    assert list(views.backlog_aging(empty, datetime(2024, 1, 8)).first()) == [None] * 4
    line = headlines.overview_headline(
        summaries.daily_30d_summary(empty, datetime(2024, 1, 8)),
        summaries.weekly_summary(empty, datetime(2024, 1, 8)),
    ).first()
    assert line["total_7d"] == 0 and line["latest_day_total"] == 0 and line["requests_trend"] == "flat"


def test_partial_first_day_is_excluded(spark, ntz_rows):
    rows = [("g", "2024-01-01 18:00:00", False), ("g", "2024-01-02 00:00:00", False)]
    facts = ntz_rows(rows, "g string, created_date string, is_closed boolean", "created_date").selectExpr(
        "*", "cast(null as decimal(10,2)) resolution_time_in_hours"
    )
    as_of = datetime(2024, 1, 31, 12)
    assert [str(r[0]) for r in summaries.daily_30d_summary(facts, as_of).collect()] == ["2024-01-02"]
    assert views.requests_30d(facts, as_of).first()["total_count"] == 2


def test_known_answers(spark):
    gold_a, gold_b = _gold(spark, SF, "history"), _gold(spark, SF, "dense")
    assert views.requests_daily(gold_a.facts()).count() == 2399
    assert views.requests_daily(gold_b.facts()).count() == 30
    assert list(views.backlog_aging(gold_a.facts(), src.HISTORY_AS_OF).first()) == [14, 44, 122, 4799]
    assert list(views.backlog_aging(gold_b.facts(), src.DENSE_AS_OF).first()) == [626, 1874, 0, 0]
    week = summaries.weekly_summary(gold_b.facts(), src.DENSE_AS_OF).first()
    assert [str(week[0]), *list(week)[1:]] == [
        "2024-01-24", 2331, 1749, 75.03, 13.72, 2349, 1761, -0.77, -0.68, 14.22, -3.52,
    ]
    week = summaries.weekly_summary(gold_a.facts(), src.HISTORY_AS_OF).first()
    assert [str(week[0]), *list(week)[1:5]] == ["2001-07-27", 44, 32, 72.73, 276.13]


def test_invariants(spark):
    gold = _gold(spark, SF, "history")
    facts = gold.facts()
    daily = views.requests_daily(facts).selectExpr("sum(total_count) t", "sum(closed_count) c", "sum(open_count) o").first()
    assert daily["c"] + daily["o"] == daily["t"]
    assert sum(views.backlog_aging(facts, src.HISTORY_AS_OF).first()) == daily["o"]
    for name in ("borough", "complaint_type", "agency", "day_of_week"):
        total = QUERIES[f"requests_by_{name}"](spark, SF).selectExpr("sum(total_count)").first()[0]
        assert total <= daily["t"] and (total == daily["t"]) == (name != "agency")


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_contracts(spark, name):
    df = QUERIES[name](spark, SF)
    assert checks.contract_problems(name, df) == []
    assert checks.contract_nulls(name, df).isEmpty()


def test_views_are_registered_and_readable(spark):
    names = views.register_views(_gold(spark, SF, "history"), src.HISTORY_AS_OF)
    assert len(names) == 8
    assert spark.sql("select total_count from v_requests_by_borough").count() == 5
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert spark.table("v_requests_daily").selectExpr("sum(total_count)").first()[0] == orders


def test_window_filter_reaches_the_scan(spark):
    """Months outside the window are not listed; the timestamp bound reaches the row groups."""
    facts = _gold(spark, SF, "history").facts()
    plan = views.requests_7d(facts, src.HISTORY_AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "created_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(created_date" in plan
    assert "latitude" not in plan
