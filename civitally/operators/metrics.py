"""The shared metric set: counts, percent closed, mean, exact percentiles.

Percentiles are exact. Rows are first counted per (group, hours) with an
ordinary hash aggregation, which combines map-side and spreads a hot group over
all tasks. A running sum over coarse buckets of hours then finds the few buckets
in which the wanted ranks lie; only hours inside those are ranked.

Such counts add up, so they may also be kept: every function here takes requests or
counted requests (with a column ``n``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.rounding import ratio_pct, round2

HOURS = "resolution_time_in_hours"
BUCKET_HOURS = 24

# metric: (numerator, denominator) of the percentile
PERCENTILES = {"median_resolution_hours": (1, 2), "p90_resolution_hours": (9, 10)}


COUNT = "n"


def counted(requests: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, is_closed, hours, n`` of requests, or of requests counted by finer keys."""
    size = F.sum(COUNT) if COUNT in requests.columns else F.count("*")
    return requests.groupBy(*keys, "is_closed", HOURS).agg(size.alias(COUNT))


def _scaled_rank(quantile: tuple[int, int], filled: Column) -> Column:
    """Position q*(n-1) as an exact integer, multiplied by the denominator."""
    num, _ = quantile
    return (filled - 1) * num


def _ranked(counts: DataFrame, keys: list[str], wanted: list[str]) -> DataFrame:
    """Per (group, hours), the value it contributes to the lower and upper rank of each quantile.

    Hours are first summed into coarse buckets; the buckets that hold a wanted rank (at
    most two per quantile) are found by a running sum over buckets, and only the hours
    inside them are ranked, each bucket on its own.
    """
    hours = counts.where(F.col(HOURS).isNotNull()).groupBy(*keys, HOURS).agg(F.sum("n").alias("_m"))
    hours = hours.withColumn("_bucket", F.floor(F.col(HOURS) / BUCKET_HOURS))
    buckets = hours.groupBy(*keys, "_bucket").agg(F.sum("_m").alias("_m"))
    group = Window.partitionBy(*(keys or [F.lit(1)]))  # one row per bucket of hours
    upto = F.sum("_m").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    placed = buckets.withColumns({"_before": upto - F.col("_m"), "_all": F.sum("_m").over(group)})
    ranks = {}
    for name in wanted:
        den = PERCENTILES[name][1]
        scaled = _scaled_rank(PERCENTILES[name], F.col("_all"))
        ranks[f"_{name}_lo"] = F.floor(scaled / den)
        ranks[f"_{name}_hi"] = F.ceil(scaled / den)
    end = F.col("_before") + F.col("_m") - 1
    holds = reduce(lambda a, b: a | b, [r.between(F.col("_before"), end) for r in ranks.values()])
    held = placed.where(holds).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_in"), "_before", "_all"
    )
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    inside = hours.join(held, reduce(lambda a, b: a & b, on, F.col("_bucket") == F.col("_in")))
    ordered = Window.partitionBy(*keys, "_bucket").orderBy(HOURS).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_before") + F.sum("_m").over(ordered) - 1
    ranked = inside.withColumn("_last", last)
    first = F.col("_last") - F.col("_m") + 1
    covered = {c: F.when(r.between(first, F.col("_last")), F.col(HOURS)) for c, r in ranks.items()}
    return ranked.select(*keys, "_all", *[v.alias(c) for c, v in covered.items()])


def _interpolated(name: str) -> Column:
    num_den = PERCENTILES[name]
    low, high = F.max(f"_{name}_lo"), F.max(f"_{name}_hi")
    rest = F.pmod(_scaled_rank(num_den, F.max("_all")), F.lit(num_den[1]))
    return low.cast("decimal(20,8)") + (high - low).cast("decimal(20,8)") * rest.cast(
        "decimal(3,0)"
    ) / F.lit(num_den[1]).cast("decimal(3,0)")


def request_metrics(facts: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """``metrics`` per ``keys`` of requests or counted requests; rates and hours stay decimals with two places.

    Available: total_count, closed_count, open_count, pct_closed,
    avg_resolution_hours, median_resolution_hours, p90_resolution_hours.
    """
    wanted = [m for m in metrics if m in PERCENTILES]
    if wanted or COUNT in facts.columns:
        rows = counts = counted(facts, keys) if wanted else facts
        if wanted:
            rows = counts.unionByName(_ranked(counts, keys, wanted), allowMissingColumns=True)
        n, hours_sum = F.col(COUNT), F.col(HOURS) * F.col(COUNT).cast("decimal(18,0)")
        known = {
            "total_count": F.sum(n),
            "closed_count": F.sum(F.when(F.col("is_closed"), n).when(n.isNotNull(), F.lit(0))),
            "_hours_sum": F.sum(hours_sum),
            "_hours_n": F.sum(F.when(F.col(HOURS).isNotNull(), n).when(n.isNotNull(), F.lit(0))),
        }
    else:
        rows = facts
        known = {
            "total_count": F.count("*"),
            "closed_count": F.count_if("is_closed"),
            "_hours_sum": F.sum(HOURS),
            "_hours_n": F.count(HOURS),
        }
    if not keys:  # a single row even over no rows: counts are 0, not null
        known = {c: F.coalesce(e, F.lit(0)) if c.endswith("count") else e for c, e in known.items()}
    base = rows.groupBy(*keys).agg(
        *[e.alias(c) for c, e in known.items()],
        *[round2(_interpolated(m)).alias(m) for m in wanted],
    )
    mean = F.col("_hours_sum").cast("double") / F.nullif(F.col("_hours_n"), F.lit(0))
    derived = {
        "open_count": F.col("total_count") - F.col("closed_count"),
        "pct_closed": round2(ratio_pct(F.col("closed_count"), F.col("total_count"))),
        "avg_resolution_hours": round2(mean),
    }
    return base.withColumns(derived).select(*keys, *metrics)
