"""Wall time of the headline queries; prints one JSON line.

Batch jobs and streams run once, as their cost is starting Spark jobs; queries run
once to warm up and are then timed three times (median). Results go to Spark's noop
sink, so every row is produced and none is brought to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from civitally.plans.registry import QUERIES
from civitally.workspace import local_session

# whole batch jobs and streams; everything else is a query over tables already built
JOBS = [
    "backfill_extract",
    "bronze_roundtrip",
    "clean_requests",
    "clean_by_page",
    "imputation_stats",
    "silver_requests",
    "silver_by_page",
    "silver_mixed_headers",
    "gold_load",
    "late_closure_upsert",
    "load_folds_repeats",
    "stream_upsert",
    "stream_catch_up",
    "stream_fills",
]
HEADLINE = [name for name in QUERIES if name not in JOBS]
# seconds after which the remaining queries are timed once instead of three times
SOFT_LIMIT = 400


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    results = {}
    began = time.perf_counter()
    for name in HEADLINE + JOBS:
        first = timed(spark, name, sf_dir)
        late = time.perf_counter() - began > SOFT_LIMIT
        runs = [first] if name in JOBS or late else [timed(spark, name, sf_dir) for _ in range(3)]
        results[name] = round(statistics.median(runs), 3)
    total = round(sum(results.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_wall_time", "value": total, "unit": "sec", "queries": results, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
