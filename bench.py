"""Times the queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line.

The stage tables are built first and reported as ``build``; the benchmark reports then run
over them, as they would in production. ``value`` is the sum of the six headline reports,
each including the transfer of its result. The other queries are run to the end without
keeping their rows. Every figure is the median of three runs in a warm session; queries that
land files or train models run once.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from civiclens.plans.catalog import QUERIES, run
from civiclens.plans.workspace import TABLES, workspace
from civiclens.session import local_session

HEADLINE = (
    "count_requests_per_service",
    "top_10_services",
    "requests_per_department",
    "requests_per_location",
    "requests_by_month",
    "join_service_department",
)
ONCE = ("ingest_append", "resumable_ingest", "aligned_append", "csv_roundtrip", "model_benchmark", "closure_regression", "incremental_dedup", "stable_keys", "incremental_fact")
RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "civiclens-bench")

    tables = workspace(spark, folder)
    build = {name: round(seconds(lambda: tables.table(name)), 3) for name in TABLES}

    def report(name: str) -> None:
        run(name, spark, folder).collect()

    def drain(name: str) -> None:
        run(name, spark, folder).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in QUERIES:
        action = report if name in HEADLINE else drain
        if name not in ONCE:
            action(name)
        runs = 1 if name in ONCE else RUNS
        timings[name] = round(statistics.median(seconds(lambda: action(name)) for _ in range(runs)), 4)

    print(
        json.dumps(
            {
                "metric": "headline_reports_total",
                "value": round(sum(timings[name] for name in HEADLINE), 4),
                "unit": "sec",
                "queries": timings,
                "build": build,
                "all_queries_total": round(sum(timings.values()), 3),
                "cpus": int(cores),
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
