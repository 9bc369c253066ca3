"""Time the headline queries. Prints one JSON line.

Each query runs once to warm up and three times for the median; results are
forced with a ``noop`` write. Queries on stage tables (curated sales, features,
order table) read tables that are built once; the builds are timed by
``order_plan``, ``curate_sales`` and ``build_features``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from demandkit.plans import tables as t
from demandkit.plans.queries import QUERIES
from demandkit.plans.stages import curate_sales, prepare_features
from demandkit.runtime import local_session

HEADLINE = (
    "order_plan",
    "sales_grain",
    "future_days",
    "date_dimension",
    "sales_with_calendar",
    "weather_daily",
    "split_sizes",
    "features_day_aggs",
    "text_features",
    "haversine_miles",
    "rolling7",
    "lag_year",
    "invoice_join",
    "panel_sales",
    "batch_windows",
    "forecast_for_store",
    "dashboard_kpis",
    "table_search_page",
    "dup_keys",
    "baseline_metrics",
)


def curate(spark, sf):
    return curate_sales(t.sales_lines(spark, sf)).sales


def features(spark, sf):
    curated = t.Stages(spark, sf).curated().sales
    return prepare_features(
        curated, t.stores(spark, sf), t.STATES, {"orders": t.order_entity(spark, sf)}
    ).features


def seconds(run, spark, sf) -> float:
    begin = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: QUERIES[name] for name in HEADLINE} | {"curate_sales": curate, "build_features": features}
    times = {}
    for name, run in runs.items():
        if only and name not in only:
            continue
        seconds(run, spark, sf)
        times[name] = round(statistics.median(seconds(run, spark, sf) for _ in range(repeats)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
