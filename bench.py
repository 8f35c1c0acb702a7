"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  test set, default /root/testdata/sf0.1
BENCH_CPUS    threads, default 8
BENCH_RUNS    timed runs of each query after one warm-up, default 5 (the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmetrics import operators as op
from tripmetrics import sources
from tripmetrics.plans import adapters
from tripmetrics.plans.catalogue import QUERIES

HEADLINE = (
    "best_hour",
    "best_hour_multi_format",
    "top_drivers",
    "top_taxis_exact",
    "top_taxis_approx",
    "both_rankings",
    "both_rankings_two_tables",
    "stage_parquet",
    "run_economics",
)


def text_queries(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The questions from trip text on disk, written once outside the timing."""
    lineitem = adapters.table(spark, sf_dir, "lineitem")
    events = adapters.table(spark, sf_dir, "events")
    path = sources.scratch_path(spark, "bench-trips")
    adapters.dirty_trip_lines(lineitem).repartition(8).write.text(path)
    hours = sources.scratch_path(spark, "bench-hours")
    adapters.trip_lines(adapters.event_trips_as_text(events)).repartition(8).write.text(hours)

    def trips(where: str) -> DataFrame:
        return op.conform(
            sources.read_trips(spark, where, "lines", header=False, layout="trip17")
        )

    return {
        "text_best_hour": lambda: op.best_hour(trips(hours), "multi"),
        "text_top_drivers": lambda: op.top_drivers(trips(path)),
        "text_top_taxis": lambda: op.top_taxis(trips(path)),
        "text_run_facts": lambda: op.run_facts(trips(path)),
    }


def seconds(build: Callable[[], DataFrame]) -> float:
    """From building the query to its last row; every run plans and reads anew."""
    start = time.perf_counter()
    build().collect()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmetrics-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = {name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE}
    builds.update(text_queries(spark, sf_dir))
    medians = {}
    for name, build in builds.items():
        seconds(build)
        medians[name] = round(statistics.median(seconds(build) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "sum of the median warm times of the headline queries",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus) if cpus.isdigit() else cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
