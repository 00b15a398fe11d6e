"""Time the headline queries and print one JSON line.

Each query runs once to warm up and three times for the record (median). Rows
go to a sink that discards them, so no time is spent collecting.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hailgrid.catalog import QUERIES  # noqa: E402
from hailgrid.sources.tables import remove_scratch  # noqa: E402

HEADLINES = [
    "zone_demand",
    "dense_demand",
    "zone_hour_features",
    "baseline_metrics",
    "allocation_all_slots",
    "allocation_moves",
    "clean_trips",
    "nearest_zone",
    "alloc_scenarios",
    "demand_level",
]
RUNS = 3
#: Run once each: a model fit, and the series a second time on the next smaller scale, for the slope.
FIT = "gbt_forecast"
SLOPE = ["zone_demand", "dense_demand", "zone_hour_features", "allocation_moves"]
SMALLER = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hailgrid-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    fit = round(timed(spark, FIT, sf_dir), 3)
    smaller = SMALLER.get(os.path.basename(sf_dir.rstrip("/")))
    slope = {}
    if smaller:
        below = os.path.join(os.path.dirname(sf_dir.rstrip("/")), smaller)
        for name in SLOPE:
            timed(spark, name, below)
            slope[name] = round(statistics.median(timed(spark, name, below) for _ in range(RUNS)), 3)
    remove_scratch(spark)
    result = {
        "metric": "total_median_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "runs": RUNS,
        "fit": {FIT: fit},
        "smaller": {"sf": smaller, "queries": slope},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
