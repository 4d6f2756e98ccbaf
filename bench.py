"""Time the model and its headline reports; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the inputs and the number of cores. The first, untimed build
warms up the JVM; every timed query then starts from the raw tables or, for reports, from the mart
of the timed build.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlens.demo import inputs, queries  # noqa: E402

# Steps of a full build; the first one runs both rollups.
BUILD_STEPS = ("profile_with_facts", "peer_group_stats", "mart")
REPORTS = (
    "outlier_mart",
    "overview_kpis",
    "state_aggregates",
    "peer_group_diagnostics",
    "top_outliers",
    "top_n_per_metric",
    "demo_providers",
    "peer_distribution",
    "brand_share_opportunity",
    "brand_switch_targets",
    "dq_not_null",
    "extract_reconciliation",
)
FROM_RAW = ("stg_part_d", "distinct_counts", "dominant_attr", "order_line_median", "latest_per_key", "daily_usage")


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm = inputs.new_build(spark, sf_dir)
    run_all(warm.mart)
    warm.workspace.drop()

    times = {}
    started = time.perf_counter()
    model = inputs.build(spark, sf_dir)
    for step in BUILD_STEPS:
        times[f"build_{step}"] = timed(lambda step=step: getattr(model, step))
    total = round(time.perf_counter() - started, 3)
    times["full_build"] = total
    for name in (*REPORTS, *FROM_RAW):
        times[name] = timed(lambda name=name: run_all(queries.REGISTERED[name](spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "full build of the scored mart from raw tables",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
