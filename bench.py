"""Headline queries and the full run at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from quotaflow.plans import checked
from quotaflow.plans.checked.storage import source_files
from quotaflow.plans.full_run import run

HEADLINES = {
    "profile": "q6_null_profile",
    "clean": "t1_clean_fill",
    "star": "t3_star_local",
    "customer_view_relative": "t5_customer_view_relative",
    "customer_view_absolute": "t6_customer_view_absolute",
    "targets": "t7_allocate_local",
    "reconcile": "a5_reconcile_local",
    "brand_scorecard": "a18_brand_scorecard",
    "by_state": "a22_by_state",
    "by_city": "a24_by_city",
    "rfm_segment": "k12_rfm_segment",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    began = time.perf_counter()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The cost of the first read is the session's, not a query's.
    checked.QUERIES["p15_targets_for_year"](spark, sf_dir).count()
    seconds = {"session_start": round(time.perf_counter() - began, 3)}
    for name, key in HEADLINES.items():
        start = time.perf_counter()
        checked.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    # Files in, files out: the source files are made beforehand.
    config = source_files(spark, sf_dir, "bench")
    start = time.perf_counter()
    run(spark, config)
    seconds["full_run"] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
