"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` how often each query runs (the best time counts). Small results
are collected; row-level results go to Spark's ``noop`` sink, which computes
every column of every row without the cost of moving them to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

from skyledger.plans.training import train_and_evaluate, training_table
from skyledger.registry import registered_queries
from skyledger.registry.queries import model_input
from skyledger.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

COLLECTED = (
    "busiest_airports",
    "avg_arr_delay_by_carrier",
    "avg_arr_delay_by_dow",
    "top_carriers_by_origin",
    "top_destinations_by_origin",
    "all_questions",
    "train_test_split_counts",
    "classification_metrics",
    "roc_auc",
    "category_codes",
    "day_file_manifest",
    "stream_delay_by_carrier",
    "zip_ingest_status",
)
ROW_LEVEL = ("flight_records", "delay_features", "ml_feature_rows", "csv_clean_roundtrip", "json_roundtrip")


def boosted_trees(spark, sf_dir):
    """Five trees of depth 6, fitted and evaluated."""
    return train_and_evaluate(training_table(model_input(spark, sf_dir)), trees=5).metrics


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/nation.parquet").collect()
    jobs = registered_queries()
    plan = [(name, jobs[name], True) for name in COLLECTED]
    plan += [(name, jobs[name], False) for name in ROW_LEVEL]
    plan.append(("boosted_trees_5", boosted_trees, True))
    times = {}
    for name, job, collected in plan:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            df = job(spark, SF_DIR)
            if collected:
                df.collect()
            else:
                df.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
