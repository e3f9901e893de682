"""Times the headline queries: each is planned and run to the end once to warm up, then a few times for the median.

Results go to Spark's no-op sink, so every row and column is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from martloom.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "mart_v1 mart_v2 mart_v3 mart_clustered_write mart_file_job count_transactions rejects_all rejects_v2 "
    "validate_transactions customer_audit_changes policy_changes policy_dimension surrogate_key dq_not_null "
    "dq_relationships agg_summary agg_resummarize agg_dispersion join_full dimension_changes "
    "job_audit_completed recent_job_executions job_success_rate scan_reject_continue scan_record_number sink_by_key"
).split()


def timed(spark: SparkSession, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("martloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Do not record the Python call site of every expression: it takes longer than building the plan itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    if names == ["all"]:
        names = sorted(QUERIES)
    # The first queries would otherwise carry the session's start-up.
    for name in names[:3]:
        timed(spark, name)
    results: dict[str, float] = {}
    for name in names:
        timed(spark, name)
        results[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
