"""Monitoring views over the audit log and the quality metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import not_older_than, percent, seconds_between


def _tally(status: str):
    return F.sum(F.when(F.col("status") == status, 1).otherwise(0))


def recent_job_executions(log: DataFrame, run_ts: datetime, days: int = 7) -> DataFrame:
    """Runs started in the last days, newest first."""
    return (
        log.filter(not_older_than("start_time", run_ts, days))
        .select(
            "batch_id",
            "job_name",
            "start_time",
            "end_time",
            seconds_between("start_time", "end_time").alias("duration_seconds"),
            "status",
            "source_count",
            "target_inserts",
            "target_updates",
            "error_message",
        )
        .orderBy(F.col("start_time").desc())
    )


def job_success_rate(log: DataFrame, run_ts: datetime, days: int = 30) -> DataFrame:
    """Runs, successes and failures per job. A run with rejects counts in the total only."""
    return (
        log.filter(not_older_than("start_time", run_ts, days))
        .groupBy("job_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            _tally("SUCCESS").alias("successful_runs"),
            _tally("FAILED").alias("failed_runs"),
        )
        .withColumn("success_rate_pct", percent(F.col("successful_runs"), F.col("total_runs")))
    )


def data_quality_summary(metrics: DataFrame, run_ts: datetime, days: int = 7) -> DataFrame:
    return (
        metrics.filter(not_older_than("check_timestamp", run_ts, days))
        .groupBy("table_name", "metric_name")
        .agg(
            F.count(F.lit(1)).alias("total_checks"),
            _tally("PASS").alias("passed_checks"),
            _tally("FAIL").alias("failed_checks"),
            _tally("WARNING").alias("warning_checks"),
            F.max("check_timestamp").alias("last_check_time"),
        )
    )


def create_views(spark: SparkSession, log: str, metrics: str, run_ts: datetime | None = None) -> None:
    """The three views as catalog objects over the stored control tables, by the names of the functions above.

    They look back from ``run_ts``, or from whenever they are queried.
    """
    now = "current_timestamp()" if run_ts is None else f"TIMESTAMP_NTZ '{run_ts.isoformat(sep=' ')}'"
    since = lambda days: f"{now} - INTERVAL {days} DAYS"
    tally = lambda status, name: f"count_if(status <=> '{status}') AS {name}"
    bodies = {
        "recent_job_executions": "SELECT batch_id, job_name, start_time, end_time, "
        "timestampdiff(SECOND, date_trunc('SECOND', start_time), date_trunc('SECOND', end_time)) AS duration_seconds, status, source_count, target_inserts, "
        f"target_updates, error_message FROM {log} WHERE start_time >= {since(7)} ORDER BY start_time DESC",
        "job_success_rate": "SELECT *, CAST(round(successful_runs * 100 / total_runs, 2) AS DECIMAL(18,2)) AS success_rate_pct "
        f"FROM (SELECT job_name, count(*) AS total_runs, {tally('SUCCESS', 'successful_runs')}, "
        f"{tally('FAILED', 'failed_runs')} FROM {log} WHERE start_time >= {since(30)} GROUP BY job_name)",
        "data_quality_summary": f"SELECT table_name, metric_name, count(*) AS total_checks, {tally('PASS', 'passed_checks')}, "
        f"{tally('FAIL', 'failed_checks')}, {tally('WARNING', 'warning_checks')}, max(check_timestamp) AS last_check_time "
        f"FROM {metrics} WHERE check_timestamp >= {since(7)} GROUP BY table_name, metric_name",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
