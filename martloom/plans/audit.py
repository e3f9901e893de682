"""Run audit: a row when a run starts, a row when it ends, and the latest row of each run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import date_or_null, seconds_between
from martloom.schemas import ETL_AUDIT_LOG, JOB_AUDIT_LOG, conform

# Run states.
RUNNING, SUCCESS, WITH_REJECTS, FAILED = "RUNNING", "SUCCESS", "SUCCESS_WITH_REJECTS", "FAILED"


def started_row(spark: SparkSession, run: RunContext) -> DataFrame:
    return started(spark.range(1), run)


def started(runs: DataFrame, run: RunContext) -> DataFrame:
    """Start rows. ``runs`` may give batch_id, job_name, start_time; what it lacks comes from the run."""
    defaults = {
        "batch_id": run.batch,
        "job_name": run.job,
        "start_time": run.now,
        "status": F.lit(RUNNING),
        "run_date": run.day,
        "created_at": run.now,
        "updated_at": run.now,
        **{name: F.lit(value) for name, value in run.parameters.items() if name in JOB_AUDIT_LOG.names},
    }
    lacking = {name: value for name, value in defaults.items() if name not in runs.columns}
    return conform(runs.withColumns(lacking), JOB_AUDIT_LOG)


def completed(counts: DataFrame, run: RunContext, ended: datetime) -> DataFrame:
    """End row from a one-row frame with source_count, target_inserts and reject_count."""
    end = F.lit(ended.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = counts.withColumns(
        {
            "batch_id": run.batch,
            "job_name": run.job,
            "start_time": run.now,
            "end_time": end,
            "status": F.when(F.col("reject_count") > 0, WITH_REJECTS).otherwise(SUCCESS),
            "target_updates": F.lit(0),
            "execution_duration_seconds": seconds_between(run.now, end),
            "run_date": run.day,
            "created_at": run.now,
            "updated_at": end,
            **{name: F.lit(value) for name, value in run.parameters.items() if name in JOB_AUDIT_LOG.names},
        }
    )
    return conform(rows, JOB_AUDIT_LOG)


def failed_row(spark: SparkSession, run: RunContext, ended: datetime, message: str) -> DataFrame:
    end = F.lit(ended.isoformat(sep=" ")).cast("timestamp_ntz")
    row = started_row(spark, run).withColumns(
        {
            "end_time": end,
            "status": F.lit(FAILED),
            "execution_duration_seconds": seconds_between(run.now, end),
            "error_message": F.lit(message),
            "updated_at": end,
        }
    )
    return conform(row, JOB_AUDIT_LOG)


def mart_counts(transactions: DataFrame, mart: DataFrame, rejects: DataFrame, only_day: RunContext | None = None) -> DataFrame:
    """One row with the source, target and reject counts of a mart run.

    The source count is of all transactions, or of those dated ``only_day``'s run date. The three counts come
    from three separate one-row aggregates put side by side as scalar subqueries.
    """
    counted = transactions
    if only_day is not None:
        counted = transactions.filter(date_or_null("invoice_date") == only_day.day)
    return counted.agg(F.count(F.lit(1)).alias("source_count")).select(
        "source_count",
        mart.agg(F.count(F.lit(1))).scalar().alias("target_inserts"),
        rejects.agg(F.count(F.lit(1))).scalar().alias("reject_count"),
    )


def latest_status(log: DataFrame) -> DataFrame:
    """One row per run out of the append-only log: the final row where there is one, else the start row.

    This is an aggregate that keeps one row per run and task before the shuffle, not a window.
    """
    others = [f.name for f in JOB_AUDIT_LOG if f.name not in ("batch_id", "job_name")]
    # Of rows that end at one time, the one whose text form is largest: any rule will do that always picks the same.
    finished = F.struct(
        F.coalesce(F.col("end_time"), F.col("start_time")), F.col("end_time").isNotNull(), F.to_json(F.struct(*others))
    )
    return (
        log.groupBy("batch_id", "job_name")
        .agg(F.max_by(F.struct(*others), finished).alias("row"))
        .select("batch_id", "job_name", "row.*")
        .select(*JOB_AUDIT_LOG.names)
    )


def policy_log_row(counts: DataFrame, run: RunContext, ended: datetime, status: str = SUCCESS, message: str | None = None) -> DataFrame:
    """The policy job's own, narrower audit row."""
    rows = counts.withColumns(
        {
            "job_name": run.job,
            "batch_id": run.batch,
            "start_time": run.now,
            "end_time": F.lit(ended.isoformat(sep=" ")).cast("timestamp_ntz"),
            "status": F.lit(status),
            "error_message": F.lit(message),
        }
    )
    return conform(rows, ETL_AUDIT_LOG)
