"""Default job parameters, inserted where a job does not have its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.operators.numbering import next_key, number_rows

# Name, value, type, description. The run date's value is filled in per run.
DEFAULTS = (
    ("run_date", None, "DATE", "Execution date for the job"),
    ("commit_batch", "1000", "INTEGER", "Batch size for commits"),
    ("log_path", "/tmp/dbt_logs", "STRING", "Path for log files"),
    ("source_connection", "AVA_DB.PUBLIC", "STRING", "Source database connection"),
    ("target_connection", "AVA_DB.PUBLIC", "STRING", "Target database connection"),
)
KEY = ("job_name", "parameter_name")
#: Jobs whose parameters one task makes.
JOBS_PER_TASK = 40_000


def default_parameters(jobs: DataFrame, run: RunContext) -> DataFrame:
    """The defaults for each job in ``jobs``.

    Names are few bytes, so a file of many is read in one task; they are dealt out before each becomes several wide rows,
    which that task would else hold for the next shuffle.
    """
    tasks = max(1, -(-jobs.count() // JOBS_PER_TASK))
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("parameter_name"),
                (F.date_format(run.day, "yyyy-MM-dd") if value is None else F.lit(value)).alias("parameter_value"),
                F.lit(kind).alias("parameter_type"),
                F.lit(text).alias("description"),
            )
            for name, value, kind, text in DEFAULTS
        ]
    )
    return jobs.select("job_name").repartition(tasks).select("job_name", F.explode(entries).alias("p")).select(
        "job_name",
        "p.*",
        F.lit(True).alias("is_active"),
        run.now.alias("created_at"),
        run.now.alias("updated_at"),
    )


def absent(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming parameters whose (job, name) is not stored yet; stored ones are left as they are."""
    return incoming.join(existing.select(*KEY), list(KEY), "left_anti").select(*incoming.columns)


def merged(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """The table after the insert. New parameters get ids after the largest stored one."""
    new = number_rows(absent(incoming, existing), "parameter_id", after=next_key(existing, "parameter_id"))
    columns = [c for c in existing.columns if c in new.columns]
    return existing.select(*columns).unionByName(new.select(*columns))
