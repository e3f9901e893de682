"""One frozen description of a run, so every row written by it carries the same ids and times."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Job names and default run parameters.
RETAIL_JOB = "RETAIL_DATA_MART_Job"
POLICY_JOB = "SCD2_DIM_POLICY"
COUNT_JOB = "Count_Customer_Transactions_Job"
DEFAULT_PARAMETERS = {
    "source_connection": "AVA_DB.PUBLIC",
    "target_connection": "AVA_DB.PUBLIC",
    "log_path": "/logs/dbt/retail_data_mart",
}


def batch_id_for(moment: datetime) -> str:
    return moment.strftime("BATCH_%Y%m%d%H%M%S")


@dataclass(frozen=True)
class RunContext:
    """Identity and clock of one run. ``run_ts`` stands in for the current time everywhere."""

    job_name: str
    run_ts: datetime
    run_date: date
    batch_id: str
    parameters: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_PARAMETERS))

    @classmethod
    def start(
        cls,
        job_name: str,
        run_ts: datetime | None = None,
        run_date: date | None = None,
        batch_id: str | None = None,
        **parameters: str,
    ) -> "RunContext":
        moment = run_ts or datetime.now().replace(microsecond=0)
        return cls(
            job_name=job_name,
            run_ts=moment,
            run_date=run_date or moment.date(),
            batch_id=batch_id or batch_id_for(moment),
            parameters={**DEFAULT_PARAMETERS, **parameters},
        )

    def with_job(self, job_name: str) -> "RunContext":
        return replace(self, job_name=job_name)

    @property
    def batch(self) -> Column:
        return F.lit(self.batch_id)

    @property
    def job(self) -> Column:
        return F.lit(self.job_name)

    @property
    def now(self) -> Column:
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def day(self) -> Column:
        return F.lit(self.run_date)
