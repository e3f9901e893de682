"""The Type 2 policy load."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.catalog import sqltext as S
from martloom.catalog.registry import comparable, register
from martloom.plans import scd2
from martloom.samples import tables as T
from martloom.samples.sql import POLICY_RUN_DATE, with_tables
from martloom.schemas import POLICY_REJECTS
from martloom.sinks.delimited import write_delimited
from martloom.sources.delimited import DelimitedFormat, scan_delimited
from martloom.sources.tables import due_policies
from martloom.workspace import scratch_path

_BOTH = "policy_src dim_policy"
_FLAGS = (
    "SELECT policy_id, policy_holder_name, policy_type, CAST(premium_amount AS DOUBLE) AS premium_amount, "
    "CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, updated_date, source_system, "
    "matched, attr_changed, NOT matched AS new_record, matched AND attr_changed AS changed, "
    "matched AND NOT attr_changed AS unchanged, policy_id IS NOT NULL AS valid, "
    "CAST(CASE WHEN matched THEN lk_version_no + 1 ELSE 1 END AS INTEGER) AS out_version_no FROM paired"
)


def _due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return due_policies(T.policy_src(spark, sf_dir), T.POLICY_RUN_DATE)


@register(
    "policy_source",
    with_tables(
        "policy_src",
        "SELECT policy_id, policy_holder_name, policy_type, CAST(premium_amount AS DOUBLE) AS premium_amount, "
        "CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, updated_date, "
        f"source_system FROM policy_src WHERE updated_date <= {POLICY_RUN_DATE}",
    ),
)
def policy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_due(spark, sf_dir))


@register(
    "policy_changes",
    with_tables(
        _BOTH,
        S.POLICY_CTES + _FLAGS,
    ),
)
def policy_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(scd2.classify(_due(spark, sf_dir), T.dim_policy(spark, sf_dir)))


_MONTH = timedelta(days=30)


@register(
    "policy_month_changes",
    with_tables(
        _BOTH,
        S.POLICY_CTES.replace(
            f"updated_date <= {POLICY_RUN_DATE}",
            f"updated_date <= {POLICY_RUN_DATE} AND updated_date > {POLICY_RUN_DATE} - {_MONTH.days}",
        )
        + _FLAGS,
    ),
)
def policy_month_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of the last month's policies: a small source, for which a Bloom filter narrows the dimension."""
    since = F.lit(f"{(T.POLICY_RUN_DATE - _MONTH).isoformat()} 00:00:00").cast("timestamp_ntz")
    due = _due(spark, sf_dir).filter(F.col("updated_date") > since)
    return comparable(scd2.classify(due, scd2.lookup(due, T.dim_policy(spark, sf_dir), due.count())))


@register(
    "policy_inserts",
    with_tables(
        _BOTH,
        S.POLICY_CTES
        + S.INSERTS_CTE
        + f"SELECT {S.DIM_TEXT.replace('policy_key, ', '', 1)} FROM added",
    ),
)
def policy_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(scd2.inserts(_due(spark, sf_dir), T.dim_policy(spark, sf_dir), T.POLICY_RUN))


@register(
    "surrogate_key",
    with_tables(_BOTH, S.POLICY_CTES + S.INSERTS_CTE + "SELECT policy_key, policy_id, version_no FROM keyed"),
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = T.dim_policy(spark, sf_dir)
    added = scd2.inserts(_due(spark, sf_dir), dimension, T.POLICY_RUN)
    return scd2.with_keys(added, dimension).select("policy_key", "policy_id", "version_no")


@register(
    "policy_expired",
    with_tables(_BOTH, S.POLICY_CTES + S.INSERTS_CTE + f"SELECT {S.DIM_TEXT} FROM closed"),
)
def policy_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(scd2.expired(_due(spark, sf_dir), T.dim_policy(spark, sf_dir), T.POLICY_RUN))


@register(
    "policy_dimension",
    with_tables(
        _BOTH,
        S.POLICY_CTES
        + S.INSERTS_CTE
        + f"SELECT {S.DIM_TEXT} FROM dim_policy WHERE current_flag = 'N' "
        f"UNION ALL SELECT {S.DIM_TEXT} FROM cur WHERE policy_id NOT IN (SELECT policy_id FROM closed) "
        f"UNION ALL SELECT {S.DIM_TEXT} FROM closed UNION ALL SELECT {S.DIM_TEXT} FROM keyed",
    ),
)
def policy_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(scd2.full_image(_due(spark, sf_dir), T.dim_policy(spark, sf_dir), T.POLICY_RUN))


@register(
    "policy_rejects",
    with_tables(
        "policy_src",
        "SELECT '' AS policy_id, 'POLICY_ID is NULL' AS error_desc, "
        + S.json_object(
            "policy_id policy_holder_name policy_type premium_amount start_date end_date".split()
        ).replace(" || '}'", "")
        + """ || ',"updated_date":"' || strftime(updated_date, '%Y-%m-%dT%H:%M:%S.000') || '",'"""
        + """ || '"source_system":"' || source_system || '"}' AS raw_data """
        + f"FROM policy_src WHERE updated_date <= {POLICY_RUN_DATE} AND policy_id IS NULL",
    ),
)
def policy_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as the pipe-delimited reject file whose path carries the run date, and read back."""
    layout = DelimitedFormat(separator="|")
    rows = scd2.rejects(_due(spark, sf_dir))
    path = f"{scratch_path(spark, 'rejects')}/dim_policy_rejects_{T.POLICY_RUN_DATE.isoformat()}"
    write_delimited(rows, path, layout)
    return scan_delimited(spark, path, POLICY_REJECTS, layout)


@register(
    "policy_audit_counts",
    with_tables(
        _BOTH,
        S.POLICY_CTES
        + "SELECT count(*) AS source_count, "
        "count(*) FILTER (WHERE policy_id IS NOT NULL AND (NOT matched OR attr_changed)) AS target_inserts, "
        "count(*) FILTER (WHERE policy_id IS NOT NULL AND matched AND attr_changed) AS target_updates, "
        "count(*) FILTER (WHERE policy_id IS NULL) AS reject_count, "
        "count(*) FILTER (WHERE policy_id IS NOT NULL AND matched AND NOT attr_changed) AS unchanged_count FROM paired",
    ),
)
def policy_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.audit_counts(_due(spark, sf_dir), T.dim_policy(spark, sf_dir))
