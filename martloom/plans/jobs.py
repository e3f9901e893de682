"""Whole jobs: sources in, target, rejects and audit rows out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom import schemas
from martloom.context import RunContext
from martloom.operators.numbering import next_key, number_rows
from martloom.plans import audit, customer_audit, policy_store, quality, rejects, retail, scd2
from martloom.plans.dimension_changes import dimension_changes
from martloom.sinks.delimited import write_delimited
from martloom.sinks.tables import append_rows, clustered, drop_partition, read_table, refresh_path, replace_batch
from martloom.sources.delimited import DelimitedFormat, scan_delimited
from martloom.sources.files import path_exists
from martloom.sources.tables import due_policies

_FILE_SCHEMAS = {
    "customer": schemas.CUSTOMER_DIM,
    "retail": schemas.RETAIL_DIM,
    "transactions": schemas.TRANSACTIONS_FACT,
    "product": schemas.PRODUCT_DIM,
}
# Which of the source files start with a header line.
FILE_LAYOUTS = {
    "customer": DelimitedFormat(),
    "retail": DelimitedFormat(header=True),
    "transactions": DelimitedFormat(header=True),
    "product": DelimitedFormat(header=True),
}


def counted(df: DataFrame, name: str, tallies: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted, or with other tallies taken, on the way to wherever it is written."""
    seen = Observation(name)
    return df.observe(seen, *(tallies or [F.count(F.lit(1)).alias("rows")])), seen


# --- file jobs ---------------------------------------------------------------------------------------------


def run_mart_file_job(
    spark: SparkSession, paths: Mapping[str, str], target: str, layouts: Mapping[str, DelimitedFormat] = FILE_LAYOUTS
) -> None:
    """Four delimited files to the delimited mart."""
    sources = {name: scan_delimited(spark, paths[name], _FILE_SCHEMAS[name], layouts[name]) for name in _FILE_SCHEMAS}
    write_delimited(retail.mart_from_files(sources), target, DelimitedFormat(header=True))


def run_count_file_job(spark: SparkSession, mart_path: str, target: str) -> None:
    """The mart file to the file of transaction counts."""
    layout = DelimitedFormat(header=True)
    mart = scan_delimited(spark, mart_path, schemas.RETAIL_DATA_MART, layout)
    write_delimited(retail.transaction_counts(mart), target, layout)


# --- the audited mart ----------------------------------------------------------------------------------------


def _table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def run_retail_mart(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    run: RunContext,
    clock=datetime.now,
    version: int = 3,
) -> None:
    """Load one version of the mart under ``root``, with what that version keeps about its runs.

    Version 1 logs start and end and counts the staged transactions. Versions 2 and 3 also store rejects and
    customer changes and cluster the mart; 2 counts the transactions of the run date, 3 counts all.

    Every step can be repeated: the mart is refreshed, rejects and change records of the batch are replaced, and
    audit rows and metrics are appended, of which the latest count. Row counts and the mart's declared tests are observed
    while it is written, so it is worked out once; the tests of the sources have scans of their own.
    """
    log = _table(root, "job_audit_log")
    append_rows(audit.started_row(spark, run), log, schemas.JOB_AUDIT_LOG)
    try:
        if version == 1:
            mart, counted_source = retail.mart_v1(sources), retail.staged_v1(sources)["transactions"]
        else:
            built = retail.mart_v2(sources, run) if version == 2 else retail.mart_v3(sources, run)
            everything = sources["transactions"]
            mart = clustered(built, ["invoice_date", "customer_id"], like=retail.with_integer_date(everything))
            counted_source = retail.dated_on(everything, run.run_date) if version == 2 else everything
        mart, loaded = counted(mart, "loaded", quality.mart_tallies(version))
        refresh_path(mart, _table(root, "retail_data_mart"))
        rejected_rows = 0 if version == 1 else store_rejects(spark, sources, root, run)
        totals = counted_source.agg(F.count(F.lit(1)).alias("source_count")).withColumns(
            {"target_inserts": F.lit(loaded.get["rows"]), "reject_count": F.lit(rejected_rows)}
        )
        results = quality.mart_results(spark, version, loaded.get)
        quality.store_metrics(sources, _table(root, "data_quality_metrics"), run, [results])
        append_rows(audit.completed(totals, run, clock()), log, schemas.JOB_AUDIT_LOG)
        if version > 1:
            record_customer_changes(spark, sources["customer"], root, run)
    except Exception as error:
        append_rows(audit.failed_row(spark, run, clock(), str(error)), log, schemas.JOB_AUDIT_LOG)
        raise


def store_rejects(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, run: RunContext) -> int:
    """Put this batch's rejects in place of those it may already have; returns how many there are. A rerun gives them
    the ids that they had, where their number has not grown into those of a later batch."""
    path = _table(root, "job_rejects")
    stored = read_table(spark, path, schemas.STORED_REJECTS) if path_exists(spark, path) else None
    bad, rejected = counted(rejects.with_reject_ids(rejects.retail_rejects(sources, run), stored, run), "rejected")
    replace_batch(bad, path, schemas.STORED_REJECTS)
    rows = rejected.get["rows"]
    if rows == 0:
        drop_partition(spark, path, job_name=run.job_name, batch_id=run.batch_id)
    return rows


def record_customer_changes(spark: SparkSession, customers: DataFrame, root: str, run: RunContext) -> None:
    """Add this batch's customer change records, in place of any it already has."""
    path = _table(root, "customer_dim_audit")
    if not path_exists(spark, path):
        # Creates the table, so that the first batch has an empty one to compare with.
        empty = spark.createDataFrame([], schemas.CUSTOMER_DIM_AUDIT)
        empty.write.partitionBy("batch_id").parquet(path)
    stored = read_table(spark, path, schemas.CUSTOMER_DIM_AUDIT)
    changed, seen = counted(customer_audit.changes_since_previous_batch(customers, stored, run), "changed")
    # The rows read are those of earlier batches and the rows written go to this batch's own partition.
    (
        schemas.conform(changed, schemas.CUSTOMER_DIM_AUDIT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    if seen.get["rows"] == 0:
        drop_partition(spark, path, batch_id=run.batch_id)


def record_dimension_changes(
    spark: SparkSession, old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], name: str, root: str, run: RunContext
) -> int:
    """Append what changed between two images of a dimension, with ids after the stored ones; returns how many rows."""
    path = _table(root, "dimension_audit")
    stored = read_table(spark, path, schemas.DIMENSION_AUDIT) if path_exists(spark, path) else None
    after = next_key(stored, "audit_id") if stored is not None else 0
    changes = number_rows(dimension_changes(old, new, key, columns, name, run), "audit_id", after=after)
    rows, seen = counted(changes, "changes")
    append_rows(rows, path, schemas.DIMENSION_AUDIT)
    return seen.get["rows"]


# --- the audited policy load -------------------------------------------------------------------------------------


def policy_dimension(spark: SparkSession, root: str) -> DataFrame:
    return policy_store.dimension(spark, root)


def run_policy_load(
    spark: SparkSession, policies: DataFrame, root: str, run: RunContext, log_path: str, clock=datetime.now
) -> None:
    """One Type 2 load, which reads and writes current rows of the buckets that due policies fall into only.

    Its rows are worked out once and set aside, checked, given surrogate keys, and then put in place by steps that can
    be repeated; see ``policy_store``. A load that broke off in between is completed by the next.
    """
    log = _table(root, "etl_audit_log")
    append_rows(audit.started_row(spark, run), log, schemas.ETL_AUDIT_LOG)

    def report(conflicts: DataFrame) -> str:
        path = f"{log_path.rstrip('/')}/dim_policy_conflicts_{run.run_date.isoformat()}"
        write_delimited(conflicts, path, DelimitedFormat(separator="|"))
        return path

    try:
        policy_store.complete(spark, root)
        due = due_policies(policies, run.run_date)
        scd2.check_source(due, report)
        # At most one row a bucket.
        keyed = due.filter(F.col("policy_id").isNotNull())
        counts = keyed.groupBy(policy_store.bucket_of("policy_id").alias("bucket")).count().collect()
        touched, keys = [r["bucket"] for r in counts], sum(r["count"] for r in counts)
        seen = Observation("versions")
        kinds = [F.count_if(F.col("kind") == kind).alias(kind) for kind in (scd2.ADDED, scd2.CLOSED)]
        load = f"{clock():%Y%m%d%H%M%S%f}-{run.batch_id}"
        rows = scd2.load_versions(due, policy_store.current(spark, root, touched), run, keys).observe(seen, *kinds)
        image = policy_store.set_aside(rows, root, load)
        try:
            scd2.check_versions(image, run, report)
        except scd2.PolicyLoadError:
            policy_store.drop(spark, root, load)
            raise
        added = seen.get[scd2.ADDED]
        policy_store.put(spark, root, load, run, added)

        write_delimited(
            scd2.rejects(due),
            f"{log_path.rstrip('/')}/dim_policy_rejects_{run.run_date.isoformat()}",
            DelimitedFormat(separator="|"),
        )
        totals = due.agg(F.count(F.lit(1)).alias("source_count")).withColumns(
            {"target_inserts": F.lit(added), "target_updates": F.lit(seen.get[scd2.CLOSED])}
        )
        # Success is logged of what can be seen.
        append_rows(audit.policy_log_row(totals, run, clock()), log, schemas.ETL_AUDIT_LOG)
    except Exception as error:
        append_rows(audit.failed_row(spark, run, clock(), str(error)), log, schemas.ETL_AUDIT_LOG)
        raise
