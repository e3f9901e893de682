"""Rejected rows as records of what was wrong with which row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import as_object
from martloom.operators.numbering import next_key, number_rows
from martloom.plans.validation import SourceRules, source_rules
from martloom.schemas import JOB_REJECTS


def record(df: DataFrame, rules: SourceRules, run: RunContext, description: Column) -> DataFrame:
    """Rows already known to be bad, as reject records with the given description."""
    return df.select(
        run.batch.alias("batch_id"),
        run.job.alias("job_name"),
        run.now.alias("reject_time"),
        F.lit(rules.table).alias("source_table"),
        F.col(rules.key).cast("string").alias("primary_key_value"),
        description.alias("error_description"),
        as_object(rules.columns).alias("raw_data"),
    )


def rejects_of(df: DataFrame, rules: SourceRules, run: RunContext) -> DataFrame:
    """Reject records of one source, from the rules' own ``broken`` conditions."""
    return record(df.filter(rules.rejected()), rules, run, rules.status())


def retail_rejects(sources: Mapping[str, DataFrame], run: RunContext) -> DataFrame:
    """Reject records of all four sources. Breaking a rule and not being VALID are the same, so the lenient and the
    strict mart share them."""
    rules = source_rules()
    parts = [rejects_of(sources[name], rules[name], run) for name in ("customer", "retail", "transactions", "product")]
    return reduce(DataFrame.unionByName, parts).select(*JOB_REJECTS.names)


def with_reject_ids(rejects: DataFrame, stored: DataFrame | None = None, run: RunContext | None = None) -> DataFrame:
    """Reject records with consecutive ids and their creation time, for a table that keeps them.

    ``stored`` is that table. Ids start where those of the run's batch start, if it is stored and its new records have
    room there, else after the largest of other batches. Equal records get ids of their own. Ids depend on the records and
    the stored ids alone, so a rerun gives the same ones, whatever batches came in between.
    """
    numbered = number_rows(rejects, "reject_id")
    if stored is None:
        return numbered.withColumn("created_at", F.col("reject_time"))
    own = F.lit(False) if run is None else (F.col("job_name") == run.job) & (F.col("batch_id") == run.batch)
    first = stored.agg(F.min(F.when(own, F.col("reject_id"))).alias("first"))
    ids = stored.filter(~own)
    # The next id that another batch has after this batch's first.
    after_own = ids.filter(F.col("reject_id") > first.scalar()).agg(F.min("reject_id"))
    room = F.coalesce(after_own.scalar(), F.lit(2**62)) - first.scalar()
    fits = F.coalesce(numbered.agg(F.max("reject_id")).scalar() <= room, F.lit(False))
    base = F.when(fits, first.scalar() - 1).otherwise(next_key(ids, "reject_id"))
    return numbered.withColumn("reject_id", F.col("reject_id") + base).withColumn("created_at", F.col("reject_time"))
