"""Change records of the customer dimension, batch against batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import differs
from martloom.schemas import CUSTOMER_DIM_AUDIT

_TRACKED = ("spending_score", "annual_incomek")


def previous_batch(audit: DataFrame, run: RunContext) -> DataFrame:
    """One row: the largest batch id below this run's, in text order."""
    return audit.filter(F.col("batch_id") < run.batch).agg(F.max("batch_id").alias("batch_id"))


def _records(matched: DataFrame, change: Column, run: RunContext) -> DataFrame:
    current = [c for c in CUSTOMER_DIM_AUDIT.names[1:8]]
    return (
        matched.withColumn("change_type", change)
        .filter(F.col("change_type") != "NO_CHANGE")
        .select(
            run.batch.alias("batch_id"),
            *current,
            "change_type",
            run.now.alias("change_timestamp"),
            F.col("prev_spending_score").alias("previous_spending_score"),
            F.col("prev_annual_incomek").alias("previous_annual_incomek"),
        )
    )


def _aside(previous: DataFrame) -> DataFrame:
    return previous.select("customer_id", F.lit(True).alias("prev_seen"), *[F.col(c).alias(f"prev_{c}") for c in _TRACKED])


def changes_since_previous_batch(customers: DataFrame, audit: DataFrame, run: RunContext) -> DataFrame:
    """Customers that are new or changed against the rows stored by the previous batch.

    As in the reference, those rows are the previous batch's changes only, so a customer it left unchanged
    counts as new again, and a change to or from null is not seen.
    """
    # The previous batch id is one row, so broadcasting it is safe; with the audit table partitioned by
    # batch_id it also prunes the scan to that batch.
    last = F.broadcast(previous_batch(audit, run))
    matched = customers.join(_aside(audit.join(last, "batch_id")), "customer_id", "left")
    moved = F.lit(False)
    for c in _TRACKED:
        moved = moved | (F.col(c) != F.col(f"prev_{c}"))
    change = F.when(F.col("prev_seen").isNull(), "INSERT").when(moved, "UPDATE").otherwise("NO_CHANGE")
    return _records(matched, change, run)


def changes_since_last_seen(customers: DataFrame, audit: DataFrame, run: RunContext) -> DataFrame:
    """The same against each customer's latest stored row of any earlier batch, comparing null-safely."""
    latest = (
        audit.filter(F.col("batch_id") < run.batch)
        .groupBy("customer_id")
        .agg(F.max_by(F.struct(*_TRACKED), "batch_id").alias("row"))
        .select("customer_id", "row.*")
    )
    matched = customers.join(_aside(latest), "customer_id", "left")
    moved = F.lit(False)
    for c in _TRACKED:
        moved = moved | differs(c, f"prev_{c}")
    change = F.when(F.col("prev_seen").isNull(), "INSERT").when(moved, "UPDATE").otherwise("NO_CHANGE")
    return _records(matched, change, run)
