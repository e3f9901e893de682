"""Generic change log between two images of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import any_of, as_object, differs


def dimension_changes(
    old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], name: str, run: RunContext, changed_by: str = "etl"
) -> DataFrame:
    """INSERT, UPDATE and DELETE records with the old and new row as objects. ``key`` is unique in both images.

    Rows are compared column by column; objects are built only for the rows that differ.
    """
    sides = [
        df.filter(F.col(key).isNotNull()).select(F.col(key), F.lit(True).alias(p + "in"), *[F.col(c).alias(p + c) for c in columns])
        for df, p in ((old, "old_"), (new, "new_"))
    ]
    both = sides[0].join(sides[1], key, "full")
    change = (
        F.when(F.col("old_in").isNull(), "INSERT")
        .when(F.col("new_in").isNull(), "DELETE")
        .when(any_of(differs("old_" + c, "new_" + c) for c in columns), "UPDATE")
    )
    return (
        both.withColumn("change_type", change)
        .filter(F.col("change_type").isNotNull())
        .select(
            F.lit(name).alias("dimension_name"),
            F.col(key).cast("string").alias("record_key"),
            "change_type",
            run.now.alias("change_timestamp"),
            run.batch.alias("batch_id"),
            F.when(F.col("old_in").isNotNull(), as_object(columns, "old_")).alias("old_values"),
            F.when(F.col("new_in").isNotNull(), as_object(columns, "new_")).alias("new_values"),
            F.lit(changed_by).alias("changed_by"),
            run.now.alias("created_at"),
        )
    )
