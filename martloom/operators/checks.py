"""Data tests on tables: absent values, repeated keys, missing parents, values outside a list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import orphans


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows checked and rows without a value. All columns are counted in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns]
    )
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("failures")) for c in columns]
    return counted.select("checked", F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("table_name"), "e.column_name", "checked", "e.failures"
    )


def duplicates(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; null keys are not compared. Counting is combined map-side."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    shown = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return (
        df.filter(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
        .select(
            F.lit(table).alias("table_name"), F.lit(",".join(columns)).alias("key_name"), shown.alias("key_value"), "rows"
        )
    )


def missing_parents(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """One row: how many key values and child rows have no parent."""
    return orphans(child, child_key, parent, parent_key).agg(
        F.lit(name).alias("relationship"),
        F.count(F.lit(1)).alias("missing_keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"),
    )


def outside_values(df: DataFrame, table: str, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values not in the list, with their row counts; null is not judged."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "failures")
    )


def not_null_all(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return _stacked([not_null(df, name, columns) for name, (df, columns) in tables.items()])


def duplicates_all(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return _stacked([duplicates(df, name, columns) for name, (df, columns) in tables.items()])
