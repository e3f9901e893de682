"""Queries by key, each with the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so that two engines' clients show them alike."""
    return df.select(
        *[
            F.col(name).cast("string").alias(name)
            if kind == "date"
            else F.col(name).cast("double").alias(name)
            if kind.startswith("decimal")
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )
