"""Warehouse tables and database queries as sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.schemas import POLICY_SRC, conform


def table_source(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, restricted to the declared columns and types."""
    return conform(spark.table(name), schema)


def parquet_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def due_policies(policies: DataFrame, run_date: date) -> DataFrame:
    """Policies last updated by midnight of the run date. The bound is a literal and reaches the scan."""
    bound = F.lit(f"{run_date.isoformat()} 00:00:00").cast("timestamp_ntz")
    return policies.select(*POLICY_SRC.names).filter(F.col("updated_date") <= bound)


def jdbc_due_policies(
    spark: SparkSession,
    url: str,
    run_date: date,
    key_bounds: tuple[int, int],
    partitions: int,
    fetch_rows: int,
    table: str = "STAGING.POLICY_SRC",
    **options: str,
) -> DataFrame:
    """The same source read from a database: the predicate is evaluated there.

    The read is split over POLICY_ID ranges into ``partitions`` connections, each fetching ``fetch_rows`` rows at a time;
    rows outside the bounds and null keys still arrive, in the first and last of them.
    """
    columns = ", ".join(name.upper() for name in POLICY_SRC.names)
    query = f"SELECT {columns} FROM {table} WHERE UPDATED_DATE <= TO_DATE('{run_date.isoformat()}','YYYY-MM-DD')"
    split = {
        "dbtable": f"({query}) due",
        "partitionColumn": "POLICY_ID",
        "lowerBound": key_bounds[0],
        "upperBound": key_bounds[1],
        "numPartitions": partitions,
        "fetchsize": fetch_rows,
    }
    frame = spark.read.format("jdbc").option("url", url).options(**split, **options).load()
    return conform(frame.toDF(*[c.lower() for c in frame.columns]), POLICY_SRC)
