"""Path questions answered by the file system, before any row is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _status(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.globStatus(location) or []


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths or patterns that match something."""
    return [path for path in paths if len(_status(spark, path)[1]) > 0]


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def delete_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
