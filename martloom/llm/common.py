"""Small helpers shared by the text operators."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the cluster's shared folder and read back: later steps don't recompute them, and an
    executor that is lost takes none of them with it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join that sends no rows to the driver. By the size of compressed files, which is all that is known of what
    `held` wrote, Spark would broadcast tables that take many times its threshold in memory."""
    return left.hint("merge").join(right, on, how)


def text_of(name: str = "text") -> Column:
    """A text column with null as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def model_json(model: dict) -> str:
    return json.dumps(model, sort_keys=True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node on an edge: root is the smallest node that is reachable.

    Large-star and small-star rounds: each hangs a node's larger, then its smaller neighbours on the smallest of
    them, until nothing changes. The neighbours of a node are only ever reduced to their minimum, which is combined
    before the shuffle; a hub's edges meet that minimum in a join, which adaptive execution can cut.
    """

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select("v", "u")) if large else pairs
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        hung = both.join(least, "u")
        if large:
            return hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        return moved.union(own).filter("u <> v").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = held(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before, now = None, state(pairs)
    while now != before:
        pairs = held(stars(stars(pairs, True), False), "edges")
        before, now = now, state(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
