"""The policy dimension on disk: current rows by bucket of policy, closed rows by the load that closed them.

``dim_policy/current`` is partitioned by a hash bucket of the policy, so that a load reads and replaces only the buckets
it touches. ``dim_policy/closed`` gets one folder a load, which nothing reads or rewrites afterwards but history queries.

A load sets its rows aside first. Its entry `ready`, with the largest surrogate key in use from then on, is the point of no
return; putting the rows in place replaces whole folders and partitions by what was set aside, so it can be done again by
whoever finds a load without the entry `done`. Surrogate keys come from these entries, not from the dimension.
One load runs at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.context import RunContext
from martloom.plans import scd2
from martloom.schemas import DIM_POLICY, POLICY_LOADS, POLICY_VERSIONS
from martloom.sinks.tables import append_rows, read_table, refresh_path
from martloom.sources.files import delete_path, path_exists

#: Buckets of the current rows. A table keeps the number it began with.
BUCKETS = 256
READY, DONE = "ready", "done"
_STORED = T.StructType([*DIM_POLICY, T.StructField("bucket", T.IntegerType())])


def _folder(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), "dim_policy", *parts])


def _loads(root: str) -> str:
    return f"{root.rstrip('/')}/dim_policy_loads"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(BUCKETS)).cast("int")


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_POLICY)


def current(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """Current rows, of all buckets or of the given ones, whose folders alone are read."""
    path = _folder(root, "current")
    if not path_exists(spark, path):
        return _none(spark)
    rows = spark.read.schema(_STORED).parquet(path)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows.select(*DIM_POLICY.names)


def closed(spark: SparkSession, root: str) -> DataFrame:
    path = _folder(root, "closed")
    if not path_exists(spark, path):
        return _none(spark)
    return spark.read.schema(DIM_POLICY).parquet(path).select(*DIM_POLICY.names)


def dimension(spark: SparkSession, root: str) -> DataFrame:
    return current(spark, root).unionByName(closed(spark, root))


def set_aside(rows: DataFrame, root: str, load: str) -> DataFrame:
    """The rows of ``scd2.load_versions``, written once for checks, keys and placement."""
    path = _folder(root, "aside", load)
    rows.write.partitionBy("kind").parquet(path)
    return _aside(rows.sparkSession, root, load)


def _aside(spark: SparkSession, root: str, load: str) -> DataFrame:
    return spark.read.schema(POLICY_VERSIONS).parquet(_folder(root, "aside", load))


def drop(spark: SparkSession, root: str, load: str) -> None:
    delete_path(spark, _folder(root, "aside", load))


def last_key(spark: SparkSession, root: str) -> int:
    """The largest surrogate key that a load has used or may still use."""
    if not path_exists(spark, _loads(root)):
        return 0
    return read_table(spark, _loads(root), POLICY_LOADS).agg(F.max("last_key")).first()[0] or 0


def put(spark: SparkSession, root: str, load: str, run: RunContext, added: int) -> None:
    """Make the rows set aside the dimension's. added: how many of them still get surrogate keys."""
    before = last_key(spark, root)
    entry = spark.range(1).select(F.lit(load).alias("load"), run.batch.alias("batch_id"), run.now.alias("loaded_at"))
    ready = entry.withColumns({"state": F.lit(READY), "last_key": F.lit(before + added).cast("bigint")})
    append_rows(ready, _loads(root), POLICY_LOADS)
    _place(spark, root, load, before)


def _place(spark: SparkSession, root: str, load: str, before: int) -> None:
    image = _aside(spark, root, load)
    refresh_path(image.filter(F.col("kind") == scd2.CLOSED).select(*DIM_POLICY.names), _folder(root, "closed", f"load={load}"))
    kept = image.filter(F.col("kind") == scd2.KEPT).select(*DIM_POLICY.names)
    added = scd2.keyed_after(image.filter(F.col("kind") == scd2.ADDED).drop("policy_key", "kind"), before)
    rows = kept.unionByName(added).withColumn("bucket", bucket_of("policy_id"))
    # The rows come from elsewhere, so nothing read is replaced; buckets without rows here stay as they are.
    (
        rows.hint("rebalance", F.col("bucket"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(_folder(root, "current"))
    )
    done = read_table(spark, _loads(root), POLICY_LOADS).filter(F.col("load") == load).limit(1)
    append_rows(done.withColumn("state", F.lit(DONE)), _loads(root), POLICY_LOADS)
    drop(spark, root, load)


def complete(spark: SparkSession, root: str) -> None:
    """Put in place the rows of a load that broke off after its entry `ready`."""
    if not path_exists(spark, _loads(root)):
        return
    entries = read_table(spark, _loads(root), POLICY_LOADS)
    # Loads follow one another, so at most the last one is open.
    states = entries.groupBy("load").agg(F.max(F.col("state") == DONE).alias("done"), F.max("last_key").alias("last_key"))
    left = states.filter(~F.col("done")).select("load", "last_key").take(1)
    for row in left:
        added = _aside(spark, root, row["load"]).filter(F.col("kind") == scd2.ADDED).count()
        _place(spark, root, row["load"], row["last_key"] - added)
