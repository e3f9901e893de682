"""Surrogate keys without a global sort or a one-partition window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.copies import collapse_copies, copy_numbers
from martloom.workspace import scratch_path

KEYS_PER_BUCKET = 1_000_000
ROWS_PER_BUCKET = 200_000


def _starts(counts: DataFrame) -> DataFrame:
    """Rows in earlier buckets, per bucket. The input has one row per bucket, never one per data row."""
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def next_key(df: DataFrame, key: str) -> Column:
    """The largest key in ``df`` as a scalar subquery, 0 for none."""
    return F.coalesce(df.agg(F.max(key).alias("k")).scalar(), F.lit(0))


def number_by_key(df: DataFrame, key: str, name: str, after: Column | int = 0) -> DataFrame:
    """Consecutive numbers in the order of a unique integer key.

    Keys are cut into value ranges of KEYS_PER_BUCKET. As the key is unique, a range cannot hold more rows than
    that, however the keys lie; a 12-digit key has at most a million ranges. Numbers depend on the data alone,
    so a task that is run again assigns the same ones.
    """
    base = after if isinstance(after, Column) else F.lit(after)
    # The range is named by its lowest key. Integer arithmetic, as doubles would blur keys beyond 2^53.
    wide = F.col(key).cast("bigint")
    bucketed = df.withColumn("_bucket", wide - F.pmod(wide, F.lit(KEYS_PER_BUCKET)))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_place", place)
        .join(_starts(counts), "_bucket")
        .withColumn(name, (base + F.col("_before") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_place", "_before")
    )


def number_rows(df: DataFrame, name: str, after: Column | int = 0, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Consecutive numbers for arbitrary rows, in no particular order.

    The rows are written once, so that counting and numbering don't each work them out. They are bucketed by a hash of
    all their columns, so no column's skew matters, and there are as many buckets as their number asks for; equal
    rows are packed first, and unpacked after each pack has its own range of numbers.
    """
    path = scratch_path(df.sparkSession, "to-number")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    buckets = max(1, -(-df.count() // rows_per_bucket))
    base = after if isinstance(after, Column) else F.lit(after)
    order = [c for c in df.columns]
    packed = collapse_copies(df).withColumn(
        "_bucket", F.pmod(F.xxhash64(*df.columns, F.col("_chunk")), F.lit(buckets))
    )
    counts = packed.groupBy("_bucket").agg(F.sum("_copies").alias("_rows"))
    inside = Window.partitionBy("_bucket").orderBy(*order, "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = packed.withColumn("_place", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    return (
        placed.join(_starts(counts), "_bucket")
        .withColumn("_copy", F.explode(copy_numbers()))
        .withColumn(name, (base + F.col("_before") + F.col("_place") + F.col("_copy") + 1).cast("bigint"))
        .select(*df.columns, name)
    )
