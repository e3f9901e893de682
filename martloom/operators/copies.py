"""Equal rows, packed into one row and unpacked again, so that a huge group of copies never meets one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES_PER_CHUNK = 100_000


def collapse_copies(df: DataFrame, chunk: int = COPIES_PER_CHUNK) -> DataFrame:
    """One row per distinct row and chunk of at most ``chunk`` copies, with ``_chunk`` and ``_copies``.

    The copies are counted map-side before the shuffle. Chunks are numbered from the count alone, so the result
    is the same when a task is run again.
    """
    packed = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_total"))
    chunks = F.sequence(F.lit(0).cast("bigint"), ((F.col("_total") - 1) / chunk).cast("bigint"))
    return (
        packed.withColumn("_chunk", F.explode(chunks))
        .withColumn("_copies", F.least(F.lit(chunk), F.col("_total") - F.col("_chunk") * chunk).cast("bigint"))
        .drop("_total")
    )


def copy_numbers() -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)


def expand_copies(packed: DataFrame) -> DataFrame:
    return packed.withColumn("_copy", F.explode(copy_numbers())).drop("_chunk", "_copies", "_copy")
