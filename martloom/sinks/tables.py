"""Parquet and catalog tables: full refresh, clustered layout, append, replacement of one batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.copies import collapse_copies, expand_copies
from martloom.schemas import conform


def refresh_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table's content."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def refresh_path(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


#: Quantiles of the second key, by which the rows of a hot first key are dealt out.
_FINE = 64


def _below(bounds: Column, value: Column, size: int, also_equal: bool) -> Column:
    """How many of the sorted bounds, of which there are less than size, are below the value (or equal to it): by halves."""
    steps = F.lit([1 << k for k in reversed(range(max(1, (size - 1).bit_length())))])

    def further(done: Column, step: Column) -> Column:
        bound = F.get(bounds, done + step - 1)
        return done + F.when(bound <= value if also_equal else bound < value, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), further)


def range_ids(df: DataFrame, like: DataFrame, keys: Sequence[str], parts: int) -> Column:
    """The range of a row among ``parts``, by two numeric keys whose quantiles are taken from ``like``.

    The quantiles come from one pass over the two columns of ``like`` alone; there is one number a range. A first key that
    several ranges hold is dealt out to them by the second, and a second key that several quantiles hold by a hash of the
    row. Null keys come first.
    """
    first, second = keys
    cuts = [F.percentile_approx(key, [k / n for k in range(1, n)] or [1.0], 100 * n) for key, n in ((first, parts), (second, _FINE))]
    outer, inner = (F.lit([] if q is None else q[: n - 1]).cast("array<double>") for q, n in zip(like.agg(*cuts).first(), (parts, _FINE)))
    low, high = (F.coalesce(_below(outer, F.col(first), parts, equal), F.lit(0)) for equal in (False, True))
    low2, high2 = (F.coalesce(_below(inner, F.col(second), _FINE, equal), F.lit(0)) for equal in (False, True))
    fine = low2 + F.pmod(F.xxhash64(*df.columns), high2 - low2 + 1)
    return (low + F.floor(fine * (high - low + 1) / _FINE)).cast("int")


def clustered(df: DataFrame, keys: Sequence[str], split_copies: bool = False, like: DataFrame | None = None) -> DataFrame:
    """Range-partition and sort by the keys, so that row-group statistics let scans skip by them.

    A hash of the whole row follows the keys in the range order: a key value that holds a large share of the
    rows is then cut across tasks. Equal rows cannot be cut that way; ``split_copies`` also spreads those, for
    one more shuffle.

    Spark samples what it partitions by range, which works ``df`` out twice. With ``like``, a cheaper frame with two
    numeric keys that are distributed alike, as a fact before its joins, its quantiles are the bounds and ``df`` is worked
    out once.
    """
    if like is not None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartitionById(parts, range_ids(df, like, keys, parts)).sortWithinPartitions(*keys)
    spread = F.xxhash64(*df.columns)
    if split_copies:
        packed = collapse_copies(df)
        cut = packed.repartitionByRange(*keys, spread, "_chunk").sortWithinPartitions(*keys)
        return expand_copies(cut).select(*df.columns)
    return df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)


def append_rows(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Append by column name: columns the frame lacks become null, undeclared ones are left out."""
    conform(df, schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_batch(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Put ``df`` in place of whatever its (job, batch) pairs had in the table; other pairs stay.

    Only the partitions present in ``df`` are rewritten, and a rerun of the write ends in the same state.
    """
    (
        conform(df, schema)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job_name", "batch_id")
        .parquet(path)
    )


def drop_partition(spark: SparkSession, path: str, **values: str) -> None:
    """Remove one partition, needed when a rerun has no rows that would replace it."""
    # The writer escapes characters that a file system may not take; its own function names the folder.
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    leaf = "/".join(name(column, value) for column, value in values.items())
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{leaf}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table by its declared schema; partition columns come back as declared, not as guessed."""
    declared = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    return spark.read.schema(declared).parquet(path).select(*schema.names)
