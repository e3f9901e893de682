"""Grouped statistics of one column, with weights, a missing value, and mergeable summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import all_of, fold_case

# The statistics that can be asked for, and those that become 0 for an all-missing group.
STATISTICS = (
    "count missing min max range sum mean uss css var std ste cv sumw".split()
)
ZERO_WHEN_EMPTY = frozenset("min max mean std ste sum sumw var".split())
SUMMARY_FIELDS = "n nMissing sumOfWeights minimum maximum mean css".split()


@dataclass(frozen=True)
class StatisticsOptions:
    """How to compute.

    missing_value: a number to be treated like null. weight: a column that counts a row as that many; it applies
    to sum, mean, uss, sumw and the mean inside cv, while the spread statistics stay unweighted.
    record_divisor: divide the variance by the number of records instead of non-missing values minus one.
    null_result: an all-missing group gives null; otherwise 0. decimal: (precision, scale) of the output.
    keep_type: min and max keep the input's type.
    """

    missing_value: float | None = None
    weight: str | None = None
    record_divisor: bool = False
    null_result: bool = False
    decimal: tuple[int, int] | None = None
    keep_type: bool = False


def grouping(keys: Sequence[str], ignore_case: Sequence[str] = ()) -> list[Column]:
    """Grouping columns; those in ``ignore_case`` are folded to lower case under their own name."""
    return [fold_case(k).alias(k) if k in ignore_case else F.col(k) for k in keys]


def count_rows(df: DataFrame, keys: Sequence[str], name: str, ignore_case: Sequence[str] = ()) -> DataFrame:
    """Rows per group. Counts are combined before the shuffle, so a hot key costs no more than another."""
    return df.groupBy(*grouping(keys, ignore_case)).agg(F.count(F.lit(1)).alias(name))


def _present(column: str, options: StatisticsOptions) -> Column:
    value = F.col(column)
    if options.missing_value is None:
        return value
    return F.when(value.cast("double") == F.lit(float(options.missing_value)), F.lit(None)).otherwise(value)


def _safe_divide(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom)


def _moments(value: Column, options: StatisticsOptions) -> dict[str, Column]:
    x = value.cast("double")
    weight = F.lit(1.0) if options.weight is None else F.col(options.weight).cast("double")
    counted = F.when(x.isNotNull(), F.coalesce(weight, F.lit(0.0)))
    n = F.count(x)
    css = F.var_pop(x) * n
    total_weight = F.sum(counted)
    mean = _safe_divide(F.sum(counted * x), total_weight) if options.weight else F.avg(x)
    if options.record_divisor:
        variance = _safe_divide(css, F.count(F.lit(1)))
    else:
        variance = _safe_divide(css, n - 1)
    std = F.sqrt(variance)
    return {
        "count": n,
        "missing": F.count(F.lit(1)) - n,
        "min": F.min(value if options.keep_type else x),
        "max": F.max(value if options.keep_type else x),
        "range": F.max(x) - F.min(x),
        "sum": F.sum(counted * x),
        "mean": mean,
        "uss": F.sum(counted * x * x),
        "css": css,
        "var": variance,
        "std": std,
        "ste": _safe_divide(std, F.sqrt(n.cast("double"))),
        "cv": _safe_divide(std * 100, mean),
        "sumw": total_weight,
    }


def _shape(name: str, value: Column, n: Column, options: StatisticsOptions) -> Column:
    if name in ("count", "missing"):
        return value
    if not options.null_result and name in ZERO_WHEN_EMPTY:
        value = F.when(n == 0, F.lit(0)).otherwise(value)
    if options.decimal and not (options.keep_type and name in ("min", "max")):
        value = value.cast("decimal({},{})".format(*options.decimal))
    return value


def statistic_columns(
    column: str,
    statistics: Sequence[str],
    options: StatisticsOptions = StatisticsOptions(),
    names: dict[str, str] | None = None,
) -> list[Column]:
    """Aggregate expressions for the asked statistics of ``column``, called ``<column>_<statistic>`` unless named.

    Lists for several columns or options can go into one aggregation.
    """
    unknown = set(statistics) - set(STATISTICS)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    moments = _moments(_present(column, options), options)
    named = names or {}
    return [
        _shape(s, moments[s], moments["count"], options).alias(named.get(s, f"{column}_{s}")) for s in statistics
    ]


def group_statistics(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    statistics: Sequence[str],
    options: StatisticsOptions = StatisticsOptions(),
    ignore_case: Sequence[str] = (),
    names: dict[str, str] | None = None,
) -> DataFrame:
    """The asked statistics of ``column`` per group.

    All of them are partial aggregates: one shuffle of one small buffer per group and task, whatever is asked.
    """
    return df.groupBy(*grouping(keys, ignore_case)).agg(*statistic_columns(column, statistics, options, names))


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str = "summary",
    options: StatisticsOptions = StatisticsOptions(),
) -> DataFrame:
    """Per group, one struct from which all statistics can be had later and which can be merged with others."""
    m = _moments(_present(column, options), options)
    summary = F.struct(
        F.count(F.lit(1)).alias("n"),
        m["missing"].alias("nMissing"),
        F.coalesce(m["sumw"], F.lit(0.0)).alias("sumOfWeights"),
        m["min"].alias("minimum"),
        m["max"].alias("maximum"),
        m["mean"].alias("mean"),
        m["css"].alias("css"),
    )
    return df.groupBy(*keys).agg(summary.alias(name))


def merge_summaries(df: DataFrame, keys: Sequence[str], column: str = "summary", name: str = "summary") -> DataFrame:
    """Combine summaries per group into one, as if the rows had been summarized together.

    The spread between the partial means is measured about the group's own mean, found first: subtracting
    large sums of squares would lose the digits that matter. Both passes are partial aggregates, so the parts of
    a hot group are reduced where they lie.
    """
    part = F.col(column)
    parts = df.select(
        *keys,
        part.alias("_part"),
        (part["n"] - part["nMissing"]).cast("double").alias("_present"),
        F.when(part["n"] > part["nMissing"], part["mean"]).alias("_mean"),
        F.when(part["n"] > part["nMissing"], part["sumOfWeights"]).alias("_weight"),
    )
    means = (
        parts.groupBy(*keys)
        .agg(_safe_divide(F.sum(F.col("_weight") * F.col("_mean")), F.sum("_weight")).alias("_grand"))
        .withColumnsRenamed({k: f"_of_{k}" for k in keys})
    )
    located = parts.join(means, all_of(F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    away = F.col("_mean") - F.col("_grand")
    summary = F.struct(
        F.sum("_part.n").alias("n"),
        F.sum("_part.nMissing").alias("nMissing"),
        F.sum("_part.sumOfWeights").alias("sumOfWeights"),
        F.min("_part.minimum").alias("minimum"),
        F.max("_part.maximum").alias("maximum"),
        F.max("_grand").alias("mean"),
        (F.sum("_part.css") + F.coalesce(F.sum(F.col("_present") * away * away), F.lit(0.0))).alias("css"),
    )
    return located.groupBy(*keys).agg(summary.alias(name))
