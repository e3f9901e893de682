"""Grouped statistics of transactions per store and product category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.catalog.registry import register
from martloom.operators.statistics import (
    StatisticsOptions,
    count_rows,
    group_statistics,
    merge_summaries,
    statistic_columns,
    summarize,
)
from martloom.samples import tables as T
from martloom.samples.sql import with_tables

_KEYS = ("country",)
_DIGITS = 4
_NULL_OK = StatisticsOptions(null_result=True)


def _rounded(df: DataFrame, exact: Sequence[str] = ()) -> DataFrame:
    """Doubles rounded, as two engines add them up in different orders."""
    return df.select(
        *[
            F.round(name, _DIGITS).alias(name) if kind == "double" and name not in exact else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _stats(spark: SparkSession, sf_dir: str, column: str, names: str, options=_NULL_OK, keys=_KEYS) -> DataFrame:
    return _rounded(group_statistics(T.transactions_fact(spark, sf_dir), keys, column, names.split(), options))


def _sql(select: str, source: str = "transactions_fact", keys: str = "country") -> str:
    return with_tables("transactions_fact", f"SELECT {keys}, {select} FROM {source} GROUP BY {keys}")


_CSS = "var_pop(CAST({0} AS DOUBLE)) * count({0})"


@register("agg_counts", _sql("count(quantity) AS quantity_count, count(*) - count(quantity) AS quantity_missing"))
def agg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "quantity", "count missing")


@register(
    "agg_range",
    _sql(
        "CAST(min(price) AS DOUBLE) AS price_min, CAST(max(price) AS DOUBLE) AS price_max, "
        "CAST(max(price) - min(price) AS DOUBLE) AS price_range"
    ),
)
def agg_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "price", "min max range")


@register(
    "agg_sum_mean",
    _sql("CAST(sum(price) AS DOUBLE) AS price_sum, round(CAST(sum(price) AS DOUBLE) / count(price), 4) AS price_mean"),
)
def agg_sum_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "price", "sum mean")


@register(
    "agg_sum_squares",
    _sql(
        "CAST(sum(CAST(quantity AS BIGINT) * quantity) AS DOUBLE) AS quantity_uss, "
        f"round({_CSS.format('quantity')}, 4) AS quantity_css"
    ),
)
def agg_sum_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "quantity", "uss css")


@register(
    "agg_variance",
    with_tables(
        "transactions_fact",
        "SELECT country, round(var_samp(CAST(quantity AS DOUBLE)), 4) AS quantity_var, "
        f"round({_CSS.format('quantity')} / count(*), 4) AS quantity_var_records "
        "FROM transactions_fact GROUP BY country",
    ),
)
def agg_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_values = statistic_columns("quantity", ["var"], _NULL_OK)
    by_records = statistic_columns(
        "quantity", ["var"], StatisticsOptions(null_result=True, record_divisor=True), {"var": "quantity_var_records"}
    )
    return _rounded(T.transactions_fact(spark, sf_dir).groupBy(*_KEYS).agg(*by_values, *by_records))


@register(
    "agg_dispersion",
    _sql(
        "round(stddev_samp(CAST(quantity AS DOUBLE)), 4) AS quantity_std, "
        "round(stddev_samp(CAST(quantity AS DOUBLE)) / sqrt(CAST(count(quantity) AS DOUBLE)), 4) AS quantity_ste, "
        "round(100 * stddev_samp(CAST(quantity AS DOUBLE)) / avg(CAST(quantity AS DOUBLE)), 4) AS quantity_cv"
    ),
)
def agg_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "quantity", "std ste cv")


@register(
    "agg_weighted",
    _sql(
        "CAST(sum(CAST(price AS BIGINT) * quantity) AS DOUBLE) AS price_sum, "
        "CAST(sum(quantity) AS DOUBLE) AS price_sumw, "
        "round(CAST(sum(CAST(price AS BIGINT) * quantity) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE), 4) AS price_mean, "
        "CAST(sum(CAST(price AS HUGEINT) * price * quantity) AS DOUBLE) AS price_uss, "
        "round(100 * stddev_samp(CAST(price AS DOUBLE)) / (CAST(sum(CAST(price AS BIGINT) * quantity) AS DOUBLE) "
        "/ CAST(sum(quantity) AS DOUBLE)), 4) AS price_cv"
    ),
)
def agg_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows weighted by quantity; a missing weight counts nothing."""
    options = StatisticsOptions(weight="quantity", null_result=True)
    return _stats(spark, sf_dir, "price", "sum sumw mean uss cv", options)


@register(
    "agg_missing_value",
    _sql(
        "count(*) FILTER (WHERE price <> -1) AS price_count, count(*) FILTER (WHERE price = -1) AS price_missing, "
        "CAST(min(price) FILTER (WHERE price <> -1) AS DOUBLE) AS price_min, "
        "round(avg(CAST(price AS DOUBLE)) FILTER (WHERE price <> -1), 4) AS price_mean"
    ),
)
def agg_missing_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = StatisticsOptions(missing_value=-1, null_result=True)
    return _stats(spark, sf_dir, "price", "count missing min mean", options)


@register(
    "agg_null_result",
    with_tables(
        "transactions_fact",
        "SELECT invoiceid, coalesce(CAST(max(quantity) AS DOUBLE), 0) AS max_or_zero, "
        "coalesce(round(avg(CAST(quantity AS DOUBLE)), 4), 0) AS mean_or_zero, "
        "CAST(max(quantity) AS DOUBLE) AS max_or_null, round(avg(CAST(quantity AS DOUBLE)), 4) AS mean_or_null "
        "FROM transactions_fact GROUP BY invoiceid",
    ),
)
def agg_null_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices without any quantity give 0 or null, as asked."""
    zero = statistic_columns("quantity", ["max", "mean"], names={"max": "max_or_zero", "mean": "mean_or_zero"})
    null = statistic_columns("quantity", ["max", "mean"], _NULL_OK, {"max": "max_or_null", "mean": "mean_or_null"})
    return _rounded(T.transactions_fact(spark, sf_dir).groupBy("invoiceid").agg(*zero, *null))


@register(
    "agg_decimal",
    with_tables(
        "transactions_fact",
        "SELECT country, CAST(CAST(CAST(sum(quantity) AS DOUBLE) / count(quantity) AS DECIMAL(8,2)) AS VARCHAR) "
        "AS quantity_mean, CAST(CAST(max(quantity) - min(quantity) AS DECIMAL(8,2)) AS VARCHAR) AS quantity_range, "
        "max(quantity) AS quantity_max FROM transactions_fact GROUP BY country",
    ),
)
def agg_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decimal(8,2) output, shown as text to keep the scale; the maximum keeps its integer type."""
    options = StatisticsOptions(null_result=True, decimal=(8, 2), keep_type=True)
    rows = _stats(spark, sf_dir, "quantity", "mean range max", options)
    return rows.withColumns({c: F.col(c).cast("string") for c in ("quantity_mean", "quantity_range")})


_SUMMARY = (
    "count(*) AS n, count(*) - count(quantity) AS nmissing, CAST(count(quantity) AS DOUBLE) AS sumofweights, "
    "CAST(min(quantity) AS DOUBLE) AS minimum, CAST(max(quantity) AS DOUBLE) AS maximum, "
    f"round(avg(CAST(quantity AS DOUBLE)), 4) AS mean, round({_CSS.format('quantity')}, 4) AS css"
)


def _flat(df: DataFrame) -> DataFrame:
    opened = df.select("country", "summary.*")
    return _rounded(opened.toDF(*[c.lower() for c in opened.columns]))


@register("agg_summary", _sql(_SUMMARY))
def agg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(summarize(T.transactions_fact(spark, sf_dir), _KEYS, "quantity"))


@register("agg_resummarize", _sql(_SUMMARY))
def agg_resummarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries per country and store merged into summaries per country: equal to summarizing the rows."""
    parts = summarize(T.transactions_fact(spark, sf_dir), ["country", "stockid"], "quantity")
    return _flat(merge_summaries(parts, _KEYS))


@register(
    "group_case_insensitive",
    with_tables(
        "customer_dim",
        "SELECT lower(customertype) AS customertype, count(*) AS customers FROM customer_dim "
        "GROUP BY lower(customertype)",
    ),
)
def group_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(T.customer_dim(spark, sf_dir), ["customertype"], "customers", ignore_case=["customertype"])
