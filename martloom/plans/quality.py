"""The declared data tests of the sources and marts, and their results as metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.operators import checks
from martloom.plans.validation import CUSTOMER_TYPES, source_rules
from martloom.schemas import DATA_QUALITY_METRICS
from martloom.sinks.tables import append_rows, read_table
from martloom.sources.files import delete_path, existing_paths
from martloom.workspace import scratch_path

# Which columns must be filled, per source table and per mart version.
SOURCE_NOT_NULL = {
    "customer": ("customer_id", "customername", "spending_score", "annual_incomek", "age", "customertype"),
    "retail": ("stockid", "name"),
    "transactions": ("stockid", "invoiceid", "quantity", "price", "customer_id", "productid"),
    "product": ("productid", "productname"),
}
MART_V1_NOT_NULL = ("productid", "productname", "customer_id", "customername", "customertype", "stockid", "invoiceid")
MART_V2_NOT_NULL = (*MART_V1_NOT_NULL, "sales", "quantity", "price", "batch_id", "load_timestamp")
MART_V3_NOT_NULL = (*MART_V2_NOT_NULL, "spending_score", "annual_incomek", "age", "name", "noofemployees", "invoice_date")
# Unique keys, of sources and of the tables that jobs keep, and foreign keys.
UNIQUE_KEYS = {"customer": "customer_id", "retail": "stockid", "product": "productid"}
STORED_UNIQUE_KEYS = {"DIM_POLICY": ("policy_id", "effective_from"), "JOB_PARAMETERS": ("job_name", "parameter_name")}
FOREIGN_KEYS = {"stockid": ("retail", "stockid"), "customer_id": ("customer", "customer_id"), "productid": ("product", "productid")}
TABLE_NAMES = {
    "customer": "CUSTOMER_DIM",
    "retail": "RETAIL_DIM",
    "transactions": "TRANSACTIONS_FACT",
    "product": "PRODUCT_DIM",
}


def source_not_null(sources: Mapping[str, DataFrame]) -> DataFrame:
    return checks.not_null_all(
        {TABLE_NAMES[name]: (sources[name], columns) for name, columns in SOURCE_NOT_NULL.items()}
    )


def mart_not_null(mart: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return checks.not_null(mart, name, columns)


def source_unique(sources: Mapping[str, DataFrame]) -> DataFrame:
    return checks.duplicates_all({TABLE_NAMES[name]: (sources[name], [key]) for name, key in UNIQUE_KEYS.items()})


def stored_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated keys of the tables that jobs keep, which have keys of several columns."""
    return checks.duplicates_all({name: (tables[name], list(key)) for name, key in STORED_UNIQUE_KEYS.items()})


def source_relationships(sources: Mapping[str, DataFrame], scopes: Sequence[str] = ("source", "valid")) -> DataFrame:
    """(relationship, missing_keys, failures) of each foreign key: against all parents, and against the valid ones.

    The fact is read once: each of its keys is counted per value, combined before the shuffle, and only those counts
    meet the parents, of which each says whether it is valid.
    """
    rules = source_rules()
    keys = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("bigint").alias("value")) for k in FOREIGN_KEYS])
    children = (
        sources["transactions"].select(F.explode(keys).alias("k")).select("k.*").filter("value IS NOT NULL")
        .groupBy("key", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = None
    for key, (parent, parent_key) in FOREIGN_KEYS.items():
        own = sources[parent].select(
            F.lit(key).alias("key"),
            F.col(parent_key).cast("bigint").alias("value"),
            F.coalesce(rules[parent].strictly_valid(), F.lit(False)).alias("valid"),
        )
        parents = own if parents is None else parents.unionByName(own)
    known = parents.filter("value IS NOT NULL").groupBy("key", "value").agg(F.bool_or("valid").alias("valid"))
    missing = {"source": F.col("valid").isNull(), "valid": ~F.coalesce(F.col("valid"), F.lit(False))}
    counts, entries = [], []
    for scope in scopes:
        for key, (parent, _) in FOREIGN_KEYS.items():
            lost = (F.col("key") == key) & missing[scope]
            counts += [
                F.count_if(lost).alias(f"keys_{scope}_{key}"),
                F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias(f"rows_{scope}_{key}"),
            ]
            entries.append(
                F.struct(
                    F.lit(f"{scope}: TRANSACTIONS_FACT.{key} -> {TABLE_NAMES[parent]}").alias("relationship"),
                    F.col(f"keys_{scope}_{key}").alias("missing_keys"),
                    F.col(f"rows_{scope}_{key}").alias("failures"),
                )
            )
    totals = children.join(known, ["key", "value"], "left").agg(*counts)
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def accepted_customer_types(df: DataFrame, table: str) -> DataFrame:
    return checks.outside_values(df, table, "customertype", CUSTOMER_TYPES)


def metric_status(value: Column, threshold: Column) -> Column:
    """PASS at zero failures, WARNING up to the threshold, FAIL above it."""
    return F.when(value == 0, "PASS").when(value <= threshold, "WARNING").otherwise("FAIL")


def declared_results(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, metric_name, checked, failures) of every declared test of the sources: not_null, unique,
    relationships, accepted_values. Failures are rows."""
    nulls = source_not_null(sources)
    checked = nulls.groupBy("table_name").agg(F.max("checked").alias("checked"))
    results = nulls.select("table_name", F.concat(F.lit("not_null_"), "column_name").alias("metric_name"), "failures")
    repeated = source_unique(sources).groupBy("table_name").agg(F.sum("rows").alias("rows"))
    for name, key in UNIQUE_KEYS.items():
        own = repeated.filter(F.col("table_name") == TABLE_NAMES[name]).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
        results = results.union(own.select(F.lit(TABLE_NAMES[name]), F.lit(f"unique_{key}"), "failures"))
    lost = source_relationships(sources, ("source",))
    key = F.regexp_extract("relationship", r"FACT\.(\w+)", 1)
    results = results.union(lost.select(F.lit("TRANSACTIONS_FACT"), F.concat(F.lit("relationships_"), key), "failures"))
    for table, df in (("CUSTOMER_DIM", sources["customer"]),):
        other = accepted_customer_types(df, table).agg(F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"))
        results = results.union(other.select(F.lit(table), F.lit("accepted_values_customertype"), "failures"))
    # One row a table.
    return results.join(checked, "table_name")


# The declared tests of each mart version: its name in metrics, columns that must be filled, and whether
# the customer type must be an accepted one.
MART_TESTS = {
    1: ("MART_V1", MART_V1_NOT_NULL, False),
    2: ("MART_V2", MART_V2_NOT_NULL, True),
    3: ("MART_V3", MART_V3_NOT_NULL, True),
}


def mart_tallies(version: int) -> list[Column]:
    """Rows, and rows that fail each declared test of a mart version, to be observed while the mart is written."""
    _, columns, typed = MART_TESTS[version]
    tallies = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"not_null_{c}") for c in columns]]
    if typed:
        tallies.append(F.count_if(~F.col("customertype").isin(*CUSTOMER_TYPES)).alias("accepted_values_customertype"))
    return tallies


def mart_results(spark: SparkSession, version: int, tallied: Mapping[str, int]) -> DataFrame:
    """(table_name, metric_name, failures, checked) from what was tallied of a mart."""
    rows = [(MART_TESTS[version][0], name, n, tallied["rows"]) for name, n in tallied.items() if name != "rows"]
    return spark.createDataFrame(rows, "table_name string, metric_name string, failures bigint, checked bigint")


def metric_rows(results: DataFrame, run: RunContext, tolerated_share: float = 0.01) -> DataFrame:
    """Metric rows from test results with table_name, metric_name, checked and failures.

    The threshold is a share of the checked rows, rounded down to whole rows.
    """
    threshold = F.floor(F.col("checked") * F.lit(str(tolerated_share)).cast("decimal(6,4)"))
    return results.select(
        run.batch.alias("batch_id"),
        run.job.alias("job_name"),
        "table_name",
        "metric_name",
        F.col("failures").cast("decimal(18,2)").alias("metric_value"),
        threshold.cast("decimal(18,2)").alias("threshold_value"),
        metric_status(F.col("failures"), threshold).alias("status"),
        run.now.alias("check_timestamp"),
        run.now.alias("created_at"),
    )


def store_metrics(sources: Mapping[str, DataFrame], path: str, run: RunContext, marts: Sequence[DataFrame] = ()) -> None:
    """Append the results of a run's tests, of its sources and of its marts, to the metrics table. Ids follow the table's,
    in the order of table and metric."""
    spark = next(iter(sources.values())).sparkSession
    scratch = scratch_path(spark, "metrics")
    results = reduce(DataFrame.unionByName, marts, declared_results(sources).select("table_name", "metric_name", "failures", "checked"))
    metric_rows(results, run).write.parquet(scratch)
    rows = spark.read.parquet(scratch)
    # One row a declared test, some forty, whatever the tables hold.
    order = Window.orderBy("table_name", "metric_name")
    stored = read_table(spark, path, DATA_QUALITY_METRICS) if existing_paths(spark, [path]) else None
    last = stored.agg(F.max("metric_id")).first()[0] or 0 if stored is not None else 0
    append_rows(rows.withColumn("metric_id", F.row_number().over(order) + F.lit(last).cast("bigint")), path, DATA_QUALITY_METRICS)
    delete_path(spark, scratch)
