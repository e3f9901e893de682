"""Reference-shaped tables derived from the driver's parquet tables with plain column expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.context import POLICY_JOB, RETAIL_JOB, RunContext

# The clock of every registered query.
RUN_TS = datetime(2024, 1, 31, 12, 0, 0)
POLICY_RUN_DATE = date(2000, 6, 30)
RETAIL_RUN = RunContext.start(RETAIL_JOB, run_ts=RUN_TS)
POLICY_RUN = RunContext.start(POLICY_JOB, run_ts=RUN_TS, run_date=POLICY_RUN_DATE)


# The columns of the input tables, declared so that no job has to look them up in the files.
_INPUTS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_INPUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, step: int, offset: int = 0) -> Column:
    return F.col(column) % step == offset


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    kind = F.create_map(
        *[
            F.lit(x)
            for pair in (
                ("BUILDING", "citizen"),
                ("AUTOMOBILE", "Citizen"),
                ("MACHINERY", "foriegn"),
                ("HOUSEHOLD", "FORIEGN"),
                ("FURNITURE", "non-citizen"),
            )
            for x in pair
        ]
    )
    return read(spark, sf_dir, "customer").select(
        key.cast("int").alias("customer_id"),
        F.when(_every("c_custkey", 97, 5), "   ").otherwise(F.col("c_name")).alias("customername"),
        F.when(~_every("c_custkey", 59, 7), (key % 111).cast("int")).alias("spending_score"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("annual_incomek"),
        F.when(_every("c_custkey", 2), "F").otherwise("M").alias("gender"),
        F.when(~_every("c_custkey", 53, 11), (key % 130).cast("int")).alias("age"),
        kind[F.col("c_mktsegment")].alias("customertype"),
    )


def retail_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        read(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("int").alias("stockid"),
            F.col("s_name").alias("name"),
            F.when(~_every("s_suppkey", 37, 9), (key % 7).cast("int")).alias("rating"),
            F.col("n_name").alias("location"),
            F.floor(F.col("s_acctbal") / 10).cast("int").alias("noofemployees"),
        )
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("productid"),
        F.when(_every("p_partkey", 89, 3), "").otherwise(F.col("p_name")).alias("productname"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.when(_every("p_partkey", 41), -1).otherwise(F.floor("p_retailprice").cast("int")).alias("sales"),
        F.when(~_every("p_partkey", 67, 1), F.col("p_size")).alias("quantity"),
    )


def transactions_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # The orders meet their customers first, so that the lines, which are far more, are shuffled once.
    placed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "n_name")
    )
    shipped = F.col("l_shipdate").cast("date")
    # Cheaper than a format pattern, and the same text for years of four digits.
    digits = F.year(shipped) * 10000 + F.month(shipped) * 100 + F.day(shipped)
    return (
        read(spark, sf_dir, "lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_suppkey").cast("int").alias("stockid"),
            F.when(_every("l_orderkey", 101), "")
            .otherwise(F.concat(F.lit("INV"), F.col("l_orderkey").cast("string")))
            .alias("invoiceid"),
            F.concat_ws("-", "l_returnflag", "l_linestatus").alias("description"),
            F.when(_every("l_orderkey", 307, 1), F.lit(None))
            .when(_every("l_orderkey", 73), 0)
            .otherwise(F.col("l_quantity").cast("int"))
            .alias("quantity"),
            F.when(_every("l_orderkey", 10), shipped.cast("string"))
            .otherwise(digits.cast("string"))
            .alias("invoice_date"),
            F.when(_every("l_orderkey", 83), -1)
            .otherwise(F.floor("l_extendedprice").cast("int"))
            .alias("price"),
            F.when(~_every("l_orderkey", 211), F.col("o_custkey").cast("int")).alias("customer_id"),
            F.col("n_name").alias("country"),
            F.col("l_partkey").cast("int").alias("productid"),
        )
    )


def retail_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customer": customer_dim(spark, sf_dir),
        "retail": retail_dim(spark, sf_dir),
        "transactions": transactions_fact(spark, sf_dir),
        "product": product_dim(spark, sf_dir),
    }


def policy_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(
        F.when(~_every("o_orderkey", 199), F.col("o_orderkey")).alias("policy_id"),
        F.when(~_every("o_orderkey", 31), F.concat(F.lit("HOLDER_"), F.col("o_custkey").cast("string"))).alias(
            "policy_holder_name"
        ),
        F.col("o_orderpriority").alias("policy_type"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("premium_amount"),
        started.alias("start_date"),
        F.when(~_every("o_orderkey", 13), F.date_add(started, 365)).alias("end_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_date"),
        F.lit("POLICY_SYS").alias("source_system"),
    )


def dim_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension before the load: a current row per policy, and for some an earlier closed version."""
    started = F.col("o_orderdate").cast("date")
    has_history = _every("o_orderkey", 4, 1)
    versions = F.when(has_history, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    is_current = F.col("is_current")
    key = F.col("o_orderkey") + 1
    return (
        read(spark, sf_dir, "orders")
        .filter(~_every("o_orderkey", 3))
        .withColumn("is_current", F.explode(versions))
        .select(
            F.when(is_current, key).otherwise(-key).alias("policy_key"),
            F.col("o_orderkey").alias("policy_id"),
            F.when(
                ~_every("o_orderkey", 31) & ~_every("o_orderkey", 7),
                F.concat(F.lit("HOLDER_"), F.col("o_custkey").cast("string")),
            ).alias("policy_holder_name"),
            F.col("o_orderpriority").alias("policy_type"),
            (
                F.col("o_totalprice").cast("decimal(10,2)")
                + F.when(_every("o_orderkey", 5), F.lit("10.00")).otherwise(F.lit("0.00")).cast("decimal(9,2)")
            )
            .cast("decimal(10,2)")
            .alias("premium_amount"),
            started.alias("start_date"),
            F.when(~_every("o_orderkey", 13), F.date_add(started, 365)).alias("end_date"),
            F.when(is_current, F.lit(date(1995, 1, 1))).otherwise(F.lit(date(1994, 1, 1))).alias("effective_from"),
            F.when(~is_current, F.lit(date(1994, 12, 31))).alias("effective_to"),
            F.when(is_current, "Y").otherwise("N").alias("current_flag"),
            F.when(is_current & has_history, 2).otherwise(1).alias("version_no"),
            F.lit("POLICY_SYS").alias("source_system"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("updated_date"),
            F.lit("BATCH_19950101000000").alias("batch_id"),
        )
    )


def job_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event."""
    started = F.col("ts").cast("timestamp_ntz")
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("SUCCESS", "FAILED", "SUCCESS_WITH_REJECTS", "RUNNING")]),
        (F.col("event_id") % 4 + 1).cast("int"),
    )
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("BATCH_E"), F.col("event_id").cast("string")).alias("batch_id"),
        F.col("event_type").alias("job_name"),
        started.alias("start_time"),
        F.when(
            ~_every("event_id", 4, 3), started + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
        ).alias("end_time"),
        status.alias("status"),
        F.col("user_id").alias("source_count"),
        (F.col("event_id") % 1000).alias("target_inserts"),
        F.lit(0).cast("bigint").alias("target_updates"),
        F.when(_every("event_id", 4, 1), F.lit("failed")).alias("error_message"),
    )


def data_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(
        F.array(F.lit("PASS"), F.lit("FAIL"), F.lit("WARNING")), (F.col("event_id") % 3 + 1).cast("int")
    )
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("metric_id"),
        F.concat(F.lit("TABLE_"), (F.col("user_id") % 10).cast("string")).alias("table_name"),
        F.concat(F.lit("metric_"), F.col("event_type")).alias("metric_name"),
        F.col("value").cast("decimal(18,2)").alias("metric_value"),
        status.alias("status"),
        F.col("ts").cast("timestamp_ntz").alias("check_timestamp"),
    )


# The batches present in the derived customer audit history; the last is later than the run.
AUDIT_BATCHES = ("BATCH_20240129120000", "BATCH_20240130120000", "BATCH_20240201120000")


def customer_dim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows stored by earlier (and one later) batches, from the same customers with other scores."""
    first, second, later = (F.lit(b) for b in AUDIT_BATCHES)
    key = F.col("customer_id")
    batches = F.filter(
        F.array(F.when(key % 2 == 0, first), F.when(key % 3 != 0, second), F.when(key % 5 == 0, later)),
        lambda b: b.isNotNull(),
    )
    shifted = F.when(key % 4 == 0, F.lit(5)).otherwise(0)
    return (
        customer_dim(spark, sf_dir)
        .withColumn("batch_id", F.explode(batches))
        .select(
            "batch_id",
            "customer_id",
            "customername",
            (F.col("spending_score") + shifted).alias("spending_score"),
            F.when(key % 17 != 0, F.col("annual_incomek")).alias("annual_incomek"),
            "gender",
            "age",
            "customertype",
            F.lit("INSERT").alias("change_type"),
            F.lit("2024-01-30 12:00:00").cast("timestamp_ntz").alias("change_timestamp"),
            F.lit(None).cast("int").alias("previous_spending_score"),
            F.lit(None).cast("int").alias("previous_annual_incomek"),
        )
    )


def previous_customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older image of the customer dimension: some customers absent, some extra, some different."""
    key = F.col("customer_id")
    return (
        customer_dim(spark, sf_dir)
        .filter(key % 13 != 0)
        .select(
            F.when(key % 29 == 1, key + 1_000_000_000).otherwise(key).alias("customer_id"),
            "customername",
            "spending_score",
            "annual_incomek",
            F.when(key % 19 != 0, F.col("gender")).alias("gender"),
            F.when(key % 6 == 0, F.col("age") - 1).otherwise(F.col("age")).alias("age"),
            "customertype",
        )
    )


def job_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored parameters: one job per customer, some of them with a commit batch of their own."""
    return (
        read(spark, sf_dir, "customer")
        .filter(_every("c_custkey", 3))
        .select(
            (F.col("c_custkey") + 1).alias("parameter_id"),
            F.concat(F.lit("JOB_"), F.col("c_custkey").cast("string")).alias("job_name"),
            F.lit("commit_batch").alias("parameter_name"),
            (F.col("c_custkey") * 10).cast("string").alias("parameter_value"),
            F.lit("INTEGER").alias("parameter_type"),
            F.lit("kept as set").alias("description"),
            F.lit(True).alias("is_active"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        )
    )


def job_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.concat(F.lit("JOB_"), F.col("c_custkey").cast("string")).alias("job_name")
    )


def marketing_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 29-column campaign file derived from customers and their segment."""
    from martloom.schemas import MARKETING_CAMPAIGN

    key = F.col("c_custkey")
    named = {
        "ID": key,
        "Year_Birth": 1940 + key % 60,
        "Education": F.col("c_mktsegment"),
        "Marital_Status": F.when(_every("c_custkey", 2), "Married").otherwise("Single"),
        "Income": F.when(~_every("c_custkey", 43), F.floor(F.abs("c_acctbal"))),
        "Dt_Customer": F.date_add(F.lit(date(2012, 7, 30)), (key % 700).cast("int")),
        "Z_CostContact": F.lit(3),
        "Z_Revenue": F.lit(11),
    }
    return read(spark, sf_dir, "customer").select(
        *[
            named.get(f.name, (key * (i + 1)) % 97).cast(f.dataType).alias(f.name)
            for i, f in enumerate(MARKETING_CAMPAIGN)
        ]
    )
