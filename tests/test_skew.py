"""One key holds a third of all rows and nothing may be broadcast: results stay whole, tasks stay small."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from martloom import schemas
from martloom.operators import joins, numbering
from martloom.plans import retail, scd2
from martloom.samples import tables as T
from martloom.sinks.tables import clustered, range_ids
from tests.rows import frame

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(autouse=True)
def cluster_like(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue(), rows


def hot_key(key):
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).cast("int").alias(key)


@pytest.fixture
def facts(spark):
    return spark.range(0, ROWS, 1, 8).select(
        hot_key("customer_id"),
        (F.col("id") % 10).cast("int").alias("stockid"),
        F.concat(F.lit("I"), F.col("id")).alias("invoiceid"),
        F.lit("d").alias("description"),
        F.lit(1).alias("quantity"),
        F.lit("20240101").alias("invoice_date"),
        F.lit(5).alias("price"),
        F.lit("X").alias("country"),
        (F.col("id") % 20).cast("int").alias("productid"),
    )


@pytest.fixture
def customers(spark):
    return spark.range(500).select(
        F.col("id").cast("int").alias("customer_id"), F.lit("n").alias("customername"), F.lit(1).alias("spending_score"),
        F.lit(1).alias("annual_incomek"), F.lit("F").alias("gender"), F.lit(1).alias("age"), F.lit("citizen").alias("customertype"),
    )


def test_hot_customer_is_split_in_the_mart_join(facts, customers):
    joined = retail.join_customer(retail.with_integer_date(facts), customers)
    text, rows = executed_plan(joined)
    assert "SortMergeJoin(skew=true)" in text
    assert len(rows) == ROWS


@pytest.mark.parametrize("hot", ["left", "both"])
def test_hot_key_in_a_full_join(spark, facts, customers, hot):
    left = facts.select("customer_id", "invoiceid")
    right = customers.select("customer_id", "customername").union(spark.createDataFrame([(9999, "z")], "a INT, b STRING"))
    text, rows = executed_plan(joins.equi_join(left, right, ["customer_id"], "full", hot=hot))
    assert "skew=true" in text
    assert len(rows) == ROWS + 1 and sum(r["customername"] is None for r in rows) == 0


def test_hot_invoice_date_is_spread_by_the_clustered_layout(facts):
    out = clustered(facts, ["invoice_date", "stockid"])
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == ROWS
    assert max(r["count"] for r in sizes) < ROWS / 3


def test_clustering_by_a_fact_s_quantiles_works_the_frame_out_once(spark, facts):
    dated = facts.withColumn("invoice_date", F.coalesce(F.col("invoice_date").try_cast("int"), F.lit(0)))
    out = clustered(dated, ["invoice_date", "stockid"], like=dated.select("invoice_date", "stockid"))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain()
    assert "rangepartitioning" not in text.getvalue()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    own = out.withColumn("p", F.spark_partition_id())
    sizes = own.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("invoice_date").alias("lo"), F.max("invoice_date").alias("hi")).orderBy("p").collect()
    assert sum(r["n"] for r in sizes) == ROWS and max(r["n"] for r in sizes) < 3 * ROWS / int(parts)
    assert all(a["hi"] <= b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_range_ids_handle_nulls_hot_keys_and_nothing(spark):
    df = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 700).cast("int")).alias("a"), F.when(F.col("id") % 5 == 0, 7).otherwise(F.col("id").cast("int")).alias("b")
    )
    for parts in (1, 2, 7, 50):
        ids = df.select("a", "b", range_ids(df, df, ["a", "b"], parts).alias("r"))
        rows = ids.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
        assert 0 <= rows["lo"] <= rows["hi"] < parts
        nulls = ids.filter("a IS NULL").select("r").distinct().count()
        assert nulls == 1
    assert df.limit(0).select(range_ids(df, df.limit(0), ["a", "b"], 5).alias("r")).count() == 0


def test_a_third_of_equal_rows_is_spread_when_asked(spark):
    df = spark.range(0, ROWS, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    packed = clustered(df, ["k"], split_copies=True)
    assert packed.count() == ROWS and packed.filter("k = -1").count() == ROWS / 3
    numbered = numbering.number_rows(df, "n", rows_per_bucket=5000)
    assert numbered.select("n").distinct().count() == ROWS
    assert numbered.agg(F.max("n")).first()[0] == ROWS


def test_null_policy_keys_never_reach_the_join(spark):
    rows = [{"policy_id": None if i % 3 == 0 else i, "policy_type": "T"} for i in range(300)]
    due = frame(spark, schemas.POLICY_SRC, rows)
    empty = frame(spark, schemas.DIM_POLICY, [])
    assert scd2.classify(due, empty).count() == 300
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        scd2.match(due, empty).explain()
    assert "isnotnull(policy_id" in text.getvalue()


def test_counts_are_combined_before_the_shuffle(spark):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        retail.transaction_counts(T.transactions_fact(spark, "/root/testdata/sf0.001")).explain()
    assert "partial_count" in text.getvalue()
