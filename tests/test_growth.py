"""What lets jobs grow with their tables: how often and how wide rows are shuffled, and how many a task holds."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.catalog import control_queries, file_queries, retail_queries
from martloom.plans import parameters, quality
from martloom.samples import tables as T
from martloom.sinks.tables import _below


@pytest.fixture
def small(spark, tmp_path):
    day = datetime(2023, 5, 17)
    rows = {
        "nation": [(1, "PERU", 1), (2, "CHAD", 0)],
        "customer": [(k, f"c{k}", k % 3, 900.0, "BUILDING") for k in range(1, 8)] + [(3, "again", 1, 1.0, "MACHINERY")],
        "supplier": [(k, f"s{k}", 1, 50.0) for k in range(1, 4)],
        "part": [(k, f"p{k}", "b", "t", 5, 10.0) for k in range(1, 6)],
        "orders": [(k, k % 9 or None, "O", 10.0, day, "1-URGENT") for k in range(1, 30)],
        "lineitem": [(k % 31 or None, k % 5 + 1, k % 3 + 1, 1, 2.0, 30.0, 0.0, 0.0, "A", "F", day) for k in range(90)],
    }
    for name, own in rows.items():
        spark.createDataFrame(own, T._INPUTS[name].replace("TIMESTAMP_NTZ", "TIMESTAMP")).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_join_orders_that_have_met_their_customers(spark, small):
    fact = T.transactions_fact(spark, small)
    joins = [line for line in _plan(fact).splitlines() if "Join" in line]
    # The lines are in the outermost join only.
    assert "l_orderkey" in joins[0] and len(joins) == 3
    lines, orders, customers, nations = (T.read(spark, small, t) for t in ("lineitem", "orders", "customer", "nation"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    expected = joined.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    assert fact.count() == expected.count() > 0
    seen = fact.groupBy("stockid", "productid", "country").count()
    other = expected.groupBy(F.col("l_suppkey").cast("int"), F.col("l_partkey").cast("int"), "n_name").count()
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, other.collect()))


def test_metrics_work_the_fact_out_once(spark, small, monkeypatch):
    plans, store = [], quality.store_metrics

    def seen(sources, *rest):
        plans.append(_plan(sources["transactions"]))
        store(sources, *rest)

    monkeypatch.setattr(quality, "store_metrics", seen)
    assert control_queries.dq_metrics(spark, small).count() > 40
    assert "Join" not in plans[0]


def test_both_marts_of_files_and_clusters_have_the_same_fact(spark, small):
    clustered, mart = retail_queries.mart_clustered_write(spark, small), retail_queries.mart_v3(spark, small)
    assert sorted(map(str, clustered.collect())) == sorted(map(str, mart.collect()))
    assert file_queries.mart_file_job(spark, small).count() > 0


def test_a_value_s_place_among_bounds_is_found_by_halves(spark):
    values = spark.createDataFrame([(float(x),) for x in [*range(-2, 40), "nan", "inf"]] + [(None,)], "x double")
    for size, bounds in ((1, []), (2, [3.0]), (7, [1.0, 1.0, 4.0, 4.0, 4.0, 30.0]), (9, [5.0] * 8), (200, [k / 6 for k in range(199)])):
        own = F.lit(bounds).cast("array<double>")
        for equal in (False, True):
            place = F.coalesce(_below(own, F.col("x"), size, equal), F.lit(0))
            naive = F.coalesce(F.size(F.filter(own, lambda b: b <= F.col("x") if equal else b < F.col("x"))), F.lit(0))
            assert values.filter(place != naive).count() == 0
            # A filter evaluates each bound for each row.
            assert "filter(" not in _plan(values.select(place))


def test_parameters_of_many_jobs_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(parameters, "JOBS_PER_TASK", 100, raising=False)
    jobs = spark.range(0, 1000, 1, 1).select(F.when(F.col("id") > 5, F.concat(F.lit("J"), "id")).alias("job_name"))
    made = parameters.default_parameters(jobs, T.RETAIL_RUN)
    sizes = made.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 5000 and max(r["count"] for r in sizes) <= 600
    assert made.filter("job_name IS NULL").count() == 30
