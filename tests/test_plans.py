"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest

import __spark_entry__ as contract
from martloom.plans import scd2
from martloom.samples import tables as T
from martloom.sources.tables import due_policies

SF = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_policy_predicate_reaches_the_scan(spark):
    text = plan(due_policies(T.policy_src(spark, SF), T.POLICY_RUN_DATE))
    assert "LessThanOrEqual(o_orderdate,2000-06-30T00:00)" in text


def test_source_only_outputs_need_no_full_join(spark):
    due, dim = due_policies(T.policy_src(spark, SF), T.POLICY_RUN_DATE), T.dim_policy(spark, SF)
    for df in (scd2.classify(due, dim), scd2.inserts(due, dim, T.POLICY_RUN), scd2.expired(due, dim, T.POLICY_RUN)):
        assert "FullOuter" not in plan(df)


def test_large_sides_are_merged_not_broadcast(spark, no_broadcast):
    text = plan(contract.queries()["mart_v3"](spark, SF))
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") >= 3


def test_marts_read_only_needed_columns(spark):
    text = plan(contract.queries()["count_transactions"](spark, SF))
    assert "l_extendedprice" not in text and "p_name" not in text


def test_foreign_keys_read_the_fact_once(spark, no_broadcast):
    text = plan(contract.queries()["dq_relationships"](spark, SF))
    assert text.count("/lineitem.parquet]") == 1
