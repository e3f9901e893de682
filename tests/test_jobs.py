"""Whole runs of the audited mart and the file jobs, including reruns and failures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martloom import schemas
from martloom.context import RETAIL_JOB, RunContext
from martloom.plans import audit, jobs, monitoring, quality, rejects, retail
from martloom.samples import tables as T
from martloom.sinks.delimited import write_delimited
from martloom.sinks.tables import read_table, refresh_table
from martloom.sources.delimited import DelimitedFormat, scan_delimited
from martloom.sources.tables import jdbc_due_policies, parquet_source, table_source

SF = "/root/testdata/sf0.001"


def clock_after(run, seconds):
    return lambda: run.run_ts + timedelta(seconds=seconds)


def test_audited_mart_run_and_rerun(spark, tmp_path):
    root = str(tmp_path / "dw")
    sources = T.retail_sources(spark, SF)
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31, 12))
    expected_rejects = rejects.retail_rejects(sources, run).count()
    for again in (False, True):
        jobs.run_retail_mart(spark, sources, root, run, clock_after(run, 42))
        mart = spark.read.parquet(f"{root}/retail_data_mart")
        assert mart.count() == 2290 and mart.columns == [*schemas.MART_COLUMNS, "batch_id", "load_timestamp"]
        log = read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)
        assert log.count() == (4 if again else 2)
        last = audit.latest_status(log).first()
        assert (last["status"], last["source_count"], last["target_inserts"], last["reject_count"]) == (
            "SUCCESS_WITH_REJECTS", 6000, 2290, expected_rejects)
        assert last["execution_duration_seconds"] == 42
        assert read_table(spark, f"{root}/job_rejects", schemas.JOB_REJECTS).count() == expected_rejects
        metrics = read_table(spark, f"{root}/data_quality_metrics", schemas.DATA_QUALITY_METRICS)
        names = {(r["table_name"], r["metric_name"]) for r in metrics.filter("table_name LIKE 'MART%'").collect()}
        assert names == {("MART_V3", f"not_null_{c}") for c in quality.MART_V3_NOT_NULL} | {("MART_V3", "accepted_values_customertype")}
        assert metrics.select("metric_id").distinct().count() == metrics.count()
        changes = read_table(spark, f"{root}/customer_dim_audit", schemas.CUSTOMER_DIM_AUDIT)
        assert changes.count() == sources["customer"].count()
        assert {r["change_type"] for r in changes.select("change_type").distinct().collect()} == {"INSERT"}


@pytest.mark.parametrize("version,rows,columns", [(1, 5956, 23), (2, 2693, 25)])
def test_earlier_versions_of_the_run(spark, tmp_path, version, rows, columns):
    root = str(tmp_path / "dw")
    sources = T.retail_sources(spark, SF)
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(1998, 5, 20, 12))
    jobs.run_retail_mart(spark, sources, root, run, clock_after(run, 1), version=version)
    mart = spark.read.parquet(f"{root}/retail_data_mart")
    assert (mart.count(), len(mart.columns)) == (rows, columns)
    last = audit.latest_status(read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)).first()
    staged = retail.staged_v1(sources)["transactions"].count()
    dated = retail.dated_on(sources["transactions"], run.run_date).count()
    assert last["source_count"] == (staged if version == 1 else dated)
    assert last["status"] == ("SUCCESS" if version == 1 else "SUCCESS_WITH_REJECTS")


def test_next_batch_records_updates_only(spark, tmp_path):
    root = str(tmp_path / "dw")
    customers = T.customer_dim(spark, SF)
    first = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 30))
    second = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31))
    jobs.record_customer_changes(spark, customers, root, first)
    moved = customers.withColumn(
        "annual_incomek", F.when(F.col("customer_id") < 10, F.col("annual_incomek") + 1).otherwise(F.col("annual_incomek"))
    )
    jobs.record_customer_changes(spark, moved, root, second)
    rows = read_table(spark, f"{root}/customer_dim_audit", schemas.CUSTOMER_DIM_AUDIT).filter(
        F.col("batch_id") == second.batch_id)
    assert {r["customer_id"]: r["change_type"] for r in rows.collect()} == {i: "UPDATE" for i in range(10)}


def test_run_without_rejects_clears_the_batch(spark, tmp_path):
    root = str(tmp_path / "dw")
    sources = T.retail_sources(spark, SF)
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31, 12))
    other = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 30, 12))
    jobs.run_retail_mart(spark, sources, root, other)
    jobs.run_retail_mart(spark, sources, root, run)
    from martloom.plans.validation import source_rules, strict

    clean = {name: strict(df, source_rules()[name]) for name, df in sources.items()}
    jobs.run_retail_mart(spark, clean, root, run)
    left = read_table(spark, f"{root}/job_rejects", schemas.JOB_REJECTS).select("batch_id").distinct().collect()
    assert [r["batch_id"] for r in left] == [other.batch_id]
    log = read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)
    assert log.filter(F.col("status") == "SUCCESS").count() == 1


def test_failed_run_is_recorded(spark, tmp_path):
    root = str(tmp_path / "dw")
    sources = dict(T.retail_sources(spark, SF))
    sources["product"] = sources["product"].withColumn("sales", F.raise_error(F.lit("source went away")).cast("int"))
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31, 12))
    with pytest.raises(Exception, match="source went away"):
        jobs.run_retail_mart(spark, sources, root, run)
    last = audit.latest_status(read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)).first()
    assert last["status"] == "FAILED" and "source went away" in last["error_message"]


def test_source_count_of_the_run_date(spark):
    sources = T.retail_sources(spark, SF)
    day = datetime(1998, 5, 20)
    wanted = retail.dated_on(sources["transactions"], day.date()).count()
    run = RunContext.start(RETAIL_JOB, run_ts=day)
    row = audit.mart_counts(sources["transactions"], sources["product"], sources["retail"], only_day=run).first()
    assert row["source_count"] == wanted


def test_file_jobs_in_a_chain(spark, tmp_path):
    sources = T.retail_sources(spark, SF)
    paths = {}
    for name, df in sources.items():
        paths[name] = str(tmp_path / name)
        write_delimited(df, paths[name], jobs.FILE_LAYOUTS[name])
    jobs.run_mart_file_job(spark, paths, str(tmp_path / "mart"))
    jobs.run_count_file_job(spark, str(tmp_path / "mart"), str(tmp_path / "counts"))
    layout = DelimitedFormat(header=True)
    mart = scan_delimited(spark, str(tmp_path / "mart"), schemas.RETAIL_DATA_MART, layout)
    counts = scan_delimited(spark, str(tmp_path / "counts"), schemas.COUNT_CUSTOMERS_TRANSACTIONS, layout)
    assert counts.agg(F.sum("total_orders_num")).first()[0] == mart.count() > 0
    assert counts.count() == mart.select("customer_id", "stockid").distinct().count()


def test_table_sources(spark, tmp_path):
    stores = T.retail_dim(spark, SF)
    refresh_table(stores.withColumn("undeclared", F.lit(1)), "retail_dim_table")
    assert table_source(spark, "retail_dim_table", schemas.RETAIL_DIM).columns == schemas.RETAIL_DIM.names
    refresh_table(stores.limit(3), "retail_dim_table")
    assert spark.table("retail_dim_table").count() == 3
    stores.write.parquet(str(tmp_path / "p"))
    assert parquet_source(spark, str(tmp_path / "p"), schemas.RETAIL_DIM).count() == stores.count()


def test_database_source_reports_a_missing_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_due_policies(spark, "jdbc:nodb://nowhere/x", datetime(2024, 1, 1).date(), (1, 1000), 4, 500)


def test_run_on_empty_sources(spark, tmp_path):
    root = str(tmp_path / "dw")
    sources = {name: df.filter(F.lit(False)) for name, df in T.retail_sources(spark, SF).items()}
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31, 12))
    jobs.run_retail_mart(spark, sources, root, run)
    last = audit.latest_status(read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)).first()
    assert (last["status"], last["source_count"], last["target_inserts"], last["reject_count"]) == ("SUCCESS", 0, 0, 0)


def test_run_whose_join_turns_out_empty(spark, tmp_path):
    root = str(tmp_path / "dw")
    sources = dict(T.retail_sources(spark, SF))
    sources["customer"] = sources["customer"].filter(F.col("customer_id") + F.col("age") < -5)
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31, 12))
    jobs.run_retail_mart(spark, sources, root, run)
    last = audit.latest_status(read_table(spark, f"{root}/job_audit_log", schemas.JOB_AUDIT_LOG)).first()
    assert last["target_inserts"] == 0 and last["source_count"] == 6000


def test_rerun_without_customer_changes_clears_the_batch(spark, tmp_path):
    root = str(tmp_path / "dw")
    customers = T.customer_dim(spark, SF)
    run = RunContext.start(RETAIL_JOB, run_ts=datetime(2024, 1, 31))
    jobs.record_customer_changes(spark, customers, root, run)
    jobs.record_customer_changes(spark, customers.filter(F.col("customer_id") < -1), root, run)
    assert read_table(spark, f"{root}/customer_dim_audit", schemas.CUSTOMER_DIM_AUDIT).count() == 0


@pytest.mark.parametrize("batch", ["B:1", "a/b=c", "50%", "plain"])
def test_a_batch_of_any_name_is_removed(spark, tmp_path, batch):
    from martloom.sinks.tables import drop_partition

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "J", batch), (2, "J", "other")], "v INT, job_name STRING, batch_id STRING")
    rows.write.partitionBy("job_name", "batch_id").parquet(path)
    drop_partition(spark, path, job_name="J", batch_id=batch)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]


def test_marts_round_a_date_with_a_fraction(spark):
    from martloom.plans.retail import with_integer_date
    from martloom.plans.validation import source_rules, strict

    texts = {"20230525": 20230525, "12.7": 13, "1e3": 1000, "x": None, " 7 ": 7, "": None, None: None}
    rows = [(1, "I", "d", 1, t, 1, 1, "c", 1) for t in texts]
    names = "stockid INT, invoiceid STRING, description STRING, quantity INT, invoice_date STRING, price INT, customer_id INT, country STRING, productid INT"
    df = spark.createDataFrame(rows, names)
    assert sorted(r.invoice_date or 0 for r in with_integer_date(df).collect()) == sorted(v or 0 for v in texts.values())
    kept = strict(df, source_rules()["transactions"])
    assert sorted(r.invoice_date for r in kept.collect()) == sorted(t for t, v in texts.items() if v)


def test_dimension_changes_are_stored_with_ids(spark, tmp_path):
    columns = "id INT, a STRING"
    images = [spark.createDataFrame(rows, columns) for rows in ([(1, "x"), (2, "y")], [(1, "x"), (2, "z"), (3, "n")], [(1, "q")])]
    run = RunContext.start(RETAIL_JOB)
    assert jobs.record_dimension_changes(spark, images[0], images[1], "id", ["id", "a"], "D", str(tmp_path), run) == 2
    assert jobs.record_dimension_changes(spark, images[1], images[2], "id", ["id", "a"], "D", str(tmp_path), run) == 3
    assert jobs.record_dimension_changes(spark, images[2], images[2], "id", ["id", "a"], "D", str(tmp_path), run) == 0
    rows = read_table(spark, f"{tmp_path}/dimension_audit", schemas.DIMENSION_AUDIT).collect()
    assert sorted(r.audit_id for r in rows) == [1, 2, 3, 4, 5]
    assert sorted((r.change_type, r.record_key) for r in rows if r.audit_id > 2) == [("DELETE", "2"), ("DELETE", "3"), ("UPDATE", "1")]


def test_stored_rejects_have_ids_that_a_rerun_repeats(spark, tmp_path):
    sources = T.retail_sources(spark, "/root/testdata/sf0.001")
    first, second = (RunContext.start(RETAIL_JOB, datetime(2024, 1, d)) for d in (1, 2))
    stored = lambda: {
        (r.batch_id, r.reject_id): (r.source_table, r.primary_key_value)
        for r in read_table(spark, f"{tmp_path}/job_rejects", schemas.STORED_REJECTS).collect()
    }
    n = jobs.store_rejects(spark, sources, str(tmp_path), first)
    jobs.store_rejects(spark, sources, str(tmp_path), second)
    before = stored()
    assert sorted(i for _, i in before) == list(range(1, 2 * n + 1))
    jobs.store_rejects(spark, sources, str(tmp_path), second)
    assert stored() == before


def test_rejects_of_a_rerun_keep_their_ids_after_a_later_batch(spark, tmp_path):
    sources = T.retail_sources(spark, SF)
    first, second = (RunContext.start(RETAIL_JOB, datetime(2024, 1, d)) for d in (1, 2))
    rows = lambda: sorted(map(tuple, read_table(spark, f"{tmp_path}/job_rejects", schemas.STORED_REJECTS).collect()))
    n = jobs.store_rejects(spark, sources, str(tmp_path), first)
    jobs.store_rejects(spark, sources, str(tmp_path), second)
    before = rows()
    jobs.store_rejects(spark, sources, str(tmp_path), first)
    assert rows() == before
    more = {**sources, "product": sources["product"].union(sources["product"])}
    grown = jobs.store_rejects(spark, more, str(tmp_path), first)
    ids = [r[0] for r in rows()]
    assert grown > n and len(set(ids)) == len(ids) == n + grown
    assert sorted(ids) == [*range(n + 1, 2 * n + 1), *range(2 * n + 1, 2 * n + grown + 1)]


def test_views_in_the_catalog_match_the_functions(spark):
    refresh_table(T.job_audit_log(spark, SF), "job_audit_log_table")
    refresh_table(T.data_quality_metrics(spark, SF), "data_quality_metrics_table")
    monitoring.create_views(spark, "job_audit_log_table", "data_quality_metrics_table", T.RUN_TS)
    log, metrics = T.job_audit_log(spark, SF), T.data_quality_metrics(spark, SF)
    for name, rows in (
        ("recent_job_executions", monitoring.recent_job_executions(log, T.RUN_TS)),
        ("job_success_rate", monitoring.job_success_rate(log, T.RUN_TS)),
        ("data_quality_summary", monitoring.data_quality_summary(metrics, T.RUN_TS)),
    ):
        view = spark.table(name)
        assert view.columns == rows.columns
        assert sorted(map(repr, (tuple(map(str, r)) for r in view.collect()))) == sorted(map(repr, (tuple(map(str, r)) for r in rows.collect())))
        assert view.count() > 0
    monitoring.create_views(spark, "job_audit_log_table", "data_quality_metrics_table")
    assert spark.table("job_success_rate").count() == 0
