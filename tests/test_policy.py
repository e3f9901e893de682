"""The Type 2 load: every case, reruns, refusals, and invariants after loads of random changes."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import schemas
from martloom.context import POLICY_JOB, RunContext
from martloom.operators import bloom
from martloom.plans import jobs, policy_store, scd2
from martloom.sources.tables import due_policies
from tests.rows import frame

RUN = RunContext.start(POLICY_JOB, run_ts=datetime(2024, 1, 31, 12), run_date=date(2024, 1, 31))
BASE = {"policy_holder_name": "H", "policy_type": "T", "premium_amount": Decimal("1.00"), "start_date": date(2020, 1, 1),
        "end_date": None, "updated_date": datetime(2024, 1, 1), "source_system": "POLICY_SYS"}


def source(spark, *rows):
    return frame(spark, schemas.POLICY_SRC, [{**BASE, **r} for r in rows])


def dimension(spark, *rows):
    filled = {"effective_from": date(2023, 1, 1), "current_flag": "Y", "version_no": 1, "batch_id": "B0"}
    return frame(spark, schemas.DIM_POLICY, [{**BASE, **filled, **r} for r in rows])


@pytest.mark.parametrize(
    "change",
    [
        {"policy_holder_name": "G"},
        {"policy_holder_name": None},
        {"policy_type": "U"},
        {"premium_amount": Decimal("1.01")},
        {"start_date": date(2020, 1, 2)},
        {"end_date": date(2025, 1, 1)},
    ],
)
def test_each_attribute_alone_makes_a_new_version(spark, change):
    src = source(spark, {"policy_id": 1, **change})
    dim = dimension(spark, {"policy_key": 9, "policy_id": 1, "version_no": 3})
    (new,) = scd2.with_keys(scd2.inserts(src, dim, RUN), dim).collect()
    assert (new["policy_key"], new["version_no"], new["effective_from"], new["effective_to"], new["current_flag"]) == (
        10, 4, date(2024, 1, 31), None, "Y")
    (old,) = scd2.expired(src, dim, RUN).collect()
    assert (old["policy_key"], old["current_flag"], old["effective_to"], old["version_no"], old["batch_id"]) == (
        9, "N", date(2024, 1, 30), 3, "B0")


def test_value_to_null_to_value_and_unchanged(spark):
    dim = dimension(spark, {"policy_key": 1, "policy_id": 1, "end_date": date(2025, 1, 1)}, {"policy_key": 2, "policy_id": 2})
    src = source(spark, {"policy_id": 1, "end_date": None}, {"policy_id": 2, "updated_date": datetime(2024, 1, 5)})
    flags = {r["policy_id"]: r for r in scd2.classify(src, dim).collect()}
    assert flags[1]["changed"] and not flags[1]["unchanged"]
    assert flags[2]["unchanged"] and not flags[2]["changed"]


def test_null_key_is_new_but_rejected_and_never_inserted(spark):
    src, dim = source(spark, {"policy_id": None}, {"policy_id": 5}), dimension(spark)
    flags = {r["policy_id"]: r for r in scd2.classify(src, dim).collect()}
    assert flags[None]["new_record"] and not flags[None]["valid"]
    assert [r["policy_id"] for r in scd2.inserts(src, dim, RUN).collect()] == [5]
    (bad,) = scd2.rejects(src).collect()
    assert bad["error_desc"] == "POLICY_ID is NULL" and "policy_id" not in bad["raw_data"]
    counts = scd2.audit_counts(src, dim).first()
    assert (counts["source_count"], counts["target_inserts"], counts["target_updates"], counts["reject_count"]) == (2, 1, 0, 1)


def test_updates_after_the_run_date_wait(spark):
    src = source(spark, {"policy_id": 1, "updated_date": datetime(2024, 1, 31)},
                 {"policy_id": 2, "updated_date": datetime(2024, 1, 31, 0, 0, 1)})
    assert [r["policy_id"] for r in due_policies(src, RUN.run_date).collect()] == [1]


def test_dimension_rows_absent_from_the_source_stay(spark):
    dim = dimension(spark, {"policy_key": 1, "policy_id": 1}, {"policy_key": 2, "policy_id": 2, "current_flag": "N"})
    image = scd2.full_image(source(spark), dim, RUN)
    assert sorted((r["policy_key"], r["current_flag"]) for r in image.collect()) == [(1, "Y"), (2, "N")]


def test_full_image_equals_its_parts(spark):
    dim = dimension(spark, *[{"policy_key": i, "policy_id": i} for i in range(1, 6)])
    src = source(spark, {"policy_id": 1}, {"policy_id": 2, "policy_type": "Z"}, {"policy_id": 8}, {"policy_id": None})
    image = scd2.full_image(src, dim, RUN)
    parts = scd2.expired(src, dim, RUN).unionByName(scd2.with_keys(scd2.inserts(src, dim, RUN), dim)).unionByName(
        dim.filter("policy_id <> 2"))
    assert image.exceptAll(parts.select(*image.columns)).isEmpty() and image.count() == parts.count() == 7


def test_repeated_source_policy_is_refused(spark):
    with pytest.raises(scd2.PolicyLoadError, match="more than once"):
        scd2.check_versions(scd2.versions(source(spark, {"policy_id": 1}, {"policy_id": 1}), dimension(spark), RUN), RUN)
    stored = dimension(spark, {"policy_key": 1, "policy_id": 1})
    with pytest.raises(scd2.PolicyLoadError, match="more than once"):
        scd2.check_versions(scd2.versions(source(spark, {"policy_id": 1}, {"policy_id": 1}), stored, RUN), RUN)


def check_invariants(dim):
    rows = sorted(dim.collect(), key=lambda r: (r["policy_id"], r["version_no"]))
    assert len({r["policy_key"] for r in rows}) == len(rows)
    by_policy = {}
    for r in rows:
        by_policy.setdefault(r["policy_id"], []).append(r)
    for versions in by_policy.values():
        assert [v["version_no"] for v in versions] == list(range(1, len(versions) + 1))
        assert [v["current_flag"] for v in versions] == ["N"] * (len(versions) - 1) + ["Y"]
        assert versions[-1]["effective_to"] is None
        for a, b in zip(versions, versions[1:]):
            assert a["effective_from"] <= a["effective_to"] < b["effective_from"]


def test_successive_loads(spark, tmp_path):
    rng = random.Random(3)
    root, logs = str(tmp_path / "mart"), str(tmp_path / "logs")
    state = {}
    for day in (date(2024, 2, 1), date(2024, 2, 10), date(2024, 2, 20)):
        for key in rng.sample(range(1, 60), 25):
            state[key] = {"policy_id": key, "policy_type": rng.choice("ABC")}
        run = RunContext.start(POLICY_JOB, run_ts=datetime(day.year, day.month, day.day, 6), run_date=day)
        src = source(spark, *state.values(), {"policy_id": None})
        jobs.run_policy_load(spark, src, root, run, logs)
        dim = jobs.policy_dimension(spark, root)
        check_invariants(dim)
        current = {r["policy_id"]: r["policy_type"] for r in scd2.current_rows(dim).collect()}
        assert current == {k: v["policy_type"] for k, v in state.items()}
    before = dim.count()
    jobs.run_policy_load(spark, src, root, run, logs)
    assert jobs.policy_dimension(spark, root).count() == before
    with pytest.raises(scd2.PolicyLoadError, match="already versioned"):
        jobs.run_policy_load(spark, source(spark, *[{"policy_id": k, "policy_type": "Q"} for k in state]), root, run, logs)
    assert jobs.policy_dimension(spark, root).count() == before
    log = spark.read.parquet(f"{root}/etl_audit_log")
    states = {r["status"]: r["count"] for r in log.groupBy("status").count().collect()}
    assert states == {"RUNNING": 5, "SUCCESS": 4, "FAILED": 1}
    assert spark.read.text(f"{logs}/dim_policy_rejects_2024-02-20").filter(F.col("value").startswith(',"x')).count() == 0
    assert [r["value"].split("|")[1] for r in spark.read.text(f"{logs}/dim_policy_rejects_2024-02-20").collect()] == [
        '"POLICY_ID is NULL"']


def test_load_of_nothing_and_then_something(spark, tmp_path):
    root, logs = str(tmp_path / "mart"), str(tmp_path / "logs")
    jobs.run_policy_load(spark, source(spark), root, RUN, logs)
    assert jobs.policy_dimension(spark, root).count() == 0
    later = RunContext.start(POLICY_JOB, run_ts=datetime(2024, 2, 1, 12), run_date=date(2024, 2, 1))
    jobs.run_policy_load(spark, source(spark, {"policy_id": 4}), root, later, logs)
    (row,) = jobs.policy_dimension(spark, root).collect()
    assert (row["policy_key"], row["policy_id"], row["version_no"]) == (1, 4, 1)
    log = spark.read.parquet(f"{root}/etl_audit_log").filter("status = 'SUCCESS'").orderBy("start_time")
    assert [r["target_inserts"] for r in log.collect()] == [0, 1]


def load(spark, root, day, *rows):
    run = RunContext.start(POLICY_JOB, run_ts=datetime(2024, 3, day, 6), run_date=date(2024, 3, day))
    jobs.run_policy_load(spark, source(spark, *rows), str(root / "mart"), run, str(root / "logs"))


def files(root):
    return {p: p.stat().st_mtime_ns for p in (root / "mart/dim_policy/current").rglob("*.parquet")}


def test_a_load_leaves_untouched_buckets_and_history_alone(spark, tmp_path):
    load(spark, tmp_path, 1, *[{"policy_id": k} for k in range(40)])
    load(spark, tmp_path, 2, *[{"policy_id": k, "policy_type": "U"} for k in range(5)])
    before, history = files(tmp_path), {p: p.stat().st_mtime_ns for p in (tmp_path / "mart/dim_policy/closed").rglob("*.parquet")}
    load(spark, tmp_path, 3, {"policy_id": 7, "policy_type": "V"})
    after = files(tmp_path)
    bucket = spark.createDataFrame([(7,)], "policy_id long").select(policy_store.bucket_of("policy_id")).first()[0]
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {f"bucket={bucket}"}
    assert all(after[p] == before[p] for p in before.keys() & after.keys())
    assert all(p.stat().st_mtime_ns == t for p, t in history.items())
    dim = policy_store.dimension(spark, str(tmp_path / "mart"))
    check_invariants(dim)
    assert dim.count() == 46
    assert sorted(r["policy_key"] for r in dim.collect()) == list(range(1, 47))
    assert not (tmp_path / "mart/dim_policy/aside").exists() or not any((tmp_path / "mart/dim_policy/aside").iterdir())


def test_only_touched_buckets_are_read(spark, tmp_path):
    load(spark, tmp_path, 1, *[{"policy_id": k} for k in range(40)])
    rows = policy_store.current(spark, str(tmp_path / "mart"), [3, 5])
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "bucket" in text.split("PartitionFilters")[1]
    kept = {r["policy_id"] for r in rows.collect()}
    everything = policy_store.current(spark, str(tmp_path / "mart"))
    assert kept == {r["policy_id"] for r in everything.filter(policy_store.bucket_of("policy_id").isin(3, 5)).collect()}


@pytest.mark.parametrize("step", ["refresh_path", "scd2.keyed_after", "drop"])
def test_a_load_that_broke_off_is_completed_by_the_next(spark, tmp_path, monkeypatch, step):
    load(spark, tmp_path, 1, *[{"policy_id": k} for k in range(12)])

    def broken(*args, **kwargs):
        raise RuntimeError("machine went away")

    with monkeypatch.context() as m:
        m.setattr(f"martloom.plans.policy_store.{step}", broken)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path, 2, *[{"policy_id": k, "policy_type": "U"} for k in range(6)], {"policy_id": 50})
    load(spark, tmp_path, 3, {"policy_id": 1, "policy_type": "W"}, {"policy_id": 51})
    dim = policy_store.dimension(spark, str(tmp_path / "mart"))
    check_invariants(dim)
    versions = {}
    for r in dim.collect():
        versions.setdefault(r["policy_id"], []).append(r["policy_type"])
    assert sorted(versions[1]) == ["T", "U", "W"] and sorted(versions[2]) == ["T", "U"]
    assert versions[7] == ["T"] and versions[50] == ["T"] and versions[51] == ["T"]


def test_a_rerun_of_a_batch_keeps_what_it_closed_before(spark, tmp_path):
    load(spark, tmp_path, 1, *[{"policy_id": k} for k in range(4)])
    load(spark, tmp_path, 2, {"policy_id": 1, "policy_type": "U"})
    load(spark, tmp_path, 2, {"policy_id": 1, "policy_type": "U"}, {"policy_id": 2, "policy_type": "U"})
    dim = policy_store.dimension(spark, str(tmp_path / "mart"))
    check_invariants(dim)
    assert dim.count() == 6


def test_bloom_filter_keeps_all_keys_and_few_others(spark):
    own = spark.range(0, 30_000, 3).withColumn("id", F.when(F.col("id") % 10 != 0, F.col("id")))
    keys = own.filter("id IS NOT NULL").count()
    words = bloom.words_for(keys)
    test = bloom.may_contain(bloom.bloom_filter(own, "id", words), F.col("id"), words)
    inside = own.filter("id IS NOT NULL").filter(~test)
    assert inside.count() == 0
    others = spark.range(100_000, 150_000)
    assert others.filter(test).count() < 0.03 * 50_000
    assert own.filter("id IS NULL").filter(test).count() == 0
    assert others.filter(bloom.may_contain(bloom.bloom_filter(own.limit(0), "id", 16), F.col("id"), 16)).count() == 0


def test_about_as_many_rows_as_are_due_enter_the_join(spark):
    dim = dimension(spark, *[{"policy_key": k, "policy_id": k} for k in range(5000)])
    src = source(spark, *[{"policy_id": k, "policy_type": "U"} for k in range(0, 5000, 100)], {"policy_id": 9999})
    assert 50 <= scd2.lookup(src, dim, 51).count() <= 200
    assert scd2.classify(src, scd2.lookup(src, dim, 51)).exceptAll(scd2.classify(src, dim)).count() == 0
    rows = scd2.load_versions(src, dim, RUN, 51)
    assert rows.exceptAll(scd2.versions(src, dim, RUN)).count() == 0 and rows.count() == 5051
