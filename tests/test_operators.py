"""Joins, routing, statistics, numbering and expressions against plain Python on small data."""

import math
import random
import statistics as st
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom import functions as X
from martloom.operators import checks, joins, numbering, routing
from martloom.operators import statistics as S
from martloom.operators.copies import collapse_copies, expand_copies


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- joins ---------------------------------------------------------------------------------------


@pytest.fixture
def sides(spark):
    left = [(1, "a"), (1, "b"), (2, "c"), (None, "n"), (5, "e")] + [(7, f"h{i}") for i in range(30)]
    right = [(1, 10), (2, 20), (2, 21), (None, 99), (6, 60), (7, 70)]
    return (
        spark.createDataFrame(left, "k INT, l STRING"),
        spark.createDataFrame(right, "k INT, r INT"),
    )


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_full_join_equals_the_builtin_one(sides, hot):
    left, right = sides
    expected = left.join(right, "k", "full").select("k", "l", "r")
    assert rows(joins.equi_join(left, right, ["k"], "full", hot=hot)) == rows(expected)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_case_insensitive_join(spark, how):
    left = spark.createDataFrame([("Ab", 1), ("x", 2), (None, 3)], "k STRING, l INT")
    right = spark.createDataFrame([("aB", 10), ("Y", 20)], "k STRING, r INT")
    got = rows(joins.equi_join(left, right, ["k"], how, ignore_case=True))
    matched = {("Ab", 1, 10): 1}
    only_left = {("x", 2, None): 1, (None, 3, None): 1} if how in ("left", "full") else {}
    only_right = {("Y", None, 20): 1} if how in ("right", "full") else {}
    assert got == {**matched, **only_left, **only_right}


def test_join_all_needs_two(sides):
    with pytest.raises(ValueError):
        joins.join_all([sides[0]], ["k"])


def test_orphans_ignore_null_keys_and_count_rows(sides):
    left, right = sides
    assert rows(joins.orphans(left, "k", right, "k")) == {(5, 1): 1}


# --- routing -------------------------------------------------------------------------------------


@pytest.fixture
def routed(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, None), (4, 500)], "id INT, v INT")
    return df, {"small": F.col("v") < 100, "tiny": F.col("v") < 10}


def test_routes(routed):
    df, routes = routed
    pick = lambda **o: sorted((r["id"], r["route"]) for r in routing.route(df, routes, **o).collect())
    assert pick() == [(1, "small"), (1, "tiny"), (2, "small")]
    assert pick(first_only=True) == [(1, "small"), (2, "small")]
    assert pick(rejects=True) == [(1, "small"), (1, "tiny"), (2, "small"), (3, "reject"), (4, "reject")]
    assert pick(first_only=True, rejects=True) == [(1, "small"), (2, "small"), (3, "reject"), (4, "reject")]


def test_split_outputs(routed):
    df, routes = routed
    ids = lambda parts: {k: sorted(r["id"] for r in v.collect()) for k, v in parts.items()}
    assert ids(routing.split(df, routes)) == {"small": [1, 2], "tiny": [1], "reject": [3, 4]}
    assert ids(routing.split(df, routes, first_only=True)) == {"small": [1, 2], "tiny": [], "reject": [3, 4]}


# --- statistics ----------------------------------------------------------------------------------

VALUES = {"a": [3, 5, None, 9, 5], "one": [4], "two": [1, 2], "none": [None, None], "zero": [0, 0, 0]}


def data(spark):
    return spark.createDataFrame([(g, v) for g, vs in VALUES.items() for v in vs], "g STRING, x INT")


def near(a, b):
    return a is None and b is None or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-9))


@pytest.mark.parametrize("null_result", [True, False])
def test_statistics_of_edge_groups(spark, null_result):
    options = S.StatisticsOptions(null_result=null_result)
    got = {r["g"]: r for r in S.group_statistics(data(spark), ["g"], "x", S.STATISTICS, options).collect()}
    for g, values in VALUES.items():
        xs = [v for v in values if v is not None]
        r = got[g]
        empty = None if null_result else 0
        assert (r["x_count"], r["x_missing"]) == (len(xs), len(values) - len(xs))
        assert near(r["x_min"], min(xs) if xs else empty) and near(r["x_max"], max(xs) if xs else empty)
        assert near(r["x_sum"], sum(xs) if xs else empty) and near(r["x_mean"], st.mean(xs) if xs else empty)
        assert near(r["x_uss"], sum(x * x for x in xs) if xs else None)
        assert near(r["x_css"], sum((x - st.mean(xs)) ** 2 for x in xs) if xs else None)
        var = st.variance(xs) if len(xs) > 1 else (None if xs else empty)
        assert near(r["x_var"], var)
        assert near(r["x_std"], math.sqrt(var) if var is not None else None)
        if len(xs) > 1 and st.mean(xs):
            assert near(r["x_cv"], 100 * st.stdev(xs) / st.mean(xs))
            assert near(r["x_ste"], st.stdev(xs) / math.sqrt(len(xs)))


def test_weights_missing_value_and_divisor(spark):
    df = spark.createDataFrame([(2, 3), (4, 0), (-1, 5), (10, None)], "x INT, w INT")
    options = S.StatisticsOptions(weight="w", missing_value=-1, null_result=True)
    r = S.group_statistics(df, [], "x", ["count", "missing", "sum", "sumw", "mean", "uss"], options).first()
    assert (r["x_count"], r["x_missing"], r["x_sum"], r["x_sumw"], r["x_mean"], r["x_uss"]) == (3, 1, 6, 3, 2, 12)
    zero = S.group_statistics(df.filter("w = 0"), [], "x", ["mean"], options).first()
    assert zero["x_mean"] is None
    divided = S.group_statistics(df, [], "x", ["var"], S.StatisticsOptions(missing_value=-1, record_divisor=True)).first()
    assert near(divided["x_var"], sum((x - 16 / 3) ** 2 for x in (2, 4, 10)) / 4)


def test_decimal_output_and_kept_type(spark):
    options = S.StatisticsOptions(decimal=(8, 2), keep_type=True)
    out = S.group_statistics(data(spark), ["g"], "x", ["mean", "max"], options)
    assert dict(out.dtypes) == {"g": "string", "x_mean": "decimal(8,2)", "x_max": "int"}


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        S.group_statistics(data(spark), ["g"], "x", ["median"])


def test_merged_summaries_equal_direct_ones(spark):
    rng = random.Random(5)
    base = 1_000_000
    raw = [("g%d" % rng.randrange(4), base + rng.randrange(100) if rng.random() > 0.2 else None, rng.randrange(9)) for _ in range(400)]
    raw += [("empty", None, p) for p in range(3)] + [(None, 5, 1), (None, 7, 2)]
    df = spark.createDataFrame(raw, "g STRING, x INT, part INT")
    direct = {r["g"]: r["summary"].asDict() for r in S.summarize(df, ["g"], "x").collect()}
    merged = {
        r["g"]: r["summary"].asDict() for r in S.merge_summaries(S.summarize(df, ["g", "part"], "x"), ["g"]).collect()
    }
    assert direct.keys() == merged.keys()
    for g, expected in direct.items():
        assert list(expected) == S.SUMMARY_FIELDS
        for field in S.SUMMARY_FIELDS:
            a, b = merged[g][field], expected[field]
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6), (g, field, a, b)


# --- numbering and copies ---------------------------------------------------------------------------


def test_numbers_by_key_follow_the_key_order(spark):
    keys = [5, -3, 2_500_000, 1_000_000, 999_999, 7_000_000_001, 2**53 + 1, 2**53 + 2, 2**60 + 3]
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    got = {r["k"]: r["id"] for r in numbering.number_by_key(df, "k", "id", after=100).collect()}
    assert got == {k: 101 + i for i, k in enumerate(sorted(keys))}


def test_numbers_of_rows_are_consecutive_even_for_copies(spark):
    df = spark.range(300).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 == 0, "same").alias("b"))
    out = numbering.number_rows(df, "id", after=10, rows_per_bucket=5)
    assert sorted(r["id"] for r in out.collect()) == list(range(11, 311))
    assert rows(out.drop("id")) == rows(df)


def test_copies_are_packed_and_unpacked(spark):
    df = spark.createDataFrame([(1, None)] * 25 + [(2, "x")], "a INT, b STRING")
    packed = collapse_copies(df, chunk=10)
    assert sorted((r["a"], r["_chunk"], r["_copies"]) for r in packed.collect()) == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 1)]
    assert rows(expand_copies(packed)) == rows(df)


def test_next_key_of_nothing(spark):
    empty = spark.createDataFrame([], "policy_key BIGINT")
    assert spark.range(1).select(numbering.next_key(empty, "policy_key").alias("k")).first()["k"] == 0


# --- checks ---------------------------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "b"), (2, "z")], "k INT, v STRING")
    assert rows(checks.not_null(df, "T", ["k", "v"])) == {("T", "k", 5, 2): 1, ("T", "v", 5, 1): 1}
    assert rows(checks.duplicates(df, "T", ["k"])) == {("T", "k", "1", 2): 1}
    assert rows(checks.duplicates(df, "T", ["k", "v"])) == {}
    assert rows(checks.outside_values(df, "T", "v", ["a", "b"])) == {("T", "v", "z", 1): 1}


# --- expressions ------------------------------------------------------------------------------------------


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_integers_from_text(spark):
    texts = {"12": (12, 12), "-7": (-7, -7), "12.7": (None, 13), "1e3": (None, 1000), "": (None, None), "x": (None, None),
             "2147483648": (None, None)}
    for text, (plain, rounded) in texts.items():
        assert one(spark, X.int_or_null(F.lit(text))) == plain, text
        assert one(spark, X.int_or_null(F.lit(text), rounding=True)) == rounded, text


def test_seconds_count_boundaries_and_ignore_the_zone(spark):
    def stamp(text):
        return F.lit(text).cast("timestamp_ntz")

    assert one(spark, X.seconds_between(stamp("2024-01-01 00:00:00.9"), stamp("2024-01-01 00:00:02.1"))) == 2
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        crossing = X.seconds_between(stamp("2024-03-10 01:00:00"), stamp("2024-03-10 04:00:00"))
        assert one(spark, crossing) == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_of_a_time_the_session_zone_skips(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        skipped = F.lit("2024-03-10 02:30:00.5").cast("timestamp_ntz")
        assert one(spark, X.batch_id_of(skipped)) == "BATCH_20240310023000"
        assert one(spark, X.date_text(skipped)) == "2024-03-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_batch_id_and_percent(spark):
    assert one(spark, X.batch_id_of(F.lit("2024-01-31 12:00:05").cast("timestamp_ntz"))) == "BATCH_20240131120005"
    assert float(one(spark, X.percent(F.lit(2), F.lit(3)))) == 66.67


@pytest.mark.parametrize("op,nulls,expected", [("<", "first", True), ("<", "last", False), (">", "last", True),
                                               (">=", "first", False), ("=", "first", False), ("<>", "last", True)])
def test_null_takes_a_side_in_comparisons(spark, op, nulls, expected):
    assert one(spark, X.compare_with_nulls(F.lit(None).cast("int"), op, 5, nulls)) is expected


def test_differs_is_null_safe(spark):
    null = F.lit(None).cast("int")
    assert one(spark, X.differs(null, F.lit(1))) is True
    assert one(spark, X.differs(null, null)) is False
    assert one(spark, X.differs(F.lit(1), F.lit(1))) is False


def test_exact_and_contained_customer_types(spark):
    assert one(spark, X.names_customer_type(F.lit("Non-Citizen"))) is True
    assert one(spark, X.is_customer_type(F.lit("Non-Citizen"))) is False


def test_run_context_is_one_clock(spark):
    from martloom.context import RunContext

    run = RunContext.start("J", run_ts=datetime(2024, 1, 31, 12, 0, 0), log_path="/x")
    assert run.batch_id == "BATCH_20240131120000" and run.parameters["log_path"] == "/x"
    assert one(spark, run.now) == datetime(2024, 1, 31, 12, 0, 0)
    assert run.with_job("K").batch_id == run.batch_id
