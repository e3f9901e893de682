import math

import numpy as np
import pytest

from martloom.llm import top_k as m


def brute(rows, k, every):
    own = [
        (i, [math.floor(1024 * x) for x in e])
        for i, e in rows
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, e in own:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(e, f, strict=True)), j) for j, f in own if j != i and len(f) == len(e))[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def found(spark, rows, k, every, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = m.whole_vectors(df)
    return sorted(tuple(r) for r in m.top_k(v, v.filter(f"vec_id % {every} = 0"), k=k, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"block": 64, "query_block": 16}])
def test_matches_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(500):
        e = [float(x) for x in rng.normal(size=8 if i % 7 else 5) * rng.exponential()]
        if i % 50 == 3:
            e[1] = [math.nan, math.inf, None][i % 3]
        rows.append((i if i % 111 else None, None if i % 70 == 9 else [0.5] * 8 if i % 30 == 0 else e))
    rows += rows[200:210] + [(900, []), (1000, [])]
    assert found(spark, rows, 4, 10, **sizes) == brute(rows, 4, 10)


def test_fewer_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, -2.0]), (2, [1.0, 2.0])]
    assert found(spark, rows, 10, 100) == brute(rows, 10, 100)
    assert found(spark, [], 10, 100) == []
    assert found(spark, [(0, None)], 10, 100) == []


def test_copies_of_the_queries_do_not_pass_through_the_driver(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    v = m.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = m.top_k(v, v.filter("vec_id % 10 = 0"), k=3, block=32, query_block=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # A copy for each block of candidates.
    assert "Generate explode" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, found.collect())) == brute(rows, 3, 10)
