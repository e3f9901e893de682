import random
from collections import defaultdict

import pytest

from martloom.llm import suffix_dedup as m

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    seen, words = defaultdict(set), {i: (t or "").encode().split() for i, t in rows}
    for i, w in words.items():
        for k in range(len(w) - least + 1):
            seen[tuple(w[k : k + least])].add(i)
    return {(i, p) for i, w in words.items() for k in range(len(w) - least + 1) if len(seen[tuple(w[k : k + least])]) > 1 for p in range(k, k + least)}


def found(df, **options):
    return {(r.doc_id, p) for r in m.repeats(df, **options).collect() for p in range(r.start, r.end)}


@pytest.mark.parametrize("range_rows", [40_000, 100])
def test_documents_match_brute_force(spark, range_rows):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()], 50)
    assert want
    assert found(df, range_rows=range_rows) == want


def test_planted_passages_among_random_words(documents):
    rng = random.Random(1)
    word = lambda: f"w{rng.randint(0, 3000)}"
    passages = [[word() for _ in range(n)] for n in (50, 51, 80, 400)]
    texts = []
    for k in range(60):
        own = [word() for _ in range(rng.randint(0, 120))]
        if k % 3 == 0:
            own[len(own) // 2 : len(own) // 2] = passages[k // 3 % 4]
        texts.append("  ".join(own))
    want = brute(list(enumerate(texts)), 50)
    assert found(documents(texts)) == want
    assert found(documents(texts), range_rows=20) == want


def test_one_passage_in_most_documents_is_cut_over_ranges(documents):
    rng = random.Random(2)
    passage = [f"p{k}" for k in range(60)]
    texts = [" ".join([f"a{rng.random()}" for _ in range(30)] + passage + [f"b{rng.random()}" for _ in range(30)]) for _ in range(90)]
    assert found(documents(texts), range_rows=7) == {(k, p) for k in range(90) for p in range(30, 90)}


def test_repeats_inside_one_document_are_none(documents):
    once = " ".join(f"w{k}" for k in range(60))
    assert found(documents([f"{once} {once}", "x " * 500])) == set()


def test_odd_rows_and_empty_table(spark, odd):
    assert found(odd) == set()
    longer = odd.union(odd.filter("doc_id = 5").withColumn("doc_id", odd.doc_id + 100))
    assert found(longer) == {(i, p) for i in (5, 105) for p in range(60_000)}
    assert m.repeats(odd.limit(0)).count() == 0
    out = m.passages(longer, m.repeats(longer)).collect()
    assert {r.passage for r in out} == {" ".join(["long"] * 60_000)}
