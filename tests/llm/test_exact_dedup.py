import hashlib
from collections import defaultdict

from martloom.llm import exact_dedup as m


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return sorted(
        (repr(i), repr(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""]),
         hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in rows
    )


def found(df):
    return sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in m.exact_groups(df).collect())


def test_groups_match_brute_force(odd):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_chunks_make_up_the_text(spark, documents):
    texts = ["a" * 600 + ". " + "b" * 5000, "line\n" * 900, "", "\r\n", "😀" * 1200]
    df = documents(texts).select("text", m.chunks(m.F.col("text")).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == r.text
        assert all(0 < len(c) <= m.MOST for c in r.c)


def test_identifiers_that_collide_are_widened(documents):
    texts = [f"text number {k % 50}" for k in range(120)]
    df = documents(texts)
    assert m.verified_width(df) == 1
    assert m.verified_width(df, bits=4) > 1
    got = {(r.doc_id, r.keep_id) for r in m.exact_groups(df, bits=4).collect()}
    assert got == {(k, max(j for j in range(120) if j % 50 == k % 50)) for k in range(120)}


def test_keep_rows_keeps_one_whole_row_of_each_group(odd):
    kept = m.keep_rows(odd)
    assert kept.columns == odd.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({r.text or "" for r in odd.collect()})
    assert {r.doc_id for r in kept.collect() if r.text == "one two three"} == {2}


def test_empty_table(odd):
    assert m.exact_groups(odd.limit(0)).count() == 0
    assert m.keep_rows(odd.limit(0)).count() == 0
