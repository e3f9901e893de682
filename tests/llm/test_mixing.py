from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import mixing as m


@given(st.dictionaries(st.text(max_size=3), st.floats(0, 100), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_every_prefix_is_within_a_block_of_the_target(weights):
    shares = m.whole_shares(weights, 200)
    if not shares:
        assert not any(w > 0 for w in weights.values())
        return
    table = m.one_round(shares)
    assert sum(shares.values()) == len(table) == 200
    seen = Counter()
    for source, block, slot, release, deadline in table:
        assert block == seen[source]
        assert release <= slot < deadline
        seen[source] += 1
        assert all(abs(seen[k] - (slot + 1) * w / 200) < 1 for k, w in shares.items())
    assert seen == shares


def test_blocks_follow_the_characters_before(spark):
    rows = [(k, f"s{k % 2}", "x" * (k % 37)) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    placed = m.placed(df, block_chars=100).collect()
    length = {k: len(t) for k, _, t in rows}
    by_source = defaultdict(list)
    for r in placed:
        by_source[r.source].append((r.place, r.doc_id, r.block))
    for own in by_source.values():
        before = 0
        for _, doc_id, block in sorted(own):
            assert block == before // 100
            before += length[doc_id]


def test_mix_ends_where_a_source_does(spark):
    rows = [(k, "a" if k % 4 else "b", "x" * 50) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = m.mixed(df, {"a": 1, "b": 1}, block_chars=100, resolution=10).collect()
    assert len(out) == 400
    kept = Counter(r.source for r in out if r.in_mix)
    assert kept["b"] == 100
    assert abs(kept["a"] - kept["b"]) <= 2
    slots = defaultdict(set)
    for r in out:
        slots[r.slot].add((r.source, r.block))
    assert all(len(x) == 1 for x in slots.values())


@pytest.mark.parametrize("weights", [None, {"a": 1.0, None: 1.0, "absent": 2.0}, {"b": 0.0}])
def test_odd_rows(odd, weights):
    out = m.mixed(odd, weights)
    assert out.count() == odd.count()
    kept = m.keep_rows(odd, weights)
    assert kept.columns == odd.columns
    assert kept.count() == out.filter("in_mix").count()
    assert m.keep_rows(odd.limit(0), weights).count() == 0


def test_mix_goes_on_without_a_source_that_runs_out(spark):
    sizes = {"a": 300, "b": 40, None: 1}
    rows = [(k, s, "x" * 50) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = m.mixed(df, block_chars=50, resolution=10).collect()
    assert all(r.in_mix for r in out)
    assert sorted(r.slot for r in out) == list(range(341))
    assert all(r.release <= r.slot < r.deadline for r in out)
    assert m.keep_rows(df).count() == 341
    given = m.mixed(df, {"a": 1, "b": 1}, block_chars=50, resolution=10, whole=True).collect()
    assert Counter(r.source for r in given if r.in_mix) == {"a": 300, "b": 40}
    assert abs(sum(r.source == "b" for r in given if r.slot is not None and r.slot < 60) - 30) <= 1


@given(st.dictionaries(st.text(max_size=2), st.tuples(st.integers(1, 90), st.floats(0.01, 50)), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_phases_give_each_block_one_slot(sources):
    blocks, weights = ({k: v[i] for k, v in sources.items()} for i in (0, 1))
    parts, rounds = m.phases(blocks, weights, 20)
    step_of = {(k, p, j): slot for k, p, j, slot, _, _ in rounds}
    slots = {}
    for k, p, start, stop, offset, share, length in parts:
        for j in range(start, stop):
            slots[k, j] = offset + (j - start) // share * length + step_of[k, p, (j - start) % share]
    assert set(slots) == {(k, j) for k, n in blocks.items() for j in range(n)}
    assert sorted(slots.values()) == list(range(len(slots)))
    for k, n in blocks.items():
        assert [slots[k, j] for j in range(n)] == sorted(slots[k, j] for j in range(n))
