import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import jaccard_join as m
from martloom.llm import queries

SF = "/root/testdata/sf0.001"


def plain_set(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {" ".join(own[k : k + words]) for k in range(len(own) - words + 1)} or ({" ".join(own)} if own else set())


def components(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in nodes}


def brute(docs, words=4, least=(85, 100)):
    """doc_id -> (n_shingles, component_id); ids are distinct."""
    sets = {i: plain_set(t, words) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and least[1] * len(sets[a] & sets[b]) >= least[0] * len(sets[a] | sets[b])
    ]
    root = components(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries.op13_jaccard_join(spark, SF)) == brute(docs)


def edited(rng, words, edits, vocabulary=5000):
    own = list(words)
    for _ in range(edits):
        k, kind = int(rng.integers(len(own))), int(rng.integers(3))
        if kind == 0:
            own[k] = int(rng.integers(vocabulary))
        elif kind == 1 and len(own) > 1:
            del own[k]
        else:
            own.insert(k, int(rng.integers(vocabulary)))
    return own


@pytest.mark.parametrize("block", [3, 2048])
def test_chains_hot_groups_and_families(spark, block):
    """Near copies about the limit: a group of a hundred, chains, short texts, and texts that share most, but too little."""
    rng = np.random.default_rng(3)
    texts = []
    for n in (1, 3, 5, 8, 12, 30, 90, 250):
        base = rng.integers(0, 5000, n).tolist()
        texts += [edited(rng, base, int(rng.integers(0, max(2, n // 15)))) for _ in range(12)]
        chain = [base]
        for _ in range(6):
            chain.append(edited(rng, chain[-1], max(1, n // 50)))
        texts += chain
    base = rng.integers(0, 5000, 120).tolist()
    texts += [edited(rng, base, int(rng.integers(0, 3))) for _ in range(100)]
    texts += [edited(rng, base, 4) for _ in range(40)]
    passage = rng.integers(0, 5000, 50).tolist()
    texts += [[*passage, *rng.integers(0, 5000, 8).tolist()] for _ in range(40)]
    docs = [(int(k), " ".join(f"w{x}" for x in t)) for k, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    docs += [(1000 + k, docs[k][1].upper()) for k in range(0, len(docs), 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute(docs)
    assert len({c for _, c in want.values()}) < len(docs) / 2
    assert got(m.groups(df, block=block)) == want


def test_other_lengths_and_limits(spark):
    rng = np.random.default_rng(4)
    docs = []
    for _ in range(12):
        base = rng.integers(0, 50, 40).tolist()
        docs += [edited(rng, base, int(rng.integers(0, 9)), 50) for _ in range(8)]
    docs = [(k, " ".join(map(str, t))) for k, t in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for words, least in ((1, (7, 10)), (2, (1, 2)), (5, (1, 1))):
        assert got(m.groups(df, words=words, least=least)) == brute(docs, words, least)


def test_similar_sets_share_a_tile_and_pass_by_their_bitmaps():
    rng = np.random.default_rng(5)
    pairs = 0
    for trial in range(3000):
        n = int(rng.integers(1, 60 if trial % 2 else 900))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        k = int(n * rng.uniform(0, 0.2))
        more = rng.integers(0, 2**63, k, dtype=np.uint64)
        b = np.unique([a[k:], np.concatenate([a, more]), np.concatenate([rng.permutation(a)[k // 2 :], more[k // 2 :]])][trial % 3])
        if len(b) and m.similar(a, b):
            pairs += 1
            assert len(np.intersect1d(m.tiles(a), m.tiles(b)))
            x, y = (np.frombuffer(m.bitmap(s), np.uint64)[None] for s in (a, b))
            width = min(x.shape[1], y.shape[1])
            assert m.may_overlap(m.narrowed(x, width), m.narrowed(y, width), len(a), len(b))[0]
    assert pairs > 2000


def test_bands_cover_all_sizes():
    assert all(a < b <= max(a + 1, 1.3 * a) for a, b in pairwise(m._TOPS.tolist()))


def test_block_links_are_the_similar_sets():
    rng = np.random.default_rng(6)
    own = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (40, 41, 200, 210)]
    own += [own[0][1:], np.concatenate([own[2][:-1], own[1][:3]])]
    rows = pa.table({
        "i": pa.array([0] * 6, pa.int32()), "j": pa.array([0] * 6, pa.int32()), "own": pa.array([0] * 6, pa.int32()),
        "name": pa.array(range(6), pa.int64()), "root": pa.array(range(6), pa.int64()),
        "n": pa.array([len(x) for x in own], pa.int64()), "bits": pa.array([m.bitmap(np.unique(x)) for x in own], pa.binary()),
        "shingles": pa.array([np.unique(x).tobytes() for x in own], pa.binary()),
    })
    assert sorted(map(tuple, (r.values() for r in m.block_links(rows).to_pylist()))) == [(0, 4), (2, 5)]
    one = rows.set_column(4, "root", pa.array([0, 1, 2, 3, 0, 2], pa.int64()))
    assert m.block_links(one).num_rows == 0


def test_odd_rows_and_empty_table(odd):
    rows = m.groups(odd).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id in (1, 2)) == [(1, 1), (1, 1), (2, 1)]
    empty = [(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id in (3, 4, 7)]
    assert sorted(empty) == [(3, 0, 3), (4, 0, 4), (7, 0, 7)]
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id is None} == {(1, None), (0, None)}
    assert {r.doc_id: r.n_shingles for r in rows if r.doc_id in (5, 6, 8)} == {5: 1, 6: 1, 8: 3}
    assert m.groups(odd.limit(0)).count() == 0


def test_sets_that_no_pair_needs_are_left_out_before_the_join(spark):
    sets = spark.range(2000).selectExpr("xxhash64(id) AS name", "id AS n")
    names = sets.filter("n % 100 = 7").select("name")
    own = {r.n for r in m.among(sets, names).collect()}
    assert {r.n for r in sets.join(names, "name").collect()} <= own and len(own) < 200
    assert m.among(sets, names.limit(0)).count() == 0


def test_sets_that_no_pair_of_a_tile_needs_go_to_no_block_with_their_shingles(spark, monkeypatch):
    """Texts of a family share tiles and are not similar, but for two of them."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 5000, 120).tolist()
    texts = [edited(rng, base, 5) for _ in range(60)]
    texts.append(edited(rng, texts[0], 2))
    docs = [(k, " ".join(f"w{x}" for x in t)) for k, t in enumerate(texts)]
    rows, held = {}, m.held

    def counted(df, label):
        out = held(df, label)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(m, "held", counted)
    want = brute(docs)
    assert got(m.groups(spark.createDataFrame(docs, "doc_id long, text string"))) == want
    assert rows["open-tiles"] > 50 and rows["near-tiles"] < rows["open-tiles"] / 4


def test_block_near_keeps_the_rows_that_block_links_needs():
    rng = np.random.default_rng(8)
    own = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (40, 63, 200, 500)]
    own += [np.concatenate([own[1], own[0][:3]]), own[2][5:]]
    rows = {
        "tile": [9] * 6, "i": [0] * 6, "j": [1] * 6, "own": [0, 0, 0, 0, 1, 1], "name": list(range(6)), "root": list(range(6)),
        "n": [len(x) for x in own], "bits": [m.bitmap(np.unique(x)) for x in own],
    }
    assert sorted(r["name"] for r in m.block_near(pa.table(rows)).to_pylist()) == [1, 2, 4, 5]
    inside = pa.table(rows | {"j": [0] * 6, "own": [0] * 6})
    assert sorted(r["name"] for r in m.block_near(inside).to_pylist()) == [1, 2, 4, 5]
    one = pa.table(rows | {"root": [0, 1, 2, 3, 1, 2]})
    assert m.block_near(one).num_rows == 0
