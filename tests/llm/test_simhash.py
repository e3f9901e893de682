import re

import numpy as np
import pytest
import xxhash

from martloom.llm import queries
from martloom.llm import simhash as m
from martloom.llm.common import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, words=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(own[k : k + words]) for k in range(len(own) - words + 1)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(fps, budget=2):
    fps = list(fps)
    return [(a, b) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= budget]


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    root = roots(set(docs.values()), near(set(docs.values())))
    least = {}
    for i, fp in docs.items():
        least[root[fp]] = min(i, least.get(root[fp], i))
    want = {(i, f"{fp:016x}", least[root[fp]]) for i, fp in docs.items()}
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in queries.op5_simhash(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("used", [0, 1, 2])
def test_trie_pairs_match_all_pairs(used):
    rng = np.random.default_rng(used)
    base = rng.integers(0, 2**50, 40, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 50, 40).astype(np.uint64)) for _ in range(6)]
    a = np.unique(np.concatenate([base, *flips]))
    b = np.unique(np.concatenate([flips[0], base])) | np.uint64(((1 << used) - 1) << 58)
    got = {(int(a[x]), int(b[y])) for i, j in m.trie_pairs(a, b, 6, used) for x, y in zip(i, j, strict=True)}
    assert got == {(int(x), int(y)) for x in a for y in b if (int(x) ^ int(y)).bit_count() <= 2}
    if not used:
        own = {(int(a[x]), int(a[y])) for i, j in m.trie_pairs(a, None, 6, 0) for x, y in zip(i, j, strict=True)}
        assert own == {(int(x), int(y)) for k, x in enumerate(a) for y in a[k + 1 :] if (int(x) ^ int(y)).bit_count() <= 2}


def test_links_connect_a_node_that_is_cut_into_parts(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    fps = [base, rng.integers(0, 2**63, 300, dtype=np.uint64)]
    fps += [base ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) for _ in range(20)]
    fps = sorted(int(x) for x in np.unique(np.concatenate(fps)).view(np.int64))
    rows = m.links(spark.createDataFrame([(x,) for x in fps], "fp long"), node=32, part=8).collect()
    unsigned = {x: x % 2**64 for x in fps}
    want = roots(unsigned.values(), near(unsigned.values()))
    assert roots(unsigned.values(), [(unsigned[r.a], unsigned[r.b]) for r in rows]) == want
    assert len(rows) < 10 * len(fps)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_odd_rows(odd):
    rows = m.near_groups(odd).collect()
    assert len(rows) == odd.count()
    zero = {r.component_id for r in rows if r.fp == 0}
    assert zero == {3}
    assert all(r.component_id == 1 for r in rows if r.doc_id in (1, 2))
    kept = m.keep_rows(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.root for r in rows})
    assert m.keep_rows(odd, words=5, budget=6).count() == len({r.root for r in m.near_groups(odd, words=5, budget=6).collect()})


def test_long_texts_and_empty_table(odd):
    assert m.fingerprint(b"a b c " * 30_000) == plain_fingerprint("a b c " * 30_000)
    assert m.near_groups(odd.limit(0)).count() == 0
    assert m.keep_rows(odd.limit(0)).count() == 0
