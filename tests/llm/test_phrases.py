import re
from collections import Counter, defaultdict

import pytest

from martloom.llm import phrases as m


def brute(rows, least=30, longest=4, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    want = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            longer = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= 80 * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            want.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(want)


def got(df, **kw):
    return sorted(tuple(r) for r in m.collocations(df, **kw).collect())


TEXTS = [
    "The cat sat on the mat. The cat sat, on the\tmat; THE CAT SAT on a mat!",
    "new york city is new york city is new york\nnew york new york : new york city hall",
    "été l'été l'été l'été l'été 日本 日本 日本 日本 Éa Éa Éa éa",
    "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a",
]


@pytest.mark.parametrize("least,every", [(2, 2), (3, 16), (5, 1)])
def test_matches_brute_force(spark, monkeypatch, least, every):
    monkeypatch.setattr(m, "BLOCK_WORDS", 40)
    monkeypatch.setattr(m, "BUCKET", 16)
    rows = [(lang, t) for k, t in enumerate(TEXTS * 3) for lang in (None, "en", f"l{k % 2}")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert got(df, least=least, every=every) == brute(rows, least)


def test_ties_and_the_first_ranks(spark):
    rows = [("en", " ".join(f"w{k} v{k}." for k in range(50)))] * 4
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(df, least=4, top=7) == brute(rows, 4, top=7)


def test_each_occurrence_belongs_to_one_chunk():
    words = [b"w%d" % (k * k % 37) for k in range(500)]
    for every in (1, 2, 16, 10**9):
        begun, at = [], 0
        for own, chunk in m.parse(words, 4, every):
            inside = chunk.split(b" ")
            assert inside == words[at : at + own + 3]
            begun += range(at, at + own)
            at += own
        assert begun == list(range(len(words)))


def test_odd_rows_and_empty_table(odd):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert got(odd, least=2) == brute(rows, 2)
    assert got(odd.limit(0)) == []
