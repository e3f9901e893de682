import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from martloom.llm import queries
from martloom.llm import resample as m

SF = "/root/testdata/sf0.01"


def features(text, lengths=(1, 1)):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + k]) for k in range(lengths[0], lengths[1] + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def brute(docs, targets, percent=10, least=20, buckets=10_000, lengths=(1, 1)):
    of_doc = [(i, *features(t, lengths)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, f in of_doc:
        for h in f:
            s[h % buckets] += 1
    for text in targets:
        for h in features(text, lengths)[1]:
            t[h % buckets] += 1
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, f in of_doc:
        w = sum(gain[h % buckets] for h in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = {id(r): k for k, r in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted((tuple([*r[:4], drawn.get(id(r))]) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs, target = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert got(queries.op12_resample(spark, SF)) == want


@pytest.mark.parametrize("buckets", [1, 63, 64, 1000])
def test_planes_give_the_sum_of_products(buckets):
    rng = np.random.default_rng(buckets)
    for most in (1, 2, 300, 10**6):
        counts, gain = rng.integers(0, most, buckets), rng.integers(-9000, 9000, buckets)
        up, down = m.planes(np.maximum(gain, 0)), m.planes(np.maximum(-gain, 0))
        assert m.weight(counts, up, down) == int((counts * gain).sum())


def test_ranges_ties_longer_runs_and_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(m, "ROWS_PER_RANGE", 3)
    target = spark.createDataFrame([("one two", 1), (None, 2), ("", 3)], "text string, score int")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for lengths in ((1, 1), (1, 3), (2, 2)):
        found = m.resampled(odd, target, percent=60, least_words=1, buckets=50, lengths=lengths)
        assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert got(found) == brute(rows, ["one two", None, ""], 60, 1, 50, lengths)


def test_empty_tables(spark, odd):
    target = spark.createDataFrame([("one two",)], "text string")
    assert m.resampled(odd.limit(0), target).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(m.resampled(odd, target.limit(0), percent=100)) == brute(rows, [], 100)
