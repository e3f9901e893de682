import hashlib

import numpy as np
import pytest
import tiktoken

from martloom.llm import byte_bpe as m
from martloom.llm import queries

SF = "/root/testdata/sf0.001"
VOCABULARY, PATTERN = m.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    ranks = m._ranks(m.read_ranks(VOCABULARY))
    return tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_query_matches_the_library(spark, library):
    def row(r):
        ids = library(r.text or "")
        data = (r.text or "").encode()
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        return r.doc_id, len(ids), digest, hashlib.sha256(data).hexdigest()

    want = {row(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op7_byte_bpe(spark, SF).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


@pytest.mark.parametrize("block_bytes", [1, 10_000_000])
def test_odd_rows(odd, library, monkeypatch, block_bytes):
    monkeypatch.setattr(m, "BLOCK_BYTES", block_bytes)
    rows = m.decode(m.encode(odd, VOCABULARY, PATTERN), VOCABULARY).collect()
    got = sorted((repr(r.doc_id), list(r.ids), bytes(r.bytes)) for r in rows)
    assert got == sorted((repr(r.doc_id), library(r.text or ""), (r.text or "").encode()) for r in odd.collect())


def test_white_space_and_contractions(documents, library):
    texts = ["a   b", "  \n\n  x 's ''s don't 'S", "　 x\x1c\x1dy  ", "١٢٣ ½ 日本語", " " * 900, "<|endoftext|>", "it's!'s"]
    rows = m.encode(documents(texts), VOCABULARY, PATTERN).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {k: library(t) for k, t in enumerate(texts)}


def test_empty_table_and_null_ids(spark, odd):
    assert m.encode(odd.limit(0), VOCABULARY, PATTERN).count() == 0
    rows = m.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), VOCABULARY).collect()
    assert [bytes(r.bytes) for r in rows] == [b"", b""]
