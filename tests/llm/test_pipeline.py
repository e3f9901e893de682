import corpus_pipeline as pipeline
import tiktoken

from martloom.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from martloom.llm.common import held

SF = "/root/testdata/sf0.001"


def test_stages_and_run_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs, before = held(stage(spark, docs, SF), "test"), docs
        assert docs.columns == before.columns
        assert docs.exceptAll(before).count() == 0
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    vocabulary, pattern = byte_bpe.default_vocabulary()
    ranks = byte_bpe._ranks(byte_bpe.read_ranks(vocabulary))
    encode = tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    want = {r.doc_id: encode(r.text) for r in docs.collect()}
    rows = pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == want
    slots = {r.doc_id: (r.slot, r.place) for r in mixing.mixed(docs).collect()}
    in_mix = [slots[r.doc_id] for r in sorted(rows, key=lambda r: (r.mix_file, r.mix_row))]
    assert in_mix == sorted(in_mix)


def test_each_stage_takes_its_operators_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(pipeline.good(spark, docs, SF)) == ids(quality.judged(docs).filter("kept"))
    assert ids(pipeline.different(spark, docs, SF)) == ids(exact_dedup.exact_groups(docs).filter("doc_id = keep_id"))
    assert ids(pipeline.apart(spark, docs, SF)) == ids(simhash.near_groups(docs).filter("doc_id = component_id"))
    assert ids(pipeline.in_proportion(spark, docs, SF)) == ids(mixing.mixed(docs).filter("in_mix"))


def test_odd_and_empty_rows_pass(spark, odd):
    documents = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (documents, documents.limit(0)):
        for _, stage in pipeline.STAGES:
            docs = held(stage(spark, docs, SF), "test")
        assert docs.count() >= 0
