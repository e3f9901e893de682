"""From raw documents to token ids in five stages, each of which calls one text operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the
next. All but the last return the columns of documents. What each does with nulls, empty and repeated rows is said in
its operator's module; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from martloom.llm.common import held, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on these documents, doesn't reject."""
    return quality.keep_rows(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of equal texts."""
    return exact_dedup.keep_rows(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of SimHash fingerprints at two or fewer differing bits."""
    return simhash.keep_rows(docs)


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix of sources: that of the files' names and of the rows in each."""
    return mixing.keep_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, mix_file, mix_row, ids, n_tokens, text_sha256): token ids, and the hash of what they decode to.

    mix_file and mix_row are the document's place in the files that the stage before wrote, and so in the mix.
    """
    placed = docs.select(
        F.struct("doc_id", F.col("_metadata.file_name").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row")).alias("doc_id"),
        "text",
    )
    decoded = byte_bpe.decode(byte_bpe.tokens_of(spark, placed), byte_bpe.default_vocabulary()[0])
    return decoded.select(
        "doc_id.*", "ids", F.size("ids").alias("n_tokens"), F.sha2("bytes", 256).alias("text_sha256")
    )


STAGES = [("quality", good), ("exact", different), ("near", apart), ("mix", in_proportion), ("tokens", tokens)]

#: The stages learn weights, hash shingles and merge byte pairs, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
