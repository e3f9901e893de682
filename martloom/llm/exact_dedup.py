"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: a chunk ends at the first line or sentence end after `LEAST` characters,
or at `MOST` characters. Chunks are deduplicated over the whole corpus, and an identifier is verified: no two different
chunks of this corpus have the same one, else the identifier is widened by another hash and checked again. A text is
then its recipe, the ordered list of its chunks' identifiers, and two texts are equal exactly if their recipes are.
Each distinct chunk's text moves once; from then on only recipes move.

Defined results: a null text counts as empty; empty texts have an empty recipe and form one group. Of equal texts the
largest doc_id stays; a null doc_id is smaller than any other. Rows that repeat doc_id and text count as rows of their
group; `keep_rows` keeps one of them. Other columns are carried along untouched by `keep_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

LEAST = 512
MOST = 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text as an array of chunks which, put together, are the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s:.{{{least},{most}}}?(?=[\n.])|.{{1,{most}}})"), F.lit(0))


def _identifier(chunk: Column, width: int, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(F.lit(k), chunk), 64 - bits) for k in range(width)]


def verified_width(docs: DataFrame, text: str = "text", bits: int = 64) -> int:
    """How many hashes an identifier needs, so that the corpus's distinct chunks all have different ones."""
    distinct = docs.select(F.explode(chunks(text_of(text))).alias("chunk")).distinct()
    width = 1
    while True:
        keys = distinct.select(*[c.alias(f"h{k}") for k, c in enumerate(_identifier(F.col("chunk"), width, bits))])
        shared = keys.groupBy(*keys.columns).count().filter("count > 1")
        if shared.isEmpty():
            return width
        width += 1


def recipe(text: Column, width: int, bits: int = 64) -> Column:
    return F.flatten(F.transform(chunks(text), lambda c: F.array(*_identifier(c, width, bits))))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """(doc_id, recipe, text_sha256, keep_id, group_size), one row per row of docs."""
    width = verified_width(docs, text, bits)
    rows = held(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.sha2(text_of(text), 256).alias("text_sha256"),
            recipe(text_of(text), width, bits).alias("recipe"),
        ),
        "recipes",
    )
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written, the groups are an input of the join like the rows, and adaptive execution can cut a large group's rows.
    return rows.join(held(groups, "groups"), "recipe")


def keep_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One whole row of each group of equal texts: that of the largest doc_id."""
    names = docs.columns
    width = verified_width(docs, text)
    # The id as text: equal and never null, so that join and numbering share one shuffle of the texts, and the copies in
    # a group, which have different ids, don't meet in one task.
    own = docs.select(
        F.struct(*names).alias("doc"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.col(doc_id).alias("order"),
        recipe(text_of(text), width).alias("recipe"),
    )
    stays = own.groupBy("recipe").agg(F.max("order").alias("order"))
    stays = held(stays.select("recipe", F.coalesce(F.col("order").cast("string"), F.lit("")).alias("id")), "recipes")
    first = Window.partitionBy("recipe", "id").orderBy(F.lit(1))
    kept = own.drop("order").join(stays, ["recipe", "id"])
    return kept.withColumn("n", F.row_number().over(first)).filter("n = 1").select("doc.*")
