"""Importance resampling towards a target distribution, with bit-sliced weights.

A document is its counts of hashed features in `buckets` buckets. A bucket's gain is the logarithm of its share in the
target texts over its share in all documents, as a whole number. A document's counts are written as bit planes, plane i
holding bit i of every bucket's count, and the gains as planes of their positive and of their negative parts. The sum of
count times gain is then the sum over all pairs of planes of the bits that both have, times a power of two, positive gains
less negative ones: whole numbers throughout, so the weight is exact.

Documents of enough words draw by weight plus Gumbel noise from a hash of their id: the highest scores are a sample
without replacement in proportion to the weights. They are ranked by ranges of the score that are sorted apart, so no task
sees all of them.

Defined results: a null text has no words and weight zero. A null id is hashed as empty text and precedes other ids among
equal scores. Repeated rows are drawn and ranked each for itself, in any order among themselves. Without target texts, all
gains come from the documents alone. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

BUCKETS = 10_000
#: Shortest and longest runs of words that are features.
LENGTHS = (1, 1)
PERCENT, LEAST_WORDS, SEED = 10, 20, "2024"
#: Drawn rows of a range that is sorted for itself.
ROWS_PER_RANGE = 200_000
_GONE = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_WORDS = bytes.maketrans(_GONE, bytes(c + 32 if 65 <= c <= 90 else 32 for c in _GONE))


def bucket_counts(text: bytes, buckets: int = BUCKETS, lengths: tuple[int, int] = LENGTHS) -> tuple[np.ndarray, int, int]:
    """(counts by bucket, features, words) of a text: words are runs of ASCII letters, digits and characters beyond ASCII."""
    words = text.translate(_WORDS).split()
    counts, features = np.zeros(buckets, np.int64), 0
    for size in range(lengths[0], lengths[1] + 1):
        runs = words if size == 1 else map(b" ".join, zip(*[words[k:] for k in range(size)], strict=False))
        found = Counter(runs)
        at = np.fromiter(map(crc32, found), np.int64, len(found)) % buckets
        np.add.at(counts, at, np.fromiter(found.values(), np.int64, len(found)))
        features += max(0, len(words) - size + 1)
    return counts, features, len(words)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Row i has bit i of each number, 64 numbers a word; as many rows as the largest number has bits."""
    rows = max(1, int(numbers.max(initial=0)).bit_length())
    bits = (numbers[None, :] >> np.arange(rows)[:, None]).astype(np.uint8) & 1
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def weight(counts: np.ndarray, up: np.ndarray, down: np.ndarray) -> int:
    """The sum of counts by gains, from the planes of both."""
    own = planes(counts)
    total = 0
    for gains, sign in ((up, 1), (down, -1)):
        both = np.bitwise_count(own[:, None, :] & gains[None, :, :]).sum(axis=2, dtype=np.int64)
        total += sign * sum(int(n) << (i + j) for (i, j), n in np.ndenumerate(both))
    return total


def totals(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, lengths: tuple[int, int] = LENGTHS) -> np.ndarray:
    """Features by bucket over all texts; a task hands on one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for body in batch.column(0).slice(start, 256).to_pylist():
                    own += bucket_counts(body, buckets, lengths)[0]
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], ["bucket", "n"])

    rows = texts.select(text_of(text).cast("binary").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    found = np.zeros(buckets, np.int64)
    # At most one row a bucket.
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[r["bucket"]] = r["n"]
    return found


def gains(all_texts: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed share in the target / smoothed share in all texts)) of each bucket."""
    n, t, k = int(all_texts.sum()), int(target.sum()), len(all_texts)
    own = zip(all_texts.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log(((b + 1) * (n + k)) / ((a + 1) * (t + k)))) for a, b in own], np.int64)


def noise(seed: str, doc_id: str) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    lengths: tuple[int, int] = LENGTHS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row of docs."""
    of_bucket = gains(totals(docs, text, buckets, lengths), totals(target, target_text, buckets, lengths))
    # A few planes of one bit a bucket.
    model = docs.sparkSession.sparkContext.broadcast((planes(np.maximum(of_bucket, 0)), planes(np.maximum(-of_bucket, 0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for name, body in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    counts, features, words = bucket_counts(body, buckets, lengths)
                    own = weight(counts, *model.value)
                    rows.append((words, features, own, own + noise(seed, name)))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"),
        text_of(text).cast("binary").alias("text"),
    )
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def ranked(rows: DataFrame, drawn: int, eligible: int) -> DataFrame:
    """The rows with their rank 1, 2, 3... by falling score and rising doc_id, of the first `drawn` of them.

    The rows are written in sorted ranges; a row's rank is its place in its range after the rows of earlier ranges.
    """
    order = [F.desc("score"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    ranges = max(1, -(-eligible // ROWS_PER_RANGE))
    dealt = held(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "score-ranges")
    # One row a range.
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    placed = dealt.withColumn("place", inside).join(starts, "range")
    rank = (F.col("start") + F.col("place")).cast("bigint")
    return placed.select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    lengths: tuple[int, int] = LENGTHS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of docs; rank is null for rows that are not drawn."""
    rows = weighed(docs, target, doc_id, text, target_text, buckets, lengths, seed)
    rows = held(rows.withColumn("row", F.monotonically_increasing_id()), "weights")
    enough = F.col("n_words") >= least_words
    eligible = rows.filter(enough).count()
    drawn = percent * eligible // 100
    short = rows.filter(~enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return ranked(rows.filter(enough), drawn, eligible).union(short)
