"""Phrase collocations by prefix-free parsing: overlapping chunks, a dictionary of distinct chunks, weighted n-grams.

A text is cut into pieces at punctuation and line ends, and a piece into words. A chunk begins where a piece begins and
wherever the hash of two neighbouring words says so, and runs over the next beginning by one word less than the longest
phrase. So every occurrence of a phrase lies whole in the chunk that its first word belongs to, and is counted there alone;
the words that a chunk shares with its successor only complete phrases. Equal passages are cut into equal chunks wherever
they stand, and a distinct chunk is read once, with its frequency in the parse as weight.

Distinct chunks are packed into blocks with a vocabulary of their own. A block asks for the totals of its words and word
pairs by their hashes, dealt into buckets in which all blocks' counts meet. A phrase is frequent only if all its words and
pairs are, so only such phrases are then spelt out, summed up inside a block, and counted exactly by an aggregation. Hashes
that collide let a phrase pass to the exact count, never keep one from it.

Defined results: a null text is empty, a null language is `und`; a text without words adds nothing. Documents' ids play no
role, so repeated rows and null ids count like any other. A text is held whole in a task. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
#: A shorter phrase goes if a longer one that contains it has at least this share of its occurrences, in percent.
INSIDE = 80
TOP = 2000
#: One pair of words in so many begins a chunk.
EVERY = 16
#: Words of a block, bytes of text whose chunks a task counts before it hands them on, and hashes of a bucket.
BLOCK_WORDS, BYTES_AT_ONCE, BUCKET = 400_000, 16_000_000, 1_000_000
_CUTS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes.maketrans(bytes(range(65, 91)) + _CUTS, bytes(range(97, 123)) + b"\n" * len(_CUTS))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece, A-Z lower-cased."""
    return filter(None, map(bytes.split, text.translate(_LOWER).split(b"\n")))


def parse(words: list[bytes], longest: int = LONGEST, every: int = EVERY) -> Iterator[tuple[int, bytes]]:
    """The chunks of a piece: how many of its words begin phrases there, and the words."""
    starts = [0, *(k for k in range(1, len(words)) if not crc32(words[k], crc32(words[k - 1])) % every), len(words)]
    for start, end in pairwise(starts):
        yield end - start, b" ".join(words[start : end + longest - 1])


def dictionary(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, every: int = EVERY
) -> DataFrame:
    """(lang, own, chunk, times): the distinct chunks and their frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        size = 0

        def counted() -> pa.RecordBatch:
            langs, owns, chunks = zip(*found, strict=True)
            columns = [pa.array(langs), pa.array(owns, pa.int32()), pa.array(chunks, pa.binary()), pa.array(found.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "own", "chunk", "times"])

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for own, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found.update((own, *chunk) for words in pieces(body) for chunk in parse(words, longest, every))
                    size += len(body)
                if found and size >= BYTES_AT_ONCE:
                    yield counted()
                    found.clear()
                    size = 0
        if found:
            yield counted()

    own = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).cast("binary").alias("text")
    )
    rows = own.mapInArrow(run, "lang string, own int, chunk binary, times bigint")
    return rows.groupBy("lang", "own", "chunk").agg(F.sum("times").alias("times"))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


_BLOCK = "block bigint, lang string, n bigint, words binary, numbers binary, sizes binary, owns binary, times binary"


def blocks(chunks: DataFrame) -> DataFrame:
    """Distinct chunks of one language a row, as numbers into the block's own words; n: occurrences of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held_words, open_chunks = TaskContext.get().partitionId() << 32, 0, 0, {}

        def packed() -> pa.RecordBatch:
            rows = []
            for lang, (vocabulary, numbers, sizes, owns, times) in open_chunks.items():
                n = sum(a * b for a, b in zip(owns, times, strict=True))
                words = zstandard.ZstdCompressor(level=3).compress(b" ".join(vocabulary))
                packs = [_packed(np.array(x, kind)) for x, kind in ((sizes, np.uint32), (owns, np.uint32), (times, np.int64))]
                rows.append((first + made + len(rows), lang, n, words, _packed(np.concatenate(numbers)), *packs))
            types = (pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 5)
            names = ["block", "lang", "n", "words", "numbers", "sizes", "owns", "times"]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

        for batch in batches:
            for lang, own, chunk, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lang not in open_chunks:
                    open_chunks[lang] = (_Numbers(), [], [], [], [])
                vocabulary, numbers, sizes, owns, weights = open_chunks[lang]
                words = chunk.split(b" ")
                numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
                sizes.append(len(words))
                owns.append(own)
                weights.append(times)
                held_words += len(words)
                if held_words >= BLOCK_WORDS:
                    yield packed()
                    made, held_words = made + len(open_chunks), 0
                    open_chunks.clear()
        if open_chunks:
            yield packed()

    return chunks.select("lang", "own", "chunk", "times").mapInArrow(run, _BLOCK)


class Block:
    """A block taken apart: numbers of all words, how many words of its chunk follow each, and the weight of phrases that
    begin there, which is zero for words shared with the next chunk."""

    def __init__(self, lang: str, words: bytes, numbers: bytes, sizes: bytes, owns: bytes, times: bytes) -> None:
        self.lang = lang
        self.words = zstandard.ZstdDecompressor().decompress(words).split(b" ")
        self.numbers = _unpacked(numbers, np.uint32).astype(np.int64)
        sizes, owns = _unpacked(sizes, np.uint32).astype(np.int64), _unpacked(owns, np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.arange(len(self.numbers)) - np.repeat(ends - sizes, sizes)
        self.room = np.repeat(sizes, sizes) - at
        self.weight = np.where(at < np.repeat(owns, sizes), np.repeat(_unpacked(times, np.int64), sizes), 0)

    def keys(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys (bucket, hash) of words and pairs in order, where each pair begins, and the index of each
        word's and of each pair's key."""
        seed = crc32(self.lang.encode())
        hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)[self.numbers]
        pairs = np.flatnonzero(self.room[:-1] > 1) if len(hashes) > 1 else np.zeros(0, np.int64)
        both = (hashes[pairs] * np.uint64(0x9E3779B97F4A7C15)) ^ ((hashes[pairs + 1] << np.uint64(21)) | (hashes[pairs + 1] >> np.uint64(43)))
        both = (both ^ (both >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        every = np.concatenate([hashes, both])
        every = (((every & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)) << np.uint64(32)) | (every >> np.uint64(32))
        keys, index = np.unique(every, return_inverse=True)
        return keys, pairs, index[: len(hashes)], index[len(hashes) :]


def _questions(packed: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, hashes, counts): what a block knows of the totals of a bucket, hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                b = Block(*own)
                keys, pairs, of_word, of_pair = b.keys(buckets)
                counts = np.zeros(len(keys), np.int64)
                np.add.at(counts, of_word, b.weight)
                np.add.at(counts, of_pair, b.weight[pairs])
                bucket = (keys >> np.uint64(32)).astype(np.int64)
                ends = [*(np.flatnonzero(np.diff(bucket)) + 1), len(keys)]
                starts = [0, *ends[:-1]]
                low = keys.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(ends), pa.int64()),
                        pa.array(bucket[starts], pa.int64()),
                        pa.array([low[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()),
                        pa.array([_packed(counts[i:j]) for i, j in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    ["block", "bucket", "hashes", "counts"],
                )

    columns = packed.select("block", "lang", "words", "numbers", "sizes", "owns", "times")
    return columns.mapInArrow(run, "block bigint, bucket bigint, hashes binary, counts binary")


def _answers(questions: DataFrame, least: int) -> DataFrame:
    """(block, bucket, bits): for each hash asked for, whether all blocks together reach `least`."""

    def totals(group: pa.Table) -> pa.Table:
        asked = [np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("hashes")]
        counts = np.concatenate([_unpacked(x, np.int64) for x in group.column("counts").to_pylist()])
        known, index = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, index, counts)
        enough = np.split(total[index] >= least, np.cumsum([len(x) for x in asked])[:-1])
        bits = pa.array([np.packbits(x).tobytes() for x in enough], pa.binary())
        return pa.table([group.column("block"), group.column("bucket"), bits], ["block", "bucket", "bits"])

    return questions.groupBy("bucket").applyInArrow(totals, "block bigint, bucket bigint, bits binary")


def _flags(keys: np.ndarray, answers: list[dict]) -> np.ndarray:
    """One flag a key from a block's answers."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    flags = np.zeros(len(keys), bool)
    for answer in answers:
        i, j = np.searchsorted(bucket, [answer["bucket"], answer["bucket"] + 1])
        flags[i:j] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=j - i).astype(bool)
    return flags


def _spelt(packed: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(lang, phrase, times): the phrases of a block all of whose words and pairs are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for answers, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                b = Block(*own)
                keys, pairs, of_word, of_pair = b.keys(buckets)
                frequent = _flags(keys, answers)
                linked = np.zeros(len(b.numbers), bool)
                linked[pairs] = frequent[of_pair]
                at = np.flatnonzero(frequent[of_word])
                names = b.numbers[at]
                for size in range(1, longest + 1):
                    if size > 1:
                        more = linked[at + size - 2]
                        at = at[more]
                        # A phrase is numbered by the number of all words but the last, and the last.
                        names = names[more] * len(b.words) + b.numbers[at + size - 1]
                    kinds, where, index = np.unique(names, return_index=True, return_inverse=True)
                    names = index
                    times = np.zeros(len(kinds), np.int64)
                    np.add.at(times, index, b.weight[at])
                    some = np.flatnonzero(times)
                    first = at[where[some]]
                    words = [[b.words[k] for k in b.numbers[first + d].tolist()] for d in range(size)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([b.lang] * len(some), pa.string()),
                            pa.array([b" ".join(x) for x in zip(*words, strict=True)], pa.binary()),
                            pa.array(times[some]),
                        ],
                        ["lang", "phrase", "times"],
                    )

    columns = packed.select("answers", "lang", "words", "numbers", "sizes", "owns", "times")
    return columns.mapInArrow(run, "lang string, phrase binary, times bigint")


def frequencies(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, every: int = EVERY
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) for all phrases of at most `longest` words with f >= least, and (lang, n)."""
    packed = held(blocks(dictionary(docs, lang, text, longest, every)), "phrase-blocks")
    totals = packed.groupBy("lang").agg(F.sum("n").alias("n"))
    words = packed.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-2 * words // BUCKET))
    answers = _answers(_questions(packed, buckets), least)
    # At most as many flags as a block has words and pairs.
    of_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    spelt = _spelt(packed.join(of_block, "block"), buckets, longest)
    counted = spelt.groupBy("lang", "phrase").agg(F.sum("times").alias("f")).filter(F.col("f") >= least)
    phrase = F.col("phrase").cast("string")
    rows = counted.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("size"), "f")
    return held(rows, "phrases"), held(totals, "phrase-totals")


def _cut(start: int | F.Column, size: int | F.Column) -> F.Column:
    return F.array_join(F.slice("words", F.lit(start) if isinstance(start, int) else start, size), " ")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    every: int = EVERY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two words or more.

    A phrase's score is that of its lowest-scoring cut into two parts that occur l and r times, the first of such cuts.
    """
    known, totals = frequencies(docs, lang, text, least, longest, every)
    candidates = known.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _cut(1, F.col("k")).alias("first"), _cut(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    part = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    both = cuts.join(part, ["lang", "first"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
    # Wider than 64 bits, so that the product is exact.
    score = F.expr(f"CAST(a AS DECIMAL(19,0)) * {SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)").alias("score")
    worst = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("cut"))
    # Phrases inside a longer one, each with the largest frequency of a longer one.
    spans = candidates.filter("size > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("inner"))
    spans = spans.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)).alias("start"))
    longer = spans.select("lang", "a", _cut(F.col("start"), F.col("inner")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    covered = F.expr(f"100 * CAST(longer AS DECIMAL(19,0)) >= {INSIDE} * CAST(a AS DECIMAL(19,0))")
    left = worst.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("bigint").alias("score"),
    )
