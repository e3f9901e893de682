"""Passages that repeat across documents, by a sparse suffix array.

A text is words between ASCII white space. Of all suffixes of all texts only those are retained that begin at a minimiser:
the least hash of `GRAM` words in a window as long as the shortest passage to be found, less a gram. Equal windows have equal
minimisers, so each passage of `LEAST_WORDS` words keeps a suffix wherever it comes, at the same place in it.

Retained suffixes whose first gram is in one document only are left out. The others are sorted by their words, over the
whole corpus, and each is compared with the nearest suffix of another document before and after it, also in the order of
the words to its left among suffixes of its gram. From the common gram a match is extended right and left, word by word. A suffix carries `LEAST_WORDS` words to either side: as a passage has
minimisers closer than that, its matches overlap, and their union is the passage whatever its length.

Ranges of the sorted suffixes are cut anywhere, also inside a hot passage. A range returns its first and last suffixes of
two documents, a few rows a range; suffixes at its ends that found no other document are compared with those of the
ranges before and after.

Defined results: null, empty and shorter texts have no passages. A document is its doc_id with its text; rows that repeat
both are one document, so copies of a text under one id don't match each other. Repeats inside one document are none. A
match that is longer to one side may hide one that is longer to the other at the same suffix, as in any suffix array; the
passage's other minimisers see that one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

LEAST_WORDS = 50
GRAM = 8
#: Suffixes that a task sorts and compares, on average.
RANGE_ROWS = 40_000
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = {"bytes": 0x9E3779B97F4A7C15, "words": 0xC2B2AE3D27D4EB4F}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2 ** 64, and of its inverse."""
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        base = _BASE[kind]
        size = max(4096, 2 * n)
        _POWERS[kind] = have = tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
            for b in (base, pow(base, -1, 2**64))
        )
    return have[0][:n], have[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, kind: str) -> np.ndarray:
    return np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(kind, len(values))[0], dtype=np.uint64)])


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, from prefix sums over the bytes."""
    codes = np.frombuffer(data, np.uint8)
    word = np.concatenate([[False], ~_SPACE[codes], [False]])
    starts, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(~word[1:] & word[:-1])
    sums = _sums(codes.astype(np.uint64) + np.uint64(1), "bytes")
    return _mixed((sums[ends] - sums[starts]) * _powers("bytes", len(codes) + 1)[1][starts])


def minimisers(data: bytes, least_words: int = LEAST_WORDS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions, in words, of the retained suffixes, and the hashes of their first grams."""
    words = word_hashes(data) if len(data) >= 2 * least_words - 1 else np.zeros(0, np.uint64)
    if len(words) < least_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = _sums(words, "words")
    n = len(words) - gram + 1
    grams = _mixed((sums[gram:] - sums[:-gram]) * _powers("words", n)[1])
    windows = np.lib.stride_tricks.sliding_window_view(grams, least_words - gram + 1)
    at = np.unique(np.concatenate([windows[k : k + 65536].argmin(axis=1) + np.arange(k, min(k + 65536, len(windows))) for k in range(0, len(windows), 65536)]))
    return at, grams[at].view(np.int64)


def _common(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _span(one: tuple, other: tuple, least_words: int) -> tuple[int, int] | None:
    """The match of two suffixes (gram, doc, doc_id, pos, left, right) in words of the first, if it is long enough."""
    if one[0] != other[0]:
        return None
    right = _common(one[5].split(" "), other[5].split(" "))
    left = _common(one[4].split(" "), other[4].split(" ")) if one[4] and other[4] else 0
    return (one[3] - left, one[3] + right) if left + right >= least_words else None


def _compared(rows: list[tuple], part: int, least_words: int) -> list[tuple]:
    """(kind, part, *suffix, start, end): the spans of a sorted range, and what its ends leave to its neighbours."""
    n = len(rows)
    before, after = [-1] * n, [n] * n
    for i in range(1, n):
        before[i] = before[i - 1] if rows[i][1] == rows[i - 1][1] else i - 1
    for i in range(n - 2, -1, -1):
        after[i] = after[i + 1] if rows[i][1] == rows[i + 1][1] else i + 1
    # The neighbours by the words to the left, among the suffixes of one gram in this range.
    by_left = sorted(range(n), key=lambda i: (rows[i][0], rows[i][4]))
    left_of, right_of = [-1] * n, [n] * n
    for a, b in pairwise(by_left):
        left_of[b] = left_of[a] if rows[a][1] == rows[b][1] else a
    for b, a in pairwise(reversed(by_left)):
        right_of[a] = right_of[b] if rows[a][1] == rows[b][1] else b
    out = []
    for i, row in enumerate(rows):
        short = (*row[:4], None, None)
        for j in {before[i], after[i], left_of[i], right_of[i]}:
            if 0 <= j < n and (span := _span(row, rows[j], least_words)):
                out.append(("span", part, *short, *span))
        if before[i] < 0:
            out.append(("open-head", part, *row, None, None))
        if after[i] >= n:
            out.append(("open-tail", part, *row, None, None))
    for kind, ends in (("head", (0, after[0])), ("tail", (n - 1, before[n - 1]))):
        out += [(kind, part, *rows[j], None, None) for j in ends if 0 <= j < n]
    return out


_KIND = "kind string, part int, gram bigint, doc bigint, doc_id {id}, pos int, left string, right string, start int, end int"


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    names = ["kind", "part", "gram", "doc", "doc_id", "pos", "left", "right", "start", "end"]
    i32, i64, text = pa.int32(), pa.int64(), pa.string()
    types = [text, i32, i64, i64, id_type, i32, text, text, i32, i32]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, gram: int = GRAM,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, doc, start, end): the longest passages, in words of the text, of at least `least_words` words that another
    document has too. doc tells documents of one id apart."""
    own = docs.select(
        F.xxhash64(F.col(doc_id), text_of(text)).alias("doc"), F.col(doc_id).alias("doc_id"), text_of(text).cast("binary").alias("text")
    )
    id_kind = own.schema["doc_id"].dataType.simpleString()

    def retained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [minimisers(x, least_words, gram) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([h for _, h in found])),
                        pa.array(np.repeat(part.column(0).to_numpy(), [len(p) for p, _ in found])),
                        pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)),
                    ],
                    ["gram", "doc", "pos"],
                )

    suffixes = held(own.select("doc", "text").mapInArrow(retained, "gram bigint, doc bigint, pos int"), "suffixes")
    shared = suffixes.groupBy("gram").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a <> b").select("gram")
    places = held(suffixes.join(held(shared, "grams"), "gram"), "places")
    ranges = max(1, -(-places.count() // range_rows))
    by_doc = places.groupBy("doc").agg(F.collect_list(F.struct("pos", "gram")).alias("places"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), None, pa.int32(), pa.string(), pa.string())
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                rows = []
                for doc, doc_id, data, places in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = data.split()
                    for x in places:
                        at = x["pos"]
                        left = b" ".join(words[max(0, at - least_words) : at][::-1])
                        rows.append((x["gram"], doc, doc_id, at, left.decode(), b" ".join(words[at : at + least_words]).decode()))
                types = [t or part.column(1).type for t in kinds]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["gram", "doc", "doc_id", "pos", "left", "right"]
                )

    # Rows that repeat id and text are one document.
    joined = own.join(by_doc, "doc").select("doc", "doc_id", "text", "places")
    rows = joined.mapInArrow(contexts, f"gram bigint, doc bigint, doc_id {id_kind}, pos int, left string, right string")
    order = ["gram", "right", "left", "doc", "pos"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, id_type = TaskContext.get().partitionId(), [], None
        for batch in batches:
            id_type = batch.column(2).type
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        if rows:
            found = _compared(rows, part, least_words)
            for start in range(0, len(found), 5000):
                yield _batch(found[start : start + 5000], id_type)

    found = held(
        # A sample of the keys goes to the driver, so what only cuts ties is a number.
        rows.repartitionByRange(ranges, "gram", "right", F.xxhash64("left", "doc", "pos"))
        .sortWithinPartitions(*order)
        .mapInArrow(compare, _KIND.format(id=id_kind)), "found"
    )
    # Two rows at each end of each range.
    edges = [tuple(r) for r in found.filter(F.col("kind").isin("head", "tail")).collect()]
    heads = sorted((e for e in edges if e[0] == "head"), key=lambda e: (e[1], e[2], e[7], e[6], e[3], e[5]))
    tails = sorted((e for e in edges if e[0] == "tail"), key=lambda e: (e[1], e[2], e[7], e[6], e[3], e[5]), reverse=True)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] == "open-head":
                    near = next((e for e in tails if e[1] < row[1] and e[3] != row[3]), None)
                else:
                    near = next((e for e in heads if e[1] > row[1] and e[3] != row[3]), None)
                if near and (span := _span(row[2:8], near[2:8], least_words)):
                    out.append(("span", row[1], *row[2:6], None, None, *span))
            yield _batch(out, batch.column(4).type)

    ends = found.filter(F.col("kind").startswith("open")).mapInArrow(across, _KIND.format(id=id_kind))
    spans = found.filter("kind = 'span'").union(ends).select("doc", "doc_id", "start", "end").distinct()
    # Spans that overlap or touch are one passage.
    order = Window.partitionBy("doc", "doc_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    passages = fresh.withColumn("n", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return passages.groupBy("doc_id", "doc", "n").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("n")


def passages(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, passage): the words of each span."""
    words = F.split(F.trim(F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " ")), " ")
    own = docs.select(F.xxhash64(F.col(doc_id), text_of(text)).alias("doc"), words.alias("words")).dropDuplicates(["doc"])
    cut = F.array_join(F.slice("words", F.col("start") + 1, F.col("end") - F.col("start")), " ")
    return spans.join(own, "doc").select("doc_id", "start", "end", cut.alias("passage"))
