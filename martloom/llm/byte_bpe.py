"""Byte-level BPE over a global shuffle of distinct words, and decoding by the token-byte table.

Encoding. A task cuts its texts into pre-tokens by the vocabulary's pattern and puts texts together to blocks. A block has
each of its distinct pre-tokens once, numbered, and its texts as sequences of those numbers. Blocks are written once, to a
table bucketed by block, so that only pre-tokens and ids are shuffled. The
distinct pre-tokens of all blocks are shuffled by their hash. Where equal ones meet, each is encoded once and its ids are
handed to all blocks that have it. They go back to their blocks, where the numbers are replaced by ids, text by text. A
frequent pre-token comes once a block, so it makes no hot task.

Decoding looks ids up in the table of token bytes, which is as large as the vocabulary.

Defined results: a null text is empty, an empty text has no ids. Ids, repeated rows and other columns of any name are no
concern: a row of docs gives a row of (doc_id, ids). A text is held whole in a task, which bounds texts by its memory.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import text_of

#: Bytes of text after which a block ends.
BLOCK_BYTES = 8_000_000
#: The hash of a pre-token deals it to one of so many buckets: one for two blocks, within these limits.
LEAST_BUCKETS, MOST_BUCKETS = 16, 4096
_PRETOKENS_AT_ONCE = 500_000
#: Numbers below this take one byte.
_SMALL = np.uint32(192)
_ENCODERS: dict[bytes, object] = {}


class _Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}


def _encoder(file: bytes, pattern: str):
    """The encoder of a rank file; a Python worker makes it once."""
    import tiktoken

    key = hashlib.sha256(file + pattern.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(file), special_tokens={})
    return _ENCODERS[key]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by byte, all lowest bytes first, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _sequence(numbers: np.ndarray) -> list[bytes]:
    """A text's numbers, small ones frequent, in streams: a byte each, and what doesn't fit into it, lowest bits first."""
    large = numbers >= _SMALL
    rest = numbers[large] - _SMALL
    top = rest >> 12
    first = numbers.astype(np.uint8)
    first[large] = _SMALL + np.minimum(top, 255 - _SMALL)
    streams = (first, (rest & 255).astype(np.uint8), ((rest >> 8) & 15).astype(np.uint8), top[top >= 255 - _SMALL])
    return [zstandard.ZstdCompressor(level=3).compress(x.tobytes()) for x in streams]


def _from_sequence(streams: list[bytes]) -> np.ndarray:
    first, low, middle, high = (zstandard.ZstdDecompressor().decompress(x) for x in streams)
    numbers = np.frombuffer(first, np.uint8).astype(np.uint32)
    large = numbers >= _SMALL
    top = numbers[large] - _SMALL
    top[top == 255 - _SMALL] = np.frombuffer(high, np.uint32)
    numbers[large] = (
        _SMALL + (top << 12) + (np.frombuffer(middle, np.uint8).astype(np.uint32) << 8) + np.frombuffer(low, np.uint8)
    )
    return numbers


def _joined_words(words: list[str]) -> tuple[bytes, bytes]:
    """Sizes and bytes of words."""
    data = [w.encode() for w in words]
    return _planes(np.array([len(x) for x in data], np.uint32)), zstandard.ZstdCompressor(level=3).compress(b"".join(data))


def _split_words(sizes: bytes, data: bytes) -> list[str]:
    ends = np.concatenate([[0], np.cumsum(_from_planes(sizes), dtype=np.int64)]).tolist()
    data = zstandard.ZstdDecompressor().decompress(data)
    return [data[a:b].decode() for a, b in pairwise(ends)]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the ranges that begin at starts, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def _blocks(own: DataFrame, pattern: str, kind: str) -> DataFrame:
    """(block, doc_ids, counts, numbers, sizes, words): the texts of rows (doc_id, text), cut and numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern).findall
        first = TaskContext.get().partitionId() << 32
        ids, counts, numbers, words, size, made = [], [], [], _Numbers(), 0, 0

        def block() -> pa.RecordBatch:
            own = np.concatenate(numbers)
            # The more frequent, the smaller the number.
            order = np.argsort(-np.bincount(own, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            in_order = list(words)
            sizes, data = _joined_words([in_order[k] for k in order])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + made], pa.int64()),
                    pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([_sequence(rank[own])], pa.list_(pa.binary())),
                    pa.array([sizes], pa.binary()),
                    pa.array([data], pa.binary()),
                ],
                ["block", "doc_ids", "counts", "numbers", "sizes", "words"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids.append(part.column(0))
                for text in part.column(1).to_pylist():
                    numbers.append(np.fromiter(map(words.__getitem__, cut(text)), np.uint32))
                    counts.append(len(numbers[-1]))
                    size += len(text)
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, counts, numbers, words, size, made = [], [], [], _Numbers(), 0, made + 1
        if counts:
            yield block()

    return own.mapInArrow(
        run,
        f"block bigint, doc_ids array<{kind}>, counts array<int>, numbers array<binary>, sizes binary, words binary",
    )


def _encoded_words(blocks: DataFrame, file, pattern: str) -> DataFrame:
    """(block, numbers, sizes, ids): of a block's pre-tokens in one bucket, their numbers, how many ids each has, the ids."""
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, blocks.count() // 2))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own: list[list[tuple[str, int]]] = [[] for _ in range(buckets)]
                for number, word in enumerate(_split_words(sizes, data)):
                    own[zlib.crc32(word.encode()) % buckets].append((word, number))
                rows = []
                for bucket, pairs in enumerate(own):
                    if pairs:
                        # Words in order compress well.
                        words, numbers = zip(*sorted(pairs), strict=True)
                        rows.append((block, bucket, _planes(np.array(numbers)), *_joined_words(list(words))))
                types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                    ["block", "bucket", "numbers", "sizes", "words"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_word = _encoder(file.value, pattern).encode_ordinary
        bucket, known = None, {}
        for batch in batches:
            sizes, ids = [], []
            for own, lengths, data in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4)), strict=True):
                if own != bucket:
                    bucket, known = own, {}
                found = []
                for word in _split_words(lengths, data):
                    if word not in known:
                        known[word] = encode_word(word)
                    found.append(known[word])
                sizes.append(_planes(np.fromiter(map(len, found), np.uint32, len(found))))
                ids.append(_planes(np.fromiter(chain.from_iterable(found), np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                ["block", "numbers", "sizes", "ids"],
            )

    rows = blocks.select("block", "sizes", "words").mapInArrow(
        dealt, "block bigint, bucket int, numbers binary, sizes binary, words binary"
    )
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(encoded, "block bigint, numbers binary, sizes binary, ids binary")


def _bucketed(blocks: DataFrame) -> DataFrame:
    """The blocks, written as a table bucketed by block in the warehouse: later joins by block leave them where they are."""
    spark = blocks.sparkSession
    name = f"byte_bpe_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.format("parquet").bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each row. vocabulary: path of a rank file, on the driver's machine."""
    file = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    own = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    blocks = _bucketed(_blocks(own, pattern, kind))

    def assembled(block: pa.Table, words: pa.Table) -> pa.Table:
        numbers = _from_sequence(block.column("numbers")[0].as_py())
        at, size, flat = (
            np.concatenate([np.zeros(0, np.uint32), *map(_from_planes, words.column(x).to_pylist())]).astype(np.int32)
            for x in ("numbers", "sizes", "ids")
        )
        starts, sizes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        starts[at], sizes[at] = np.cumsum(size, dtype=np.int64) - size, size
        parts = []
        for k in range(0, len(numbers), _PRETOKENS_AT_ONCE):
            n = numbers[k : k + _PRETOKENS_AT_ONCE]
            parts.append(flat[_ragged(starts[n], sizes[n])])
        doc_ids, counts = (block.column(x)[0].values for x in ("doc_ids", "counts"))
        ends = np.concatenate([[0], np.cumsum(sizes[numbers])])[np.concatenate([[0], np.cumsum(counts.to_numpy())])]
        tokens = np.concatenate(parts) if parts else flat[:0]
        return pa.table({"doc_id": doc_ids, "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))})

    words = _encoded_words(blocks, file, pattern)
    return (
        blocks.drop("sizes", "words")
        .groupBy("block")
        .cogroup(words.groupBy("block"))
        .applyInArrow(assembled, f"doc_id {kind}, ids array<int>")
    )


def token_bytes(vocabulary: str) -> list[bytes | None]:
    """The table of token bytes: the bytes of each id."""
    ranks = _ranks(read_ranks(vocabulary))
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _joined(lists: pa.ListArray, table: pa.BinaryArray) -> list[bytes]:
    """The bytes of each list of ids, looked up in the table and put together."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds, values = bounds - bounds[0], lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    if not len(values):
        return [b""] * len(lists)
    taken = table.take(values)
    _, ends, data = taken.buffers()
    at = np.frombuffer(ends, np.int32)[taken.offset :][bounds].tolist()
    return [bytes(memoryview(data)[a:b]) for a, b in pairwise(at)]


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """The rows with a column `bytes`: what the ids stand for. Null ids give no bytes."""
    table = tokens.sparkSession.sparkContext.broadcast(token_bytes(vocabulary))
    at = tokens.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(table.value, pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                data = pa.array(_joined(part.column(at), known), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, data], [*part.schema.names, "bytes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    return tokens.mapInArrow(run, f"{fields}, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with ids and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            hashes = [hashlib.sha256(ids[k].values.to_numpy().astype("<u4").tobytes()).hexdigest() for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes), batch.column(2), batch.column(3)],
                ["doc_id", "ids_sha256", "n_tokens", "decoded_sha256"],
            )

    kind = decoded.schema["doc_id"].dataType.simpleString()
    return decoded.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("bytes", 256).alias("decoded_sha256")
    ).mapInArrow(run, f"doc_id {kind}, ids_sha256 string, n_tokens bigint, decoded_sha256 string")


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the public byte-level vocabulary that the driver's machine has."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def tokens_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`encode` by the default vocabulary."""
    vocabulary, pattern = default_vocabulary()
    return encode(docs, vocabulary, pattern)
