"""Join of documents by the Jaccard similarity of their sets of word n-grams: size-banded tiles, bitmap signatures, exact sets.

Sets are put into bands of sizes, each up to 1.3 times as large as the last, and the sets of a band meet those of the band
that their partners can reach. In a band, two sets that are similar enough differ in at most d shingles. The universe of
shingles is dealt by a hash into more than d parts, so at least one part of the two sets is equal, and a set goes to one
tile a part: that of the band, the part and the shingles it has there. As equal passages make equal tiles only where whole
parts consist of them, documents that merely share a passage do not meet. A set with many empty parts is dealt once more
by another hash, so that empty parts alone need not make a tile.

Sets of a tile are candidates. Each set has a bitmap of its size's width, in which a bit is the parity of the shingles
hashed to it; the bits in which two bitmaps differ are at most the shingles in which the sets differ, which bounds their
overlap from above. Pairs that pass are compared by an intersection of their sorted shingles.

A tile may hold a third of all documents. A task hands on one set of a tile only, beside the sets that it has found to be
together, so that a hot tile is not gathered. In each round every tile compares its sets with one of them, the pivot,
which then leaves the tile, and sets that are connected need no comparison any more. Rounds go on as long as they leave
less than half of the pairs. The rest is cut into blocks of bounded size, which are compared two by two in the same way: by
bitmaps alone first, which are a small part of the sets' bytes, so that only sets that some pair of their tile may need go on
to the blocks with their shingles; a pair of blocks hands on as many links as connect its sets, not all that it finds.

Defined results: words are split at ASCII white space after A-Z are lower-cased; a text with fewer words than a shingle is
one shingle; a text without words, or null, has an empty set and is linked with nothing, not even its like. Shingles are
64-bit hashes, and so are names of sets. Rows that repeat are rows of their component. A null id is never the smallest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import components, held, text_of
from martloom.operators.bloom import bloom_filter, may_contain, words_for

WORDS = 4
#: The least similarity as a fraction of whole numbers.
LEAST = (85, 100)
SEED = 42
#: Times that sets with empty parts are dealt; those of the last time go to tiles of empty parts, too.
DEALS = 8
#: Names that a task sorts before it hands them on, those of a bucket, sets of a block, and 64-bit words of bitmaps that
#: are compared at once.
AT_ONCE, BUCKET, BLOCK, WORDS_AT_ONCE = 1_000_000, 2_000_000, 2048, 1 << 20
#: Bytes of the sets of a block on average.
BLOCK_BYTES = 8_000_000
_TOPS = [1]
while _TOPS[-1] < 2**40:
    _TOPS.append(max(_TOPS[-1] + 1, _TOPS[-1] * 13 // 10))
_TOPS = np.array(_TOPS, np.int64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the shingles, in order."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    parts = map(b" ".join, zip(*[own[k:] for k in range(words)], strict=False)) if len(own) >= words else iter([b" ".join(own)])
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64, max(1, len(own) - words + 1)))


def needed(sizes: int | np.ndarray, least: tuple[int, int] = LEAST) -> int | np.ndarray:
    """The least overlap of two sets with so many shingles together."""
    return -(-least[0] * sizes // (least[0] + least[1]))


def similar(a: np.ndarray, b: np.ndarray, least: tuple[int, int] = LEAST) -> bool:
    return len(np.intersect1d(a, b, assume_unique=True)) >= needed(len(a) + len(b), least)


def bitmap(own: np.ndarray) -> bytes:
    """The parities of the shingles by their lowest bits; as many bits as shingles at least, a power of two."""
    width = max(64, 1 << (max(1, len(own)) - 1).bit_length())
    ones = np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(ones, bitorder="little").tobytes()


def narrowed(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) at a smaller width: halves fold onto one another by exclusive or."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def may_overlap(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: tuple[int, int] = LEAST
) -> np.ndarray:
    """Whether the bitmaps, row by row and of one width, leave room for the overlap needed."""
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return (size_a + size_b - apart) // 2 >= needed(size_a + size_b, least)


@cache
def _parts(band: int, least: tuple[int, int]) -> tuple[int, int, int]:
    """(largest partner, parts, empty parts allowed) of the sets of a band as the smaller ones of pairs."""
    low, top = int(_TOPS[band - 1]) + 1 if band else 1, int(_TOPS[band])
    most = top * least[1] // least[0]
    apart = (top + most) * (least[1] - least[0]) // (least[0] + least[1])
    if not apart:
        return most, 1, 0
    empty = 0
    while True:
        parts = apart + 1 + empty
        mean = parts * (1 - 1 / parts) ** low
        over = 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(empty + 1))
        if over <= 0.1 or empty >= 100:
            return most, parts, empty
        empty += 1


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 2**64 - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def tiles(own: np.ndarray, least: tuple[int, int] = LEAST) -> np.ndarray:
    """The names of the tiles that a set goes to, as the smaller and as the larger of a pair."""
    n = len(own)
    band = int(np.searchsorted(_TOPS, n))
    found, dealt = [], {}
    # The larger set of a pair comes from the same band or from one of the next that partners can reach.
    first = band
    while first and _parts(first - 1, least)[0] >= n:
        first -= 1
    for k in range(first, band + 1):
        _, parts, allowed = _parts(k, least)
        for deal in range(DEALS):
            if deal not in dealt:
                hashes = _mixed(own, 2 * deal + 1)
                dealt[deal] = hashes >> np.uint64(32), _mixed(hashes, 2 * deal + 2)
            part = (dealt[deal][0] % np.uint64(parts)).astype(np.int64)
            sums, filled = np.zeros(parts, np.uint64), np.zeros(parts, bool)
            np.add.at(sums, part, dealt[deal][1])
            filled[part] = True
            at = np.flatnonzero(filled)
            last = deal == DEALS - 1
            if last:
                at = np.arange(parts)
            found.append(_mixed(sums[at] ^ _mixed(at.astype(np.uint64) + np.uint64(k << 40 | deal << 32), 77), 99))
            if parts - np.count_nonzero(filled) <= allowed:
                break
    return np.concatenate(found)


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield part, part.column(at).to_pylist()


def _name(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED) if len(own) else 0


def _signed(names: list[int]) -> pa.Array:
    return pa.array(np.array(names, np.uint64).view(np.int64))


def named(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, name, n_shingles) of each row; name is the hash of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 2):
            sets = [shingles(x, words) for x in texts]
            columns = [_signed([_name(x) for x in sets]), pa.array([len(x) for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "text_hash", "name", "n_shingles"])

    own = _texted(docs, doc_id, text)
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text_hash bigint, name bigint, n_shingles bigint")


def _texted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"), text_of(text).cast("binary").alias("text")
    )


def _runs(tile: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (tile, name) in order, and whether each stands in a tile with another name."""
    order = np.lexsort((name, tile))
    tile, name = tile[order], name[order]
    new = np.ones(len(tile), bool)
    new[1:] = (tile[1:] != tile[:-1]) | (name[1:] != name[:-1])
    tile, name = tile[new], name[new]
    same = tile[1:] == tile[:-1]
    shared = np.zeros(len(tile), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return tile, name, shared


def members(docs: DataFrame, total: int, text: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST) -> DataFrame:
    """(tile, name): the sets of each tile that has two or more of them. total: shingles of all documents, about."""
    buckets = max(1, total // (2 * BUCKET))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_tiles: list[np.ndarray] = []
        own_names: list[np.ndarray] = []
        held_tiles, turn = 0, 0

        def sorted_out() -> pa.RecordBatch:
            tile, name, shared = _runs(np.concatenate(own_tiles), np.concatenate(own_names))
            # One name a tile meets those of other tasks; the others are known to be together here.
            first = np.ones(len(tile), bool)
            first[1:] = tile[1:] != tile[:-1]
            bucket = (_mixed(tile[first], 5) >> np.uint64(16)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            ends = [*(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
            rows = []
            for i, j in zip([0, *ends[:-1]], ends, strict=True):
                at = order[i:j]
                rows.append((int(bucket[at[0]]), tile[first][at].tobytes(), name[first][at].tobytes()))
            if shared.any():
                rows.append((-1 - (turn % 997), tile[shared].tobytes(), name[shared].tobytes()))
            types = (pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["bucket", "tiles", "names"]
            )

        for _, texts in _texts(batches, 0):
            for own in map(partial(shingles, words=words), texts):
                if len(own):
                    own_tiles.append(tiles(own, least))
                    own_names.append(np.full(len(own_tiles[-1]), _name(own), np.uint64))
                    held_tiles += len(own_tiles[-1])
            if held_tiles >= AT_ONCE:
                yield sorted_out()
                own_tiles.clear()
                own_names.clear()
                held_tiles, turn = 0, turn + 1
        if own_tiles:
            yield sorted_out()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held_tiles, held_names = None, [], []

        def together() -> pa.RecordBatch:
            tile, name, shared = _runs(np.concatenate(held_tiles), np.concatenate(held_names))
            return pairs(tile[shared], name[shared])

        def pairs(tile: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(tile.view(np.int64)), pa.array(name.view(np.int64))], ["tile", "name"])

        for batch in batches:
            for own, tile, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tile, name = np.frombuffer(tile, np.uint64), np.frombuffer(name, np.uint64)
                if own < 0:
                    yield pairs(tile, name)
                    continue
                if own != bucket:
                    if held_tiles:
                        yield together()
                    bucket, held_tiles, held_names = own, [], []
                held_tiles.append(tile)
                held_names.append(name)
        if held_tiles:
            yield together()

    own = docs.select(text_of(text).cast("binary").alias("text"))
    rows = own.mapInArrow(dealt, "bucket bigint, tiles binary, names binary")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(met, "tile bigint, name bigint")
    rows = held(rows.distinct(), "tile-members")
    return held(_one_of_each(rows), "tiles")


def _one_of_each(rows: DataFrame) -> DataFrame:
    """The rows (tile, name, ...) without tiles that have the same sets as another: one of them is enough."""
    kinds = rows.groupBy("tile").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("name").alias("lo"),
        F.max("name").alias("hi"),
        F.sum(F.xxhash64("name").cast("decimal(38,0)")).alias("sum"),
    )
    one = kinds.groupBy("n", "lo", "hi", "sum").agg(F.min("tile").alias("tile")).select("tile")
    return rows.join(one, "tile")


def _sets(docs: DataFrame, names: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(name, n, bits, shingles) of the wanted sets, from one document each."""
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    row = F.min(F.struct(id_text.alias("id"), "text_hash")).alias("row")
    one = names.join(wanted, "name").groupBy("name").agg(row).select("row.*").distinct()
    own = _texted(docs, doc_id, text).withColumn("id", id_text).join(one, ["id", "text_hash"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches, 0):
            sets = [shingles(x, words) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed([_name(x) for x in sets]),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([bitmap(x) for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                ["name", "n", "bits", "shingles"],
            )

    return own.mapInArrow(run, "name bigint, n bigint, bits binary, shingles binary").dropDuplicates(["name"])


def _rows_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def among(sets: DataFrame, names: DataFrame) -> DataFrame:
    """The sets that may have one of the names: no other is shuffled to a join by them, which decides."""
    words = words_for(names.count())
    return sets.filter(may_contain(bloom_filter(names, "name", words), F.col("name"), words))


def verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs (a, b) whose sets are similar: first by their bitmaps, then by their shingles."""

    def by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(k).to_numpy() for k in (2, 3)]
            keep = []
            for x, y, n, m in zip(_rows_of(batch.column(4)), _rows_of(batch.column(5)), *sizes, strict=True):
                width = min(len(x), len(y))
                keep.append(bool(may_overlap(narrowed(x[None], width), narrowed(y[None], width), n, m, least)[0]))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(_rows_of(batch.column(2)), _rows_of(batch.column(3)), strict=True)
            yield batch.select([0, 1]).filter(pa.array([similar(x, y, least) for x, y in own], pa.bool_()))

    def sided(sets: DataFrame, column: str, side: str) -> DataFrame:
        names = {"bits": ["n", "bits"], "shingles": ["shingles"]}[column]
        return sets.select(F.col("name").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in names])

    rough = pairs.join(sided(sets, "bits", "a"), "a").join(sided(sets, "bits", "b"), "b")
    rough = rough.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(by_bits, "a bigint, b bigint")
    rough = held(rough, "rough-pairs")
    # Shingles are most of the sets' bytes.
    needed_sets = among(sets, rough.select(F.explode(F.array("a", "b")).alias("name")).distinct())
    both = rough.join(sided(needed_sets, "shingles", "a"), "a").join(sided(needed_sets, "shingles", "b"), "b")
    return both.select("a", "b", "shingles_a", "shingles_b").mapInArrow(exactly, "a bigint, b bigint")


def _rough(group: pa.Table, least: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of block i and of block j, pair by pair: those of different roots whose sizes and bitmaps leave room to be similar."""
    own, root, n = (group.column(c).to_numpy() for c in ("own", "root", "n"))
    bits = _rows_of(group.column("bits").combine_chunks())
    widths = np.array([len(x) for x in bits])
    i, j = (int(group.column(c)[0].as_py()) for c in "ij")
    for w in np.unique(widths):
        for v in np.unique(widths):
            left, right = np.flatnonzero((own == i) & (widths == w)), np.flatnonzero((own == j) & (widths == v))
            # In one block a pair is met from one side.
            if not len(left) or not len(right) or (i == j and v < w):
                continue
            x, y = np.array([bits[k] for k in left]), np.array([bits[k] for k in right])
            x, y = narrowed(x, min(w, v)), narrowed(y, min(w, v))
            step = max(1, WORDS_AT_ONCE // (min(w, v) * len(right)))
            for start in range(0, len(left), step):
                p, q = np.divmod(np.arange(len(left[start : start + step]) * len(right)), len(right))
                p += start
                fit = root[left[p]] != root[right[q]]
                small, large = np.minimum(n[left[p]], n[right[q]]), np.maximum(n[left[p]], n[right[q]])
                fit &= least[1] * small >= least[0] * large
                if i == j and w == v:
                    fit &= p < q
                p, q = p[fit], q[fit]
                if not len(p):
                    continue
                keep = may_overlap(x[p], y[q], n[left[p]], n[right[q]], least)
                yield left[p[keep]], right[q[keep]]


def block_near(group: pa.Table, least: tuple[int, int] = LEAST) -> pa.Table:
    """(tile, name, root): the rows of a block, or of two, that may be similar to another one by their bitmaps.

    Columns: tile, i, j, own (the block of a row), name, root, n, bits. Sets of one root are connected already.
    """
    near = np.zeros(group.num_rows, bool)
    for a, b in _rough(group, least):
        near[a] = near[b] = True
    return group.select(["tile", "name", "root"]).filter(pa.array(near))


def block_links(group: pa.Table, least: tuple[int, int] = LEAST) -> pa.Table:
    """(a, b): similar sets of a block, or of two, by bitmaps first and then by shingles; as many as connect all of them.

    Columns: i, j, own (the block of a row), name, root, n, bits, shingles. Sets of one root are connected already.
    """
    name, root = group.column("name").to_numpy(), group.column("root").to_numpy()
    sets = _rows_of(group.column("shingles").combine_chunks())
    at = np.unique(root, return_inverse=True)[1].tolist()
    parent = list(range(len(name)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for left, right in _rough(group, least):
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a_root, b_root = find(at[a]), find(at[b])
            if a_root != b_root and similar(sets[a], sets[b], least):
                parent[a_root] = b_root
                found.append((int(min(name[a], name[b])), int(max(name[a], name[b]))))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _in_blocks(rows: DataFrame, sets: DataFrame, columns: list[str], block: int) -> DataFrame:
    """rows (tile, name, root) with their sets' columns, once for each pair of blocks (i, j) of the tile that a row's own is in."""
    each = 8 if "shingles" in columns else 1 / 4
    sized = rows.join(sets.select("name", "n"), "name")
    wanted = F.greatest(F.count(F.lit(1)) / block, each * F.sum("n") / BLOCK_BYTES)
    cuts = sized.groupBy("tile").agg(F.ceil(wanted).cast("int").alias("cuts"))
    left = among(sets, rows.select("name").distinct())
    own = rows.join(cuts, "tile").join(left.select("name", *columns), "name")
    own = own.withColumn("own", F.pmod(F.xxhash64("name", "tile"), "cuts").cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return own.select("tile", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "name", "root", *columns)


def _blocked(rows: DataFrame, sets: DataFrame, least: tuple[int, int], block: int) -> DataFrame:
    """(a, b): links between sets of rows (tile, name, root) of tiles with sets that are not connected."""
    keys = ("tile", "i", "j")
    # Bitmaps are few bytes for the comparisons that they take, so partitions by bytes would be too few.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = _in_blocks(rows, sets, ["n", "bits"], block).repartition(parts, *keys).groupBy(*keys)
    near = pairs.applyInArrow(lambda group: block_near(group, least), "tile bigint, name bigint, root bigint")
    # Shingles are most of the sets' bytes, and a set goes to the blocks once for each of its tiles.
    near = held(_one_of_each(held(near.distinct(), "near-members")), "near-tiles")
    pairs = _in_blocks(near, sets, ["n", "bits", "shingles"], block).groupBy(*keys)
    return pairs.applyInArrow(lambda group: block_links(group, least), "a bigint, b bigint")


def roots(tiled: DataFrame, sets: DataFrame, least: tuple[int, int] = LEAST, block: int = BLOCK) -> DataFrame | None:
    """(node, root) of the sets that are linked to others, None if no tile has two sets."""
    sizes = sets.select("name", "n")
    links = found = before = None
    turn = 0
    while True:
        known = tiled.select("tile", "name")
        if found is None:
            known = known.withColumn("root", F.col("name"))
        else:
            known = known.join(found.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        of_root = known.groupBy("tile", "root").agg(F.count(F.lit(1)).cast("double").alias("k"))
        apart = of_root.groupBy("tile").agg(((F.pow(F.sum("k"), F.lit(2)) - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs"))
        apart = held(apart.filter("pairs > 0"), "apart")
        left = apart.agg(F.sum("pairs")).first()[0] or 0
        if not left:
            return found
        tiled = held(known.join(apart.select("tile"), "tile"), "open-tiles")
        last = before is not None and left > before / 2
        if last:
            linked = _blocked(tiled, sets, least, block)
        else:
            pivot = F.min(F.struct(F.xxhash64(F.lit(turn), F.col("name")).alias("place"), "name", "root")).alias("p")
            pivots = tiled.groupBy("tile").agg(pivot)
            pivots = pivots.select("tile", F.col("p.name").alias("pivot"), F.col("p.root").alias("pivot_root"))
            met = held(tiled.join(pivots, "tile"), "pivots")
            fit = met.filter("root <> pivot_root").select("name", "pivot").distinct()
            fit = fit.join(sizes, "name").join(sizes.toDF("pivot", "m"), "pivot")
            fit = fit.filter(least[1] * F.least("n", "m") >= least[0] * F.greatest("n", "m"))
            pairs = fit.select(F.least("name", "pivot").alias("a"), F.greatest("name", "pivot").alias("b"))
            # A pivot has met all others of its tile.
            tiled = met.filter("name <> pivot")
            linked = verified(pairs.distinct(), sets, least)
        new = held(linked.distinct(), "links")
        links = new if links is None else links.union(new)
        found = held(components(links), "link-roots")
        if last:
            return found
        before, turn = left, turn + 1


def groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    least: tuple[int, int] = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, text_hash, name, n_shingles, component_id), one row per row of docs."""
    rows = held(named(docs, doc_id, text, words), "named-sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    tiled = members(docs, total, text, words, least)
    sets = held(_sets(docs, rows, tiled.select("name").distinct(), doc_id, text, words), "sets")
    found = roots(tiled, sets, least, block)
    least_id = rows.groupBy("name").agg(F.min("doc_id").alias("least"))
    if found is None:
        rooted = least_id.withColumn("root", F.col("name"))
    else:
        rooted = least_id.join(found.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    rooted = held(rooted, "set-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    own = rows.join(rooted.join(ids, "root").select("name", "component_id"), "name")
    # Empty sets are linked with nothing.
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", "text_hash", "name", "n_shingles", component.alias("component_id"))
