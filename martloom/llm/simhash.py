"""Near-duplicates by SimHash: 64-bit fingerprints linked at few differing bits, by a self-join of their binary trie.

Only distinct fingerprints take part. The top bits of a fingerprint name its node in the upper trie. Two nodes are a pair
if their prefixes differ in no more bits than the error budget; the rest is pruned there and then, without a row. Each
pair of nodes is one group of rows of bounded size: a node with too many fingerprints is cut into parts, and its parts are
paired. Inside a group the two subtries are traversed together, bit by bit, adding up the differing bits of a pair of
subtries and dropping it beyond the budget.

A group returns a spanning forest of the links it finds, never all pairs of a cluster. Components come from the forests.

Defined results: words are split at ASCII white space, after A-Z are lower-cased; a text with fewer words than a shingle
has one shingle, its words; a text without words, or null, has fingerprint zero and is linked like any other. Rows that
repeat are rows of their component. A null doc_id is never the smallest; a component of only such rows has a null id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import components, held, text_of

WORDS = 3
BUDGET = 2
SEED = 42
#: Fingerprints of a node on average, and of a part of a node at most.
NODE, PART = 2048, 8192
#: The upper trie's depth at most, so that a table of its nodes has at most 65,536 rows.
DEEPEST = 16
_HASHED_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Each bit that is set in over half the hashes of the shingles, repeats included."""
    own = text.lower().split()
    if not own:
        return 0
    shingles = map(b" ".join, zip(*[own[k:] for k in range(words)], strict=False)) if len(own) >= words else iter([b" ".join(own)])
    total = max(1, len(own) - words + 1)
    ones = np.zeros(64, np.int64)
    hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    for start in range(0, total, _HASHED_AT_ONCE):
        part = np.fromiter(hashes, np.uint64, min(_HASHED_AT_ONCE, total - start))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of each row; fp as a signed 64-bit number, text_hash as Spark's xxhash64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                fps = [fingerprint(x, words) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))],
                    ["doc_id", "text_hash", "fp"],
                )

    own = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"), text_of(text).cast("binary").alias("text")
    )
    kind = dict(own.dtypes)["doc_id"]
    return own.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def trie_pairs(
    a: np.ndarray, b: np.ndarray | None, depth: int, used: int, budget: int = BUDGET
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in a and b whose fingerprints differ in at most `budget` bits, some at a time.

    a and b are sorted and distinct, each with one prefix of `depth` bits; the prefixes differ in `used` bits. Without b,
    each pair in a comes once. A pair of subtries is a pair of ranges; a node's children share its range, zeros first.
    """
    same = b is None
    b = a if same else b
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def set_bits(bit: int) -> tuple[np.ndarray, np.ndarray]:
        if bit not in ones:
            ones[bit] = tuple(
                np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]) for x in (a, b)
            )
        return ones[bit]

    stack = [(63 - depth, np.array([[0, len(a), 0, len(b), used]], np.int64))]
    while stack:
        bit, pairs = stack.pop()
        if len(pairs) > _PAIRS_AT_ONCE:
            stack += [(bit, half) for half in np.array_split(pairs, 2)]
            continue
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        few = (sizes <= 64) if bit >= 0 else np.ones(len(pairs), bool)
        if few.any():
            small, n = pairs[few], sizes[few]
            at = np.repeat(np.arange(len(small)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = (small[:, 3] - small[:, 2])[at]
            i, j = small[at, 0] + k // wide, small[at, 2] + k % wide
            keep = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                keep &= i < j
            yield i[keep], j[keep]
        pairs = pairs[~few]
        if not len(pairs):
            continue
        in_a, in_b = set_bits(bit)
        mid_a = pairs[:, 1] - (in_a[pairs[:, 1]] - in_a[pairs[:, 0]])
        mid_b = pairs[:, 3] - (in_b[pairs[:, 3]] - in_b[pairs[:, 2]])
        alike = same & (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        children = []
        for x in (0, 1):
            for y in (0, 1):
                child = np.column_stack(
                    [
                        mid_a if x else pairs[:, 0],
                        pairs[:, 1] if x else mid_a,
                        mid_b if y else pairs[:, 2],
                        pairs[:, 3] if y else mid_b,
                        pairs[:, 4] + (x != y),
                    ]
                )
                keep = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 4] <= budget)
                if x > y:
                    keep &= ~alike
                children.append(child[keep])
        stack.append((bit - 1, np.concatenate(children)))


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of i and j, pair by pair; parent is flat before and after."""
    while True:
        x, y = parent[i], parent[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _forest(group: pa.Table, depth: int, budget: int) -> pa.Table:
    fp = group.column("fp").to_numpy().view(np.uint64)
    second = group.column("second").to_numpy(zero_copy_only=False)
    used = int(group.column("lo")[0].as_py() ^ group.column("hi")[0].as_py()).bit_count()
    a, b = np.sort(fp[~second]), np.sort(fp[second])
    alone = group.column("lo")[0] == group.column("hi")[0] and group.column("lo_part")[0] == group.column("hi_part")[0]
    both = a if alone else np.concatenate([a, b])
    parent = np.arange(len(both))
    if len(a) and (alone or len(b)):
        for i, j in trie_pairs(a, None if alone else b, depth, used, budget):
            _unite(parent, i, j if alone else j + len(a))
    linked = np.flatnonzero(parent != np.arange(len(both)))
    return pa.table({"a": both[linked].view(np.int64), "b": both[parent[linked]].view(np.int64)})


def links(distinct: DataFrame, budget: int = BUDGET, node: int = NODE, part: int = PART) -> DataFrame:
    """(a, b): links between the fingerprints of column fp, which are distinct; enough of them to connect all that differ
    in at most `budget` bits, directly or over others."""
    n = distinct.count()
    depth = min(DEEPEST, max(1, math.ceil(math.log2(max(1, n / node)))))
    masks = [sum(1 << k for k in ks) for size in range(min(budget, depth) + 1) for ks in combinations(range(depth), size)]
    rows = distinct.select("fp", F.shiftrightunsigned("fp", 64 - depth).cast("int").alias("own"))
    # At most 2 ** DEEPEST rows of three numbers, whatever the number of fingerprints.
    nodes = held(rows.groupBy("own").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")), "nodes")
    others = nodes.select(F.col("own").alias("other"), F.col("parts").alias("other_parts"))
    paired = (
        rows.join(F.broadcast(nodes), "own")
        .withColumn("own_part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
        .withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
        .join(F.broadcast(others), "other")
        .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    )
    own, other = F.struct("own", "own_part"), F.struct("other", "other_part")
    keyed = paired.select(
        F.least(own, F.struct(F.col("other").alias("own"), F.col("other_part").alias("own_part"))).alias("first"),
        F.greatest(own, F.struct(F.col("other").alias("own"), F.col("other_part").alias("own_part"))).alias("last"),
        (own > other).alias("second"),
        "fp",
    ).select(
        F.col("first.own").alias("lo"),
        F.col("first.own_part").alias("lo_part"),
        F.col("last.own").alias("hi"),
        F.col("last.own_part").alias("hi_part"),
        "second",
        "fp",
    )
    return keyed.groupBy("lo", "lo_part", "hi", "hi_part").applyInArrow(
        lambda group: _forest(group, depth, budget), "a bigint, b bigint"
    )


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, budget: int = BUDGET
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per row of docs."""
    rows = held(fingerprints(docs, doc_id, text, words), "fingerprints")
    distinct = held(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), budget))
    rooted = held(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots"
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp")


def keep_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """One whole row of each component: that of its smallest doc_id."""
    return rows_that_stay(docs, near_groups(docs, doc_id, text, words, budget), doc_id, text)


def rows_that_stay(docs: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One whole row of each component of groups, (doc_id, text_hash, root)."""
    names = docs.columns
    # Of rows that share the smallest id, or of rows without any, the one with the smallest hash of its text.
    stays = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row")
    )
    id_text = F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    stays = held(stays.select(id_text.alias("id"), F.col("row.text_hash").alias("text_hash")).distinct(), "kept")
    own = docs.select(
        F.struct(*names).alias("doc"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text_of(text)).alias("text_hash"),
    )
    first = Window.partitionBy("id", "text_hash").orderBy(F.lit(1))
    return (
        own.join(stays, ["id", "text_hash"]).withColumn("n", F.row_number().over(first)).filter("n = 1").select("doc.*")
    )
