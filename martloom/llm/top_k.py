"""Exact top-k by inner product: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors of whole numbers are sorted by descending length and cut into blocks of bounded size; queries likewise. All are
rotated by the singular vectors of the whole set, so that a few leading components hold most of an inner product. Inside
a pair of blocks, what is left of a product after those components is at most the product of the lengths of the rests,
and a whole product at most that of the lengths. Whatever cannot reach a query's k-th best score is left out by that
bound; the rest is multiplied exactly, as whole numbers. The block of the longest vectors is searched first, and its k-th
scores go to all other blocks as the queries' first thresholds.

Every query block meets every candidate block once, so work grows with queries times candidates, in blocks; no row of a
pair is made but the k best of each block. Queries, a hundredth of the rows, are what is sent to the blocks, by a shuffle;
of vectors, only the block of the longest passes through the driver.

Defined results: vectors that are null or hold a null or non-finite component take no part, as queries or candidates. Only
vectors of one dimension are compared. A candidate with the query's own id is the query's own row. Repeated rows are
candidates each. Ties go to the smaller id. A null id takes no part. Fewer candidates than k give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, merged

K = 10
SCALE = 1024
#: Vectors of a candidate block and of a query block.
BLOCK, QUERY_BLOCK = 8192, 2048
#: Share of the squared length that the leading components hold.
LEADING = 0.7


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<bigint>) of the rows that take part: floor(scale * x), x as double."""
    v = F.col(embedding)

    def odd(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    usable = v.isNotNull() & F.col(vec_id).isNotNull() & ~F.exists(v, odd)
    return rows.filter(usable).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def rotation(vectors: DataFrame, dimension: int) -> tuple[np.ndarray, int]:
    """The right singular vectors of all vectors, and how many of them hold `LEADING` of the squared length.

    A task returns the d x d sums of products of its vectors: as much as the dimension squared, whatever the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            m = _matrix(batch.column(0)).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension**2, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"]
        )

    cells = vectors.select("v").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    gram = np.zeros(dimension**2)
    for r in cells.collect():
        gram[r["cell"]] = r["value"]
    values, axes = np.linalg.eigh(gram.reshape(dimension, dimension))
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    held_by = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(axes), min(dimension, int(np.searchsorted(held_by, LEADING)) + 1)


def _packed(vectors: DataFrame, label: str, size: int) -> DataFrame:
    """One row a block: (block, ids, data), the vectors by descending length; block 0 has the longest."""
    n = vectors.count()
    squared = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    blocks = max(1, -(-n // size))
    ordered = vectors.withColumn("squared", squared).repartitionByRange(blocks, F.desc("squared"), "vec_id").sortWithinPartitions(
        F.desc("squared"), "vec_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, count, made = [], [], 0, 0
        partition = TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            data, own = np.concatenate(parts), np.concatenate(ids)
            longest = float((data[0].astype(float) ** 2).sum())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([longest]),
                    pa.array([(partition << 32) + made], pa.int64()),
                    pa.array([own.tobytes()], pa.binary()),
                    pa.array([data.tobytes()], pa.binary()),
                ],
                ["longest", "place", "ids", "data"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - count)
                at += part.num_rows
                count += part.num_rows
                ids.append(part.column(0).to_numpy())
                parts.append(_matrix(part.column(1)))
                if count == size:
                    yield block()
                    ids, parts, count, made = [], [], 0, made + 1
        if count:
            yield block()

    packed = held(
        ordered.select("vec_id", "v").mapInArrow(run, "longest double, place bigint, ids binary, data binary"), label
    )
    # Two numbers a block go through one task, to number the blocks; vectors don't.
    order = Window.orderBy(F.desc("longest"), "place")
    numbers = packed.select("longest", "place").withColumn("block", F.row_number().over(order) - 1)
    return held(packed.drop("longest").join(numbers.drop("longest"), "place").drop("place"), label)


def best_of(
    ids: np.ndarray, data: np.ndarray, q_ids: np.ndarray, q_data: np.ndarray, least: np.ndarray, axes: np.ndarray, lead: int, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the at most k best candidates of a block for each query, none below its threshold.

    data is sorted by descending length.
    """
    turned, q_turned = data @ axes, q_data @ axes
    rest, q_rest = (np.sqrt((x[:, lead:] ** 2).sum(axis=1)) for x in (turned, q_turned))
    length, q_length = (np.sqrt((x.astype(float) ** 2).sum(axis=1)) for x in (data, q_data))
    partial = q_turned[:, :lead] @ turned[:, :lead].T
    for i in range(len(q_ids)):
        low = least[i]
        # By length alone, the tail of the block is out of reach; float sums are given some room.
        room = 1e-9 * q_length[i] * (length[0] if len(length) else 0) + 1e-6
        end = len(ids) if not np.isfinite(low) else int(np.searchsorted(-length * q_length[i], -(low - room), side="right"))
        bound = partial[i, :end] + q_rest[i] * rest[:end] + room
        if end > 4 * k:
            # Lower bounds of the same kind: k candidates reach at least the k-th largest of them.
            lower = partial[i, :end] - q_rest[i] * rest[:end] - room
            lower[ids[:end] == q_ids[i]] = -np.inf
            low = max(low, float(np.partition(lower, end - k)[end - k]))
        at = np.flatnonzero((bound >= low) & (ids[:end] != q_ids[i]))
        if len(at):
            scores = data[at] @ q_data[i]
            order = np.lexsort((ids[at], -scores))[:k]
            order = order[scores[order] >= least[i]]
            if len(order):
                yield i, ids[at][order], scores[order]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best candidates. Both tables are (vec_id, v array<bigint>)."""
    vectors, queries = held(vectors, "vectors"), held(queries, "query-vectors")
    # One row a dimension that occurs.
    sizes = sorted(r["d"] for r in queries.select(F.size("v").alias("d")).distinct().collect())
    found = [_of_dimension(vectors.filter(F.size("v") == d), queries.filter(F.size("v") == d), d, k, block, query_block) for d in sizes]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = found[0]
    for other in found[1:]:
        rows = rows.union(other)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_dimension(vectors: DataFrame, queries: DataFrame, d: int, k: int, block: int, query_block: int) -> DataFrame:
    spark = vectors.sparkSession
    if d:
        axes, lead = rotation(vectors, d)
    else:
        axes, lead = np.zeros((0, 0)), 0
    shared = spark.sparkContext.broadcast((axes, lead))
    candidates = _packed(vectors, "candidate-blocks", block)
    asked = _packed(queries, "query-blocks", query_block).select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, lead = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                ids, q_ids = (np.frombuffer(get(x), np.int64) for x in ("ids", "q_ids"))
                data = np.frombuffer(get("data"), np.int64).reshape(len(ids), d)
                q_data = np.frombuffer(get("q_data"), np.int64).reshape(len(q_ids), d)
                least = np.frombuffer(get("least"), np.float64) if get("least") else np.full(len(q_ids), -np.inf)
                out = [(get("q_block"), i, q_ids[i], a, s) for i, a, s in best_of(ids, data, q_ids, q_data, least, axes, lead, k)]
                if out:
                    n = [len(x[3]) for x in out]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array([(x[0] << 32) + x[1] for x in out], np.int64), n)),
                            pa.array(np.repeat(np.array([x[2] for x in out], np.int64), n)),
                            pa.array(np.concatenate([x[3] for x in out])),
                            pa.array(np.concatenate([x[4] for x in out])),
                        ],
                        ["query", "query_id", "vec_id", "score"],
                    )

    kind = "query bigint, query_id bigint, vec_id bigint, score bigint"
    # One row, a block of the longest vectors, is broadcast; the query blocks stay where they are.
    first = asked.crossJoin(F.broadcast(candidates.filter("block = 0")))
    best = held(first.withColumn("least", F.lit(None).cast("binary")).mapInArrow(search, kind), "first-best")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = best.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k)
    kth = kth.groupBy(F.shiftright("query", 32).cast("int").alias("q_block")).agg(
        F.collect_list(F.struct(F.col("query").bitwiseAND(2**32 - 1).alias("at"), F.col("score").cast("double").alias("score"))).alias("kth")
    )

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, kth in zip(batch.column("q_ids").to_pylist(), batch.column("kth").to_pylist(), strict=True):
                least = np.full(len(ids) // 8, -np.inf)
                for x in kth or []:
                    least[x["at"]] = x["score"]
                out.append(least.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("q_block", "q_ids", "q_data")), pa.array(out, pa.binary())],
                ["q_block", "q_ids", "q_data", "least"],
            )

    limited = held(
        asked.join(kth, "q_block", "left").mapInArrow(thresholds, "q_block int, q_ids binary, q_data binary, least binary"), "limited"
    )
    last = candidates.count() - 1
    if last < 1:
        return best
    sent = limited.withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(last))))
    # There are as many copies of the query blocks as candidate blocks, which the estimate of their size knows nothing of.
    return best.union(merged(sent, candidates, "block").mapInArrow(search, kind))
