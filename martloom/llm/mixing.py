"""Mixing sources to target weights by Pfair scheduling of their blocks.

A source's documents are put in the order of a hash and cut into blocks of so many characters. Block j of a source with
share u of the mix may come from slot floor(j / u) on, its release, and must have come by slot ceil((j + 1) / u), its
deadline. Earliest deadline first among released blocks meets all deadlines, so after any number of slots each source
has had its share of them to within less than one block.

Shares are whole numbers of `resolution` slots, so the schedule repeats after that many slots: one round of it is worked
out, and the slot of any block follows from its number. At the first slot whose source has no more blocks, the schedule
begins anew with the sources that are left, each with its share of their weights, until all blocks have a slot. Tables of
one round of each such phase, of no more rows than `resolution` and than the phase has slots, are broadcast. Positions inside a source come from sums per bucket of the hash, so that no source is put in order in one task.

Defined results: a null source is a source of its own. Without weights, a source weighs its characters to the power
`DAMPING`. A source without a positive weight has no slots, and its documents are not in the mix. Where weights are given,
the mix ends with its first phase unless the caller asks for all of it, as later phases can't have those weights;
documents of later slots are returned with in_mix false. Without weights all documents are in the mix. Null and empty texts have
no characters and come at their place. A document belongs to the block that it begins in. Ids may be null or repeat.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

BLOCK_CHARS = 50_000
RESOLUTION = 10_000
DAMPING = 0.7
#: Documents of a bucket on average.
BUCKET_DOCS = 4000


def whole_shares(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Slots of a round for each source, one at least, by largest remainders."""
    weights = {k: float(w) for k, w in weights.items() if w and w > 0 and math.isfinite(w)}
    total = sum(weights.values())
    exact = {k: w / total * resolution for k, w in weights.items()}
    shares = {k: max(1, int(x)) for k, x in exact.items()}
    order = sorted(exact, key=lambda k: (shares[k] - exact[k], k))
    while shares and sum(shares.values()) < resolution:
        for k in order[: resolution - sum(shares.values())]:
            shares[k] += 1
    while sum(shares.values()) > resolution:
        shares[max(shares, key=lambda k: (shares[k], k))] -= 1
    return shares


def one_round(shares: dict[str, int], blocks: dict[str, int] | None = None) -> list[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of each slot of a round, or of those before a source runs out of blocks."""
    slots = sum(shares.values())
    waiting = [(0, k, 0) for k in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    out = []
    heapq.heapify(waiting)
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * slots // shares[k]), k, j))
        deadline, k, j = heapq.heappop(ready)
        if blocks is not None and j == blocks[k]:
            break
        out.append((k, j, slot, j * slots // shares[k], deadline))
        if j + 1 < shares[k]:
            heapq.heappush(waiting, ((j + 1) * slots // shares[k], k, j + 1))
    return out


def phases(blocks: dict[str, int], weights: dict[str, float], resolution: int) -> tuple[list[tuple], list[tuple]]:
    """The schedule of all blocks of sources with a positive weight.

    (source, phase, start, stop, offset, share, slots) of the blocks that a source has in a phase, and
    (source, phase, step, first, release, deadline) of the slots of one round of it.
    """
    left, done = dict(blocks), dict.fromkeys(blocks, 0)
    parts, rounds, offset, phase = [], [], 0, 0
    while shares := whole_shares({k: weights[k] for k, n in left.items() if n}, max(resolution, 10 * len(left))):
        table, slots = one_round(shares, left), sum(shares.values())
        end = len(table)
        if end == slots:
            slot_of = {(k, j): slot for k, j, slot, _, _ in table}
            # The slot of the first block that a source no longer has.
            end = min(left[k] // w * slots + slot_of[k, left[k] % w] for k, w in shares.items())
        own = Counter(k for k, _, slot, _, _ in table if slot < end % slots)
        for k, w in shares.items():
            n = end // slots * w + own[k]
            if n:
                parts.append((k, phase, done[k], done[k] + n, offset, w, slots))
                done[k], left[k] = done[k] + n, left[k] - n
        rounds += [(k, phase, *x) for k, *x in table]
        offset, phase = offset + end, phase + 1
    return parts, rounds


def placed(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, text_hash, source, place, block) of each row: the block that it begins in, among its source's."""
    rows = held(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(text_of(text)).alias("text_hash"),
            F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("source"),
            F.length(text_of(text)).cast("bigint").alias("chars"),
            F.xxhash64(F.lit("mix"), F.col(doc_id), text_of(text)).alias("place"),
        ),
        "places",
    )
    bits = max(1, math.ceil(math.log2(max(2, rows.count() / BUCKET_DOCS))))
    rows = rows.withColumn("bucket", F.shiftright("place", 64 - bits))
    sums = rows.groupBy("source", "bucket").agg(F.sum("chars").alias("chars"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = held(
        sums.select("source", "bucket", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("start")), "bucket-starts"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("at", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
    return at.join(starts, ["source", "bucket"]).select(
        "doc_id", "text_hash", "source", "place", F.floor((F.col("start") + F.col("at")) / block_chars).alias("block")
    )


def mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    resolution: int = RESOLUTION,
    whole: bool | None = None,
) -> DataFrame:
    """(doc_id, text_hash, source, place, block, slot, release, deadline, in_mix) of each row of docs.

    whole: whether the mix goes on after its first phase; if None, it does unless weights are given.
    """
    rows = held(placed(docs, doc_id, source, text, block_chars), "blocks")
    # One row a source; a mix has far fewer sources than slots.
    blocks = {r["source"]: r["n"] for r in rows.groupBy("source").agg((F.max("block") + 1).alias("n")).collect()}
    if weights is None:
        own = {k: n**DAMPING for k, n in blocks.items()}
    else:
        named = {"" if k is None else f"={k}": w for k, w in weights.items()}
        own = {k: named.get(k, 0) for k in blocks}
    if weights is None if whole is None else whole:
        parts, table = phases(blocks, own, resolution)
        end = 2**63 - 1
    else:
        shares = whole_shares(own, max(resolution, 10 * len(own)))
        slots = sum(shares.values())
        table = one_round(shares)
        slot_of = {(k, j): slot for k, j, slot, _, _ in table}
        # The slot of the first block that a source no longer has.
        end = min((blocks[k] // w * slots + slot_of[k, blocks[k] % w] for k, w in shares.items()), default=0)
        parts = [(k, 0, 0, 2**63 - 1, 0, w, slots) for k, w in shares.items()]
        table = [(k, 0, *x) for k, *x in table]
    one = rows.sparkSession.createDataFrame(
        table, "source string, phase bigint, step bigint, first bigint, release bigint, deadline bigint"
    )
    of_source = rows.sparkSession.createDataFrame(
        parts, "of string, phase bigint, start bigint, stop bigint, offset bigint, share bigint, slots bigint"
    )
    here = (F.col("source") == F.col("of")) & (F.col("block") >= F.col("start")) & (F.col("block") < F.col("stop"))
    stepped = rows.join(F.broadcast(of_source), here, "left").withColumn("step", (F.col("block") - F.col("start")) % F.col("share"))
    rounds = (F.col("offset") + F.floor((F.col("block") - F.col("start")) / F.col("share")) * F.col("slots")).cast("bigint")
    return stepped.join(F.broadcast(one), ["source", "phase", "step"], "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("source") != "", F.substring("source", 2, 2**31 - 1)).alias("source"),
        "place",
        "block",
        (rounds + F.col("first")).alias("slot"),
        (rounds + F.col("release")).alias("release"),
        (rounds + F.col("deadline")).alias("deadline"),
        F.coalesce(rounds + F.col("first") < end, F.lit(False)).alias("in_mix"),
    )


def keep_rows(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    whole: bool | None = None,
) -> DataFrame:
    """The whole rows of the mix, in the order of their slots."""
    names = docs.columns
    rows = mixed(docs, weights, doc_id, source, text, whole=whole).filter("in_mix")
    # Rows that repeat have one place; they are counted, so that none is joined twice.
    places = rows.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text_hash").agg(
        F.min("slot").alias("slot"), F.min("place").alias("place")
    )
    own = docs.select(
        F.struct(*names).alias("doc"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text_of(text)).alias("text_hash"),
    )
    in_order = own.join(held(places, "mix"), ["id", "text_hash"]).repartitionByRange("slot", "place")
    return in_order.sortWithinPartitions("slot", "place").select("doc.*")
