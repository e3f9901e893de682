"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer.

No hand labels are used. Eight overlapping heuristics look at a text and vote good, bad or nothing. How often each vote
comes with good and with bad texts is estimated from the whole corpus: the votes of all documents are counted by pattern,
of which there are at most 3 ** 8, and EM runs on those counts. The posterior of each pattern labels a bounded sample of
documents, on which a logistic regression over hashed features is fitted: frequencies of runs of four character classes,
and steps of word repetition and variety. The scorer alone decides.

Defined results: a null or empty text has no features and the score of an average text of the corpus, so it stays as long
as most texts do. An empty table gives an empty table. Rows that repeat are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import text_of

#: Documents that the scorer is fitted on at most.
SAMPLE = 4000
DIMENSIONS = 2048
#: Documents whose probability of being good is below this are rejected.
LEAST_GOOD = 0.62
LABELLERS = 8
_SYMBOLS = b"%#*$&~^<>{}[]\\=_+@"
_STEPS = 16
#: Words of a window that distinct words are counted in, and of the shortest last one whose share can be the least.
_WINDOW, _REST = 2000, 40
_FEW = 16


def _classes() -> np.ndarray:
    kinds = np.full(256, 9, np.uint32)
    for kind, chars in enumerate(
        (bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t\r", b"\n", b".?;:,", b"!", b"|", _SYMBOLS)
    ):
        kinds[list(chars)] = kind
    kinds[128:] = 0
    return kinds


_CLASS = _classes()


@dataclass(frozen=True)
class Shape:
    """What labellers and features look at; shares are of bytes, words or lines. varied and least_varied are the mean,
    weighted by words, and the minimum of the shares of distinct words in consecutive windows of the whole text."""

    words: int
    repeated: float
    varied: float
    least_varied: float
    symbols: float
    capitals: float
    bars: float
    shouts: float
    sentence: float
    same_lines: float


def _shape(data: bytes, counts: np.ndarray) -> Shape:
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = max(1, int(counts[0] + counts[1]))
    windows = [(min(_WINDOW, n - k), len(set(words[k : k + _WINDOW])) / min(_WINDOW, n - k)) for k in range(0, n, _WINDOW)]
    ends = sum(data.count(x) for x in (b". ", b".\n", b"? ", b"! ", b"!\n")) + data.endswith((b".", b"!", b"?"))
    return Shape(
        words=len(words),
        repeated=sum(map(eq, words, words[1:])) / n,
        varied=sum(k * share for k, share in windows) / n,
        # A short rest at the end says little.
        least_varied=min(share for k, share in windows if k >= min(n, _REST)),
        symbols=float(counts[8]) / max(1, len(data)),
        capitals=float(counts[1]) / letters,
        bars=float(counts[7]) / n,
        shouts=float(counts[6]) / n,
        sentence=n / max(1, ends),
        same_lines=1 - len(set(lines)) / max(1, len(lines)),
    )


def votes(s: Shape) -> str:
    """One letter a labeller: g for good, b for bad, - for no vote."""

    def vote(value: float, good_below: float, bad_from: float) -> str:
        return "g" if value < good_below else "b" if value >= bad_from else "-"

    if not s.words:
        return "-" * LABELLERS
    varied = vote(1 - s.varied, 0.55, 0.8)
    if varied == "g" and 1 - s.least_varied >= 0.8:
        varied = "-"
    return "".join(
        (
            vote(s.repeated, 0.05, 0.2),
            "-" if s.words < 40 else varied,
            vote(s.symbols, 0.01, 0.04),
            "-" if s.words < 10 else vote(s.capitals, 0.1, 0.35),
            vote(s.bars, 0.02, 0.15),
            vote(s.shouts, 0.05, 0.3),
            "-" if s.words < 40 else vote(s.sentence, 30, 120),
            "-" if s.words < 40 else vote(s.same_lines, 0.05, 0.5),
        )
    )


def features(data: bytes) -> tuple[np.ndarray, Shape]:
    """Hashed features of a text, and its shape."""
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    s = _shape(data, np.bincount(kinds, minlength=10))
    half = DIMENSIONS // 2
    x = np.zeros(DIMENSIONS, np.float32)
    if len(kinds) > 3:
        runs = ((kinds[:-3] * 10 + kinds[1:-2]) * 10 + kinds[2:-1]) * 10 + kinds[3:]
        runs = (runs * np.uint32(2654435761)) >> np.uint32(32 - half.bit_length() + 1)
        x[:half] = np.sqrt(np.bincount(runs, minlength=half)[:half] / len(runs))
    if s.words:
        # A text of one window has its variety as mean and as minimum.
        for k, value, part in ((0, s.repeated, 1), (1, s.varied, 0.5), (1, s.least_varied, 0.5), (2, s.same_lines, 1)):
            x[half + (k * 7919 + int(value * (_STEPS - 1)) * 104729) % half] += part
    return x, s


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield part, part.column(at).to_pylist()


def _as_bytes(text: str) -> F.Column:
    return text_of(text).cast("binary")


def vote_counts(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How many documents have each pattern of votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches, 0):
            own = [votes(_shape(x, np.bincount(_CLASS[np.frombuffer(x, np.uint8)], minlength=10))) for x in texts]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], ["votes"])

    rows = docs.select(_as_bytes(text).alias("text")).mapInArrow(run, "votes string").groupBy("votes").count()
    return {r["votes"]: r["count"] for r in rows.collect()}


def posteriors(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Probability of good of each pattern, by EM. No vote is no evidence.

    A bad text has one fault, not all, so most labellers find nothing wrong with it. EM begins with any bad vote as
    bad, and a labeller's rates of bad votes have priors twice as heavy as the corpus: 0.05 % of good texts, 15 % of bad ones.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    bad = np.array([[v == "b" for v in p] for p in patterns]).reshape(len(patterns), LABELLERS)
    voted = np.array([[v != "-" for v in p] for p in patterns]).reshape(len(patterns), LABELLERS)
    good = np.where(bad.any(axis=1), 0.05, 0.95)
    total = n.sum() + 1
    for _ in range(rounds):
        log = []
        for share, rate in ((1 - good, 0.15), (good, 0.0005)):
            weight = n * share
            rates = (weight @ bad + 2 * rate * total) / (weight @ voted + 2 * total)
            one = np.where(bad, np.log(rates), np.log(1 - rates)) * voted
            log.append(one.sum(axis=1) + np.log((weight.sum() + 1) / (total + 1)))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return dict(zip(patterns, good.tolist(), strict=True))


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 250, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels, by Nesterov's gradient steps; bad and good weigh alike."""
    share = np.clip(y.mean(), 0.02, 0.98)
    weight = y / share + (1 - y) / (1 - share)
    weight /= weight.sum()
    step = 4 / max(1e-6, float(np.einsum("ij,ij->i", x, x).max()) + 1)
    w, bias = np.zeros(x.shape[1], np.float32), 0.0
    vw, vb = w.copy(), 0.0
    for k in range(rounds):
        gap = weight * (1 / (1 + np.exp(-(x @ vw + vb))) - y)
        nw, nb = vw - step * (x.T @ gap + ridge * vw).astype(np.float32), vb - step * float(gap.sum())
        vw, vb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - bias)
        w, bias = nw, nb
    return w, bias


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> dict:
    """Weights of the scorer, from the documents with the smallest hashes."""
    counts = vote_counts(docs, text)
    total = sum(counts.values())
    if not total:
        return {"weights": np.zeros(DIMENSIONS, np.float32), "bias": 0.0, "mean": 0.0}
    labels = posteriors(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            found = [features(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([votes(s) for _, s in found], pa.string()),
                    pa.array([x.astype(np.float16).tobytes() for x, _ in found], pa.binary()),
                ],
                ["place", "votes", "features"],
            )

    place = F.xxhash64(F.lit("quality"), F.col(doc_id), F.col(text))
    # A threshold leaves about twice the sample, of which the smallest are taken: few rows and few texts move.
    most = min(2**63 - 1, int(min(1.0, 2 * sample / total) * 2**64) - 2**63)
    rows = docs.select(place.alias("place"), _as_bytes(text).alias("text")).filter(F.col("place") <= most)
    rows = rows.mapInArrow(run, "place bigint, votes string, features binary").orderBy("place", "votes").limit(sample).collect()
    x = np.array([np.frombuffer(r["features"], np.float16) for r in rows], np.float32).reshape(len(rows), DIMENSIONS)
    y = np.array([labels[r["votes"]] for r in rows])
    weights, bias = _fit(x, y) if len(rows) else (np.zeros(DIMENSIONS, np.float32), 0.0)
    mean = float((x @ weights).mean()) if len(rows) else 0.0
    return {"weights": weights, "bias": float(bias), "mean": mean}


def scored(docs: DataFrame, model: dict, text: str = "text", score: str = "score", least: float | None = None) -> DataFrame:
    """The rows of docs with the probability of being good in a column `score`, which replaces one of that name.

    With `least`, only rows of at least this probability come back from the workers.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, mean = (model.value[k] for k in ("weights", "bias", "mean"))
        at = names.index(text)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [x or b"" for x in part.column(at).cast(pa.binary()).to_pylist()]
                # A few characters say little: a short text is drawn towards the average text.
                said = np.array([len(x) / (len(x) + _FEW) for x in texts])
                logits = bias + mean + said * (np.array([float(features(x)[0] @ weights) for x in texts]) - mean)
                found = 1 / (1 + np.exp(-logits))
                out = pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], [*names, score])
                yield out if least is None else out.filter(pa.array(found >= least))

    own = docs.select(*names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields]
    return own.mapInArrow(run, ", ".join([*fields, f"`{score}` double"]))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, kept) of each row of docs."""
    rows = scored(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), train(docs, doc_id, text))
    return rows.select("doc_id", "score", (F.col("score") >= LEAST_GOOD).alias("kept"))


def keep_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are good enough, whole."""
    score = "quality_score"
    while score in docs.columns:
        score += "_"
    return scored(docs, train(docs, doc_id, text), text, score, LEAST_GOOD).select(*docs.columns)
