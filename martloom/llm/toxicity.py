"""Toxicity: terms and their misspellings found by Levenshtein automata over a lexicon trie, weighed by their context.

The lexicon is learned from labelled documents: terms that come in many more contexts of toxic than of clean texts, where a
context is the word before, so that copies of one text count once. The terms are a trie; a state of the automaton is a set
of (trie node, edits so far), which is the intersection of the trie with the Levenshtein automaton of the word being read,
and states are worked out when a word first reaches them. A word is a hit if a term is at most one edit away; words that
training found in clean texts are no misspellings. Around each hit a window of text says whether the term is quoted: between
quotation marks, or near a word of reporting. Counts of hits, by exactness and quotation, go into a logistic score.

Labels are learned from a bounded number of rows. Scores see the text only.

Defined results: null and empty texts have no hits and get the score of a text without hits. Documents without labels, with
null labels or repeated ids are scored like any other; a label that comes twice counts twice. Without usable labels the
lexicon is empty and all scores are that of a text without hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import held, text_of

#: Labelled documents learned from at most, those with the smallest hashes.
TRAINING_ROWS = 12_000
#: Contexts that a term has in toxic texts at least, and texts that it has them in: so many, and so many for each toxic
#: text learned from. The rarest words of toxic texts are there by chance, as are those that one text repeats.
LEAST_CONTEXTS, LEAST_SHARE = 3, 0.005
LEAST_RATIO = 8.0
#: Share of the terms that may be there by chance.
FALSE_TERMS = 0.1
#: Letters from which a term may be misspelled.
LEAST_LETTERS = 5
TOXIC_FROM = 0.7
WINDOW = 60
_WORD = re.compile(r"[^\W_]+")
#: Words that a task remembers its judgement of, and letters of the longest of them.
_CACHED, _CACHED_LETTERS = 400_000, 40
_OPENING, _CLOSING = "\"“„«‹‘'", "\"”“»›’'"
_REPORTING = re.compile(
    r"\b(?:quot\w*|said|says|wrote|writes|called|calls|claim\w*|report\w*|zitier\w*|sagte|schrieb|nannte|dit|écrit|cité\w*|dijo|citó|escribió)\b"
)
#: Log-odds that a score begins with: of no hit, then of exact, misspelled, quoted and quoted misspelled terms.
_PRIOR = np.array([-3.0, 4.0, 3.0, 1.0, 0.5])
#: What a text with one such term is taken to be where labels don't say, as so many texts of that share of toxic ones:
#: texts with one hit, or with quoted or misspelled ones only, may be rare among the labelled.
_SUPPOSED, _SUPPOSED_ROWS = (0.9, 0.5, 0.05, 0.03), 40


class Automaton:
    """The lexicon's trie, met by words with at most `edits` edits."""

    def __init__(self, terms: list[str], edits: int = 1):
        self.edits = edits
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                node = self.children[node][letter]
            self.term[node] = number
        self.length = [len(t) for t in terms]
        self.letters = set().union(*map(set, terms)) if terms else set()
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes that are reached when letters of a term are left out."""
        todo = list(nodes.items())
        while todo:
            node, used = todo.pop()
            if used < self.edits:
                for child in self.children[node].values():
                    if nodes.get(child, self.edits + 1) > used + 1:
                        nodes[child] = used + 1
                        todo.append((child, used + 1))
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(nodes)
            self.steps.append({})
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        """The state after a letter; -1 if no term is near any more."""
        nodes: dict[int, int] = {}
        for node, used in self.sets[state].items():
            if letter in self.children[node] and nodes.get(self.children[node][letter], 9) > used:
                nodes[self.children[node][letter]] = used
            if used < self.edits:
                for near in (node, *self.children[node].values()):
                    if nodes.get(near, 9) > used + 1:
                        nodes[near] = used + 1
        to = self._state(self._closed(nodes)) if nodes else -1
        self.steps[state][letter] = to
        return to

    def find(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term in reach, the first of such."""
        state = self.start
        for letter in word:
            # Letters that no term has all lead to the same state.
            letter = letter if letter in self.letters else ""
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state < 0:
                return None
        found = [
            (used, self.term[node])
            for node, used in self.sets[state].items()
            if self.term[node] >= 0 and (used == 0 or self.length[self.term[node]] >= LEAST_LETTERS)
        ]
        return min(found)[::-1] if found else None


class Finder:
    """Finds hits in texts; remembers words it has judged."""

    def __init__(self, terms: list[str], clean: list[str]):
        self.automaton = Automaton(terms)
        self.clean = frozenset(clean)
        self.known: dict[str, int] = {}

    def judge(self, word: str) -> int:
        """0: no hit, 1: a term, 2: a misspelled term."""
        found = self.known.get(word)
        if found is None:
            hit = self.automaton.find(word)
            found = 0 if hit is None or (hit[1] and word in self.clean) else 1 if hit[1] == 0 else 2
            if len(self.known) >= _CACHED:
                self.known.clear()
            if len(word) <= _CACHED_LETTERS:
                self.known[word] = found
        return found

    def hits(self, text: str) -> list[tuple[int, int, bool, bool]]:
        """(start, end, misspelled, quoted) of each hit in a lower-case text."""
        known, judge = self.known, self.judge
        if not any([known[w] if w in known else judge(w) for w in _WORD.findall(text)]):
            return []
        out = []
        for m in _WORD.finditer(text):
            if found := judge(m[0]):
                out.append((m.start(), m.end(), found == 2, _quoted(text, m.start(), m.end())))
        return out


def _quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around a term has it between quotation marks, or a word of reporting."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    opened = max((before.rfind(c) for c in _OPENING), default=-1)
    closed = min((k for k in (after.find(c) for c in _CLOSING) if k >= 0), default=-1)
    # A mark opens a quotation if no letter stands before it, and closes one if no letter stands after it.
    if opened >= 0 and closed >= 0:
        if not (opened and before[opened - 1].isalnum()) and not after[closed + 1 : closed + 2].isalnum():
            return True
    return bool(_REPORTING.search(before) or _REPORTING.search(after))


def features(finder: Finder, text: str) -> list[float]:
    counts = [0, 0, 0, 0]
    for _, _, misspelled, quoted in finder.hits(text.lower()):
        counts[2 * quoted + misspelled] += 1
    return [1.0, *(float(np.log2(1 + n)) for n in counts)]


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield part, part.column(at).to_pylist()


def _contexts(train: DataFrame) -> DataFrame:
    """(word, toxic, clean, texts): after how many different words each word comes, by label, and in how many different
    toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            labels, places = part.column(0).to_pylist(), part.column(2).to_pylist()
            rows = [
                (word, before, label, place)
                for label, place, text in zip(labels, places, texts, strict=True)
                for before, word in set(pairwise(["", *_WORD.findall(text.lower())]))
            ]
            types = (pa.string(), pa.string(), pa.int32(), pa.int64())
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "before", "toxic", "place"])

    own = train.select("toxic", "text", F.xxhash64("text").alias("place"))
    pairs = own.mapInArrow(run, "word string, before string, toxic int, place bigint")
    once = pairs.groupBy("word", "before").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("least"))
    once = once.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("least")).alias("clean"))
    texts = pairs.filter("toxic = 1").select("word", "place").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("texts"))
    return once.join(texts, "word", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression around the prior weights, by Newton's steps."""
    one = np.hstack([np.ones((4, 1)), np.eye(4)])
    x = np.vstack([x, np.repeat(one, _SUPPOSED_ROWS, axis=0)])
    y = np.concatenate([y, np.repeat(_SUPPOSED, _SUPPOSED_ROWS)])
    w = _PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + (w - _PRIOR)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), slope)
    return w


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, rows: int = TRAINING_ROWS) -> dict:
    """A model from the labelled documents for which `usable`, a condition on doc_id, holds."""
    own = labels.filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    # At most `rows` rows of two numbers.
    own = held(own.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows).select("doc_id", F.col("toxic").cast("int").alias("toxic")), "labels")
    train = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(own), "doc_id")
    counts = held(_contexts(train), "contexts")
    total = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count(F.lit(1)).alias("words")).first()
    odds = F.col("toxic") / float(total["toxic"] or 1) / ((F.col("clean") + 1) / float(total["clean"] or 1))
    toxic_rows = own.agg(F.sum("toxic")).first()[0] or 0
    seen = F.least("toxic", "texts")
    enough = seen >= max(LEAST_CONTEXTS, LEAST_SHARE * toxic_rows)
    # Chernoff's bound of the logarithm of how likely a word is to be this toxic if labels have nothing to do with words.
    base = min(0.99, max(1e-9, (total["toxic"] or 0) / ((total["toxic"] or 0) + (total["clean"] or 0) or 1)))
    share = seen / (seen + F.col("clean"))
    calm = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    surprise = (seen + F.col("clean")) * (share * F.log(share / base) + calm)
    likely = enough & (share > base) & (odds >= LEAST_RATIO) & (F.length("word") >= 3)
    # Words of at most `rows` texts. As many of the most surprising as leave a tenth of them to chance (Benjamini-Hochberg).
    found = counts.filter(likely).select("word", "toxic", surprise.alias("s")).orderBy(F.desc("s"), "word").collect()
    bounds = np.log((total["words"] or 1) / (FALSE_TERMS * np.arange(1, len(found) + 1)))
    good = np.flatnonzero(np.array([r["s"] for r in found]) >= bounds)
    found = found[: good[-1] + 1] if len(good) else []
    terms = [r["word"] for r in sorted(found, key=lambda r: (-r["toxic"], r["word"]))]

    def misspellings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, terms_too = Automaton(terms), set(terms)
        for batch in batches:
            near = [w for w in batch.column(0).to_pylist() if w not in terms_too and automaton.find(w)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["word"])

    seen = counts.filter("clean > 0").select("word").mapInArrow(misspellings, "word string")
    model = {"terms": terms, "clean": sorted(r["word"] for r in seen.collect())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model["terms"], model["clean"])
        for part, texts in _texts(batches, 1):
            found = pa.array([features(finder, x) for x in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["toxic", "features"])

    seen = train.select("toxic", "text").mapInArrow(run, "toxic int, features array<double>").collect()
    weights = _fit(np.array([r["features"] for r in seen]), np.array([r["toxic"] for r in seen])) if seen else _PRIOR
    return {**model, "weights": [float(w) for w in weights]}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, exact, misspelled, quoted) of each row of docs; the last three say which hits it has."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, weights = Finder(shared.value["terms"], shared.value["clean"]), np.array(shared.value["weights"])
        for part, texts in _texts(batches, 1):
            x = np.array([features(finder, t) for t in texts])
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(score), *(pa.array(c > 0) for c in (x[:, 1], x[:, 2], x[:, 3] + x[:, 4]))],
                ["doc_id", "score", "exact", "misspelled", "quoted"],
            )

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, exact boolean, misspelled boolean, quoted boolean"
    )
