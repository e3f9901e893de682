import random

import numpy as np
from pyspark.sql import functions as F

from martloom.llm import queries
from martloom.llm import toxicity as m

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_matches_edit_distances():
    terms = ["idiot", "moron", "clown", "cat", "stupid", "stupor"]
    automaton, rng = m.Automaton(terms), random.Random(7)
    for _ in range(5000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "i", "o", "t", "z"])
        word = "".join(word)
        near = [(d, k) for k, t in enumerate(terms) if (d := distance(word, t)) == 0 or d == 1 and len(t) >= m.LEAST_LETTERS]
        assert automaton.find(word) == (min(near)[::-1] if near else None), word


def test_quotation_and_misspelling_lower_a_hit():
    finder = m.Finder(["idiot"], ["idiom"])
    kinds = lambda text: [(x[2], x[3]) for x in finder.hits(text)]
    assert kinds("you idiot") == [(False, False)]
    assert kinds("you idi0t and an idiom") == [(True, False)]
    assert kinds('the word "idiot" is old') == [(False, True)]
    assert kinds("she said idiot once") == [(False, True)]
    assert kinds("don't be an idiot, it's bad") == [(False, False)]


def test_scores_of_few_hits_where_labels_say_nothing():
    rows = [[1.0, 0, 0, 0, 0]] * 3000 + [[1.0, 2.5, 0, 0, 0]] * 300
    w = m._fit(np.array(rows), np.array([0] * 3000 + [1] * 300))
    score = lambda *x: 1 / (1 + np.exp(-np.dot([1.0, *x], w)))
    assert score(0, 0, 0, 0) < 0.05
    assert score(1, 0, 0, 0) >= m.TOXIC_FROM > score(0, 1, 0, 0)
    assert score(0, 1.6, 0, 0) >= m.TOXIC_FROM
    assert score(0, 0, 1.6, 0) < m.TOXIC_FROM


def test_held_out_labels(spark):
    rows = queries.op3_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    cells = {(r.toxic, r.predicted): r["count"] for r in rows.filter("held_out AND toxic IS NOT NULL").groupBy("toxic", "predicted").count().collect()}
    toxic = cells.get((1, 0), 0) + cells.get((1, 1), 0)
    clean = cells.get((0, 0), 0) + cells.get((0, 1), 0)
    assert cells[1, 1] / toxic > 0.85
    assert cells.get((0, 1), 0) / clean < 0.02


def test_odd_rows_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    for docs, own in ((odd, labels), (odd, labels.limit(0)), (odd.limit(0), labels)):
        rows = m.scored(docs, m.train(docs, own, F.lit(True))).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.score <= 1 for r in rows)
