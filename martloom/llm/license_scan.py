"""Licence scan: a trained paragraph classifier, an unknown class, and templates that confirm. DataFrame functions only.

The classifier is a multinomial logistic regression over which word pairs and words of its vocabulary a paragraph has. It is
fitted on the driver from the notices below, whole and in parts, and from a bounded number of the corpus's own paragraphs
as class `unknown`. Its probabilities are calibrated by a temperature, chosen on notices that were held out of a first
fit. A paragraph is of a family if that family's calibrated probability is high enough, else unknown; a family is
confirmed if the paragraph has most word pairs of one of its notices.

Its vocabulary has no words that the corpus's paragraphs have everywhere. The penalty of the fit makes most weights zero,
and only the others are looked up. Texts and lines are left out first that have none of the words without which the
weights of all others together cannot lift a family to the probability it needs: they are unknown by the weights, not by
a guess. The model is one row, as large as the notices, that every other paragraph meets in a broadcast join, so a
paragraph is scored where it is read.

A paragraph is a line, or neighbouring lines that are confirmed together, as a wrapped notice is. Such lines are found by
the notices' pairs, of which each has one, also across its end, and none is without a letter or digit. There are at most
as many of them as the notice has words. Of those that overlap the one with the larger share of a notice stays, then the
one of fewer lines, then the first. Lines that include one with a whole notice are no finding, nor is a line inside them.
Only texts with a word that most of a notice cannot do without are searched for them.

Defined results: a paragraph's number is that of its first line. Null and empty texts have none. Findings are one row a
paragraph, so rows that repeat give findings that repeat; a null doc_id is carried along. Without documents the classifier
knows the notices alone.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import held, merged, text_of

#: Public licence notices by family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Distributed under the MIT License. See LICENSE for more information.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU GPL v3.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GNU GPL v2.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "All rights reserved": (
        "All rights reserved.",
        "Copyright (c) by the author. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without written permission of the publisher.",
    ),
}
#: Sentences about licences that are none.
OTHER = (
    "The driver lost the license after the accident.",
    "She is a licensed physician and works at the public hospital.",
    "Permission to leave was granted by the general.",
    "A table was reserved for all of us, and the rights of the guests were explained.",
    "The version of the story that the public knows is free of detail.",
    "Parking is permitted with a license only.",
)
UNKNOWN = "unknown"
#: Paragraphs of the corpus that class `unknown` learns from at most.
PARAGRAPHS = 500
LEAST_PROBABILITY = 0.6
#: The penalty on absolute weights.
SPARSE = 5e-4
#: Share of a notice's word pairs that a paragraph of its family has, to be confirmed.
LEAST_SHARED = 0.75
_TOKEN = "[a-z0-9]+(?:[.-][a-z0-9]+)*"


def _words(text: str) -> list[str]:
    return re.findall(_TOKEN, text.lower())


def _pairs(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _examples() -> list[tuple[str, str]]:
    """(family, text): notices whole, and without some of their words at either end."""
    out = []
    for family, notices in NOTICES.items():
        for notice in notices:
            out.append((family, notice))
            words = notice.split()
            if len(words) > 12:
                out += [(family, " ".join(words[:-4])), (family, " ".join(words[4:]))]
    return out


def _fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 500, sparse: float = SPARSE) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by gradient steps, classes weighing alike; a penalty on absolute weights leaves
    most of them zero."""
    w, bias = np.zeros((x.shape[1], classes)), np.zeros(classes)
    truth = np.eye(classes)[y]
    weight = 1 / np.maximum(1, np.bincount(y, minlength=classes))[y]
    weight /= weight.sum()
    step = 2 / max(1.0, float((x**2).sum(axis=1).mean())) * classes
    for _ in range(rounds):
        z = x @ w + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        gap = (p / p.sum(axis=1, keepdims=True) - truth) * weight[:, None]
        w, bias = w - step * (x.T @ gap), bias - step * gap.sum(axis=0)
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
    return w, bias


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature under which held-out classes are likeliest."""

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(-(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))).mean())

    return min((float(t) for t in np.geomspace(0.1, 5, 40)), key=loss)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paragraphs: int = PARAGRAPHS) -> dict:
    """The classifier: families, vocabulary, weights, bias, temperature."""
    # One paragraph, whole, of each of the documents with the smallest hashes, and none with a notice's word.
    place = F.xxhash64(F.lit("licence"), F.col(doc_id), F.col(text))
    # A threshold leaves about four times the number, so that few lines go to the driver whatever the corpus.
    most = min(2**63 - 1, int(min(1.0, 4 * paragraphs / max(1, docs.count())) * 2**64) - 2**63)
    rows = docs.select(place.alias("place"), F.split(text_of(text), "\n").alias("lines")).filter(F.col("place") <= most)
    rows = rows.select("place", F.element_at("lines", (F.pmod("place", F.size("lines")) + 1).cast("int")).alias("line"))
    rows = rows.filter(~_has(F.lower("line"), anchors()))
    own = [r["line"] for r in rows.orderBy("place", "line").limit(paragraphs).collect()]
    families = [*NOTICES, UNKNOWN]
    examples = [*_examples(), *((UNKNOWN, x) for x in (*OTHER, "", *own))]
    # Words that the corpus's paragraphs have everywhere tell no family, nor do pairs of such words.
    seen = Counter(w for x in own for w in set(_words(x)))
    telling = {w for f, x in examples if f != UNKNOWN for w in _words(x) if (len(w) > 1 or w.isdigit()) and 100 * seen[w] < max(200, len(own))}
    grams = {g for f, x in examples if f != UNKNOWN for w in [_words(x)] for g in (*w, *_pairs(w))}
    vocabulary = sorted(g for g in grams if telling & set(g.split(" ")))
    column = {g: k for k, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)))
    for k, (_, example) in enumerate(examples):
        words = _words(example)
        for g in {*words, *_pairs(words)} & column.keys():
            x[k, column[g]] = 1
    y = np.array([families.index(f) for f, _ in examples])
    apart = np.arange(len(examples)) % 4 == 3
    w, bias = _fit(x[~apart], y[~apart], len(families))
    temperature = _temperature(x[apart] @ w + bias, y[apart])
    w, bias = _fit(x, y, len(families))
    used = np.flatnonzero(np.abs(w).max(axis=1))
    return {
        "families": families,
        "vocabulary": [vocabulary[k] for k in used],
        "weights": w[used].round(6),
        "bias": bias.round(6),
        "temperature": temperature,
        "telling": sorted(telling),
    }


def anchors() -> list[str]:
    """Words of which every notice has one: at each step the word that most of the others have."""
    left = [set(_words(n)) for notices in NOTICES.values() for n in notices]
    out = []
    while left:
        words = sorted({w for n in left for w in n})
        best = max(words, key=lambda w: (sum(w in n for n in left), len(w), w) if len(w) > 4 else (0, len(w), w))
        out.append(best)
        left = [n for n in left if best not in n]
    return out


def _has(lower: Column, words: list[str]) -> Column:
    """Whether the text has one of the words. As an element of an array it is worked out once, not once a word."""
    return F.exists(F.array(lower), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words], F.lit(False)))


def deciding_words(model: dict) -> list[str]:
    """Words of which every text of a known family has one.

    A family needs the probability LEAST_PROBABILITY, and so a lead over `unknown`. As many words and pairs as possible,
    those named by short words first, are set aside such that all of them together give no family that lead; each text of
    a known family has one of the others, and so the longest telling word of it.
    """
    families, weights, bias = model["families"], np.asarray(model["weights"]), np.asarray(model["bias"])
    unknown = families.index(UNKNOWN)
    lead = np.delete(weights - weights[:, [unknown]], unknown, axis=1)
    room = model["temperature"] * np.log(LEAST_PROBABILITY / (1 - LEAST_PROBABILITY)) - np.delete(bias - bias[unknown], unknown)
    if (room <= 0).any():
        return [""]
    telling = set(model["telling"])
    word = [max(telling & set(g.split(" ")), key=lambda w: (len(w), w)) for g in model["vocabulary"]]
    spent, out = np.zeros(len(room)), set()
    for k in sorted(range(len(word)), key=lambda k: (len(word[k]) > 3, lead[k].max())):
        gain = np.maximum(lead[k], 0)
        if (spent + gain < room).all():
            spent += gain
        else:
            out.add(word[k])
    return sorted(w for w in out if not any(v != w and v in w for v in out))


def needed_words() -> list[str]:
    """Words of which every text has one that has the share LEAST_SHARED of a notice's pairs.

    Of each notice, the longest words that together touch more of its pairs than may be absent.
    """
    out = set()
    for notices in NOTICES.values():
        for notice in notices:
            pairs = set(_pairs(_words(notice)))
            own: set[str] = set()
            for word in sorted(set(_words(notice)), key=lambda w: (-len(w), w)):
                if sum(not own & set(p.split(" ")) for p in pairs) < LEAST_SHARED * len(pairs):
                    break
                own.add(word)
            out |= own
    return sorted(w for w in out if not any(v != w and v in w for v in out))


def _words_of(lower: Column) -> Column:
    return F.regexp_extract_all(lower, F.lit(_TOKEN), F.lit(0))


def _pairs_of(words: Column) -> Column:
    rest = F.greatest(F.lit(0), F.size(words) - 1)
    return F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat_ws(" ", a, b))


def _notice_pairs(spark: SparkSession) -> DataFrame:
    """(pair, family, notice, of, most_lines): the distinct pairs of each notice, how many there are, and its words."""
    rows, n = [], 0
    for family, notices in NOTICES.items():
        for notice in notices:
            words = _words(notice)
            pairs = sorted(set(_pairs(words)))
            rows += [(pair, family, n, len(pairs), len(words)) for pair in pairs]
            n += 1
    return F.broadcast(spark.createDataFrame(rows, "pair string, family string, notice int, of int, most_lines int"))


def _model_row(spark: SparkSession, model: dict) -> DataFrame:
    rows = [
        (
            0,
            model["families"],
            model["vocabulary"],
            {g: list(map(float, own)) for g, own in zip(model["vocabulary"], model["weights"], strict=True)},
            list(map(float, model["bias"])),
            {f: [sorted(set(_pairs(_words(n)))) for n in own] for f, own in NOTICES.items()},
        )
    ]
    fields = "one int, families array<string>, vocabulary array<string>, weights map<string, array<double>>, bias array<double>"
    return F.broadcast(spark.createDataFrame(rows, fields + ", notices map<string, array<array<string>>>"))


def _classified(paragraphs: DataFrame, model: dict) -> DataFrame:
    """The paragraphs, of column `line`, that are of a known family, with family, probability and shared."""
    # Always 0, but not a constant, which would make the lookup of the one row a nested loop.
    one = F.pmod(F.length("line"), F.lit(1)).alias("one")
    rows = paragraphs.select("*", one).join(_model_row(paragraphs.sparkSession, model), "one")
    rows = rows.withColumn("words", _words_of(F.lower("line"))).withColumn("pairs", _pairs_of(F.col("words")))
    rows = rows.withColumn("grams", F.array_intersect(F.array_union("words", "pairs"), "vocabulary"))
    add = lambda total, g: F.zip_with(total, F.element_at("weights", g), lambda a, b: a + b)
    rows = rows.withColumn("logits", F.aggregate("grams", F.col("bias"), add)).withColumn("most", F.array_max("logits"))
    parts = F.aggregate("logits", F.lit(0.0), lambda total, z: total + F.exp((z - F.col("most")) / model["temperature"]))
    family = F.element_at("families", F.array_position("logits", F.col("most")).cast("int"))
    rows = rows.withColumns({"probability": 1 / parts, "family": family})
    rows = rows.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY))
    share = lambda n: F.size(F.array_intersect("pairs", n)) / F.size(n)
    shared = F.array_max(F.transform(F.element_at("notices", F.col("family")), share))
    return rows.select(*paragraphs.columns, "family", "probability", shared.alias("shared"))


def _wrapped(texts: DataFrame) -> DataFrame:
    """(row, paragraph, size): neighbouring lines of the texts (row, lines) that together have enough of a notice."""
    lines = texts.select("row", F.posexplode("lines").alias("at", "line")).withColumn("words", _words_of(F.lower("line")))
    lines = lines.filter(F.size("words") > 0)
    in_text = Window.partitionBy("row").orderBy("at")
    lines = lines.withColumns({"next_at": F.lead("at").over(in_text), "next_words": F.lead("words").over(in_text)})
    follows = F.col("next_at") == F.col("at") + 1
    across = F.when(follows, F.concat_ws(" ", F.element_at("words", -1), F.element_at("next_words", 1)))
    # A pair stands on its first word's line and needs the line of its second.
    pair = lambda p, end: F.struct(p.alias("pair"), end.alias("end"))
    inside = F.transform(F.array_distinct(_pairs_of(F.col("words"))), lambda p: pair(p, F.col("at")))
    found = lines.select("row", "at", F.explode(F.concat(inside, F.array(pair(across, F.col("at") + 1)))).alias("p")).select("row", "at", "p.*")
    found = held(found.join(_notice_pairs(texts.sparkSession), "pair").drop("family"), "notice-pairs")
    one = ["row", "notice"]
    enough = F.col("n") >= LEAST_SHARED * F.col("of")
    complete = found.groupBy(*one, "of").agg(F.count_distinct("pair").alias("n")).filter(enough).select(*one)
    found = merged(found, complete, one)
    # Neighbouring lines that each begin or end one of the notice's pairs.
    touched = found.select(*one, F.explode(F.array("at", "end")).alias("at")).distinct()
    order = Window.partitionBy(*one).orderBy("at")
    touched = touched.withColumn("island", F.col("at") - F.row_number().over(order))
    starts = touched.select(*one, "island", F.col("at").alias("start"))
    own = found.join(touched, [*one, "at"])
    reach = (F.col("at") >= F.col("start")) & (F.col("end") < F.col("start") + F.col("most_lines"))
    # Each pair's nearest end after a start; the last of them is where the lines have all that they can have.
    ends = own.join(starts, [*one, "island"]).filter(reach).groupBy(*one, "of", "start", "pair").agg(F.min("end").alias("end"))
    spans = ends.groupBy(*one, "of", "start").agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("end"))
    spans = spans.filter(enough & (F.col("end") > F.col("start")))
    return spans.select("row", F.col("start").alias("paragraph"), (F.col("end") - F.col("start") + 1).alias("size")).distinct()


def _apart(wrapped: DataFrame) -> DataFrame:
    """Of wrapped findings of a text that overlap, the best; in the order of their starts, each against the one before."""
    entry = F.struct("paragraph", "size", "family", "probability", "shared")
    found = wrapped.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    last = lambda own: F.element_at(own, -1)

    def step(own: Column, x: Column) -> Column:
        clear = (F.size(own) == 0) | (last(own)["paragraph"] + last(own)["size"] <= x["paragraph"])
        better = (x["shared"] > last(own)["shared"]) | ((x["shared"] == last(own)["shared"]) & (x["size"] < last(own)["size"]))
        instead = F.concat(F.slice(own, F.lit(1), F.size(own) - 1), F.array(x))
        return F.when(clear, F.concat(own, F.array(x))).when(better, instead).otherwise(own)

    kept = F.aggregate("found", F.slice("found", 1, 0), step)
    return found.select("row", F.explode(kept).alias("x")).select("row", "x.*")


def scan(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, shared, confirmed, text) of each paragraph of a known family.

    paragraph counts from 0; shared is the largest share of a notice's word pairs that the paragraph has.
    """
    deciding = deciding_words(model)
    own = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).filter(_has(F.lower("text"), deciding))
    may_wrap = _has(F.lower("text"), needed_words())
    lines = F.posexplode(F.split("text", "\n")).alias("paragraph", "line")
    plain = own.filter(~may_wrap).select("doc_id", lines).filter(_has(F.lower("line"), deciding))
    plain = _classified(plain, model)
    # Written once, so that a text keeps its number.
    texts = own.filter(may_wrap).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.split("text", "\n").alias("lines"))
    texts = held(texts, "licence-texts")
    key = ["row", "paragraph", "size"]
    single = texts.select("row", F.posexplode("lines").alias("paragraph", "line")).withColumn("size", F.lit(1))
    single = held(_classified(single.filter(_has(F.lower("line"), deciding)), model), "licence-lines")
    cover = F.expr("array_join(slice(lines, paragraph + 1, size), '\n')").alias("line")
    joined = merged(texts, _wrapped(texts), "row").select(*key, cover)
    wrapped = held(_classified(joined, model).filter(F.col("shared") >= LEAST_SHARED), "licence-wraps")
    whole = single.filter(F.col("shared") == 1).select("row", F.col("paragraph").alias("at"))
    over = (F.col("at") >= F.col("paragraph")) & (F.col("at") < F.col("paragraph") + F.col("size"))
    with_whole = merged(wrapped, whole, "row").filter(over).select(*key).distinct()
    wrapped = held(_apart(merged(wrapped, with_whole, key, "left_anti")), "licence-apart")
    inside = merged(single.select("row", F.col("paragraph").alias("at")), wrapped.select(*key), "row").filter(over)
    alone = merged(single, inside.select("row", F.col("at").alias("paragraph")).distinct(), ["row", "paragraph"], "left_anti")
    found = merged(alone.drop("line").unionByName(wrapped), texts, "row")
    found = found.select("doc_id", "paragraph", cover, "family", "probability", "shared")
    return plain.unionByName(found).select(
        "doc_id",
        "paragraph",
        "family",
        F.round("probability", 6).alias("probability"),
        F.round("shared", 6).alias("shared"),
        (F.col("shared") >= LEAST_SHARED).alias("confirmed"),
        F.col("line").alias("text"),
    )
