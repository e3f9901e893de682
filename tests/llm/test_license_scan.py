import re
import textwrap

from martloom.llm import license_scan as m

SF = "/root/testdata/sf0.01"
KNOWN = {
    "Apache-2.0": r"Licensed under the Apache License, Version 2\.0\.",
    "MIT": r"Released under the MIT License\.",
    "GPL-3.0": r"This work is licensed under the GNU General Public License, version 3\.",
    "CC-BY-NC-4.0": r"Licensed under CC BY-NC 4\.0\.",
    "All rights reserved": r"All rights reserved\.",
}


def test_finds_the_notices_of_the_documents_and_no_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {
        (r.doc_id, k, family)
        for r in docs.collect()
        for k, line in enumerate(r.text.split("\n"))
        for family, pattern in KNOWN.items()
        if re.search(pattern, line)
    }
    rows = m.scan(docs, m.train(docs)).filter("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in rows} == want


def test_unknown_and_unconfirmed(documents):
    texts = [
        "The license plate was reserved for the license office.",
        "GNU General Public License version 3 applies",
        "first line\n\nThis code is released under the MIT license, as said.",
        "Licensed under CC BY-SA 4.0. " + "word " * 5000,
    ]
    df = documents(texts)
    rows = {(r.doc_id, r.paragraph): r for r in m.scan(df, m.train(df)).collect()}
    assert (0, 0) not in rows
    assert not rows[1, 0].confirmed
    assert rows[2, 2].family == "MIT" and rows[2, 2].confirmed
    assert rows[3, 0].family == "CC-BY-SA-4.0"


def test_every_notice_has_an_anchor_and_its_family(documents):
    notices = [(f, n) for f, own in m.NOTICES.items() for n in own]
    assert all(set(m._words(n)) & set(m.anchors()) for _, n in notices)
    df = documents([n for _, n in notices])
    rows = {r.doc_id: r for r in m.scan(df, m.train(df.limit(0))).collect()}
    right = sum(rows[k].family == f and rows[k].confirmed for k, (f, _) in enumerate(notices) if k in rows)
    assert right >= len(notices) - 2


def test_odd_rows_and_empty_table(odd):
    assert m.scan(odd, m.train(odd)).count() == 0
    assert m.scan(odd.limit(0), m.train(odd.limit(0))).count() == 0


def test_wrapped_notices_are_confirmed_once(documents):
    notices = [(f, n) for f, own in m.NOTICES.items() for n in own if len(n) > 100]
    texts, want = [], set()
    for k, (family, notice) in enumerate(notices):
        for width, mark, gap in ((80, "", "\n"), (70, "# ", "\n#\n"), (45, " * ", "\n")):
            wrapped = [mark + x for x in textwrap.wrap(notice, width)]
            want.add((len(texts), 2 if gap == "\n" else 3, family))
            texts.append(gap.join(["Some title\nand a line of words", "\n".join(wrapped)]) + "\nint main is below")
    df = documents(texts)
    rows = m.scan(df, m.train(df.limit(0))).filter("confirmed").collect()
    assert {(r.doc_id, r.family) for r in rows} == {(d, f) for d, _, f in want}
    assert len(rows) == len(texts)
    twice = m.scan(df.union(df), m.train(df.limit(0))).filter("confirmed")
    assert twice.count() == 2 * len(texts)


def test_notices_wrapped_over_many_lines(documents):
    notices = [(f, n) for f, own in m.NOTICES.items() for n in own if len(n) > 100]
    texts = ["A title line\n" + "\n".join(n.split()) + "\nand so on" for _, n in notices]
    df = documents(texts + [x + "\n\n" + x for x in texts])
    rows = m.scan(df, m.train(df.limit(0))).filter("confirmed").collect()
    assert {(r.doc_id, r.family) for r in rows} == {(k, f) for k in range(2 * len(texts)) for f in [notices[k % len(texts)][0]]}
    # One long notice begins with a short one, which is the better finding; what follows it is another.
    twice = "All rights reserved"
    assert len([r for r in rows if r.family != twice]) == 3 * len([f for f, _ in notices if f != twice])
    assert len([r for r in rows if r.family == twice]) == 6
    assert max(r.text.count("\n") for r in rows) > 35


def test_scores_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = m.train(docs)
    column = {g: k for k, g in enumerate(model["vocabulary"])}
    want = set()
    for r in docs.collect():
        for at, line in enumerate(r.text.split("\n")):
            words = m._words(line)
            z = model["bias"] + sum((model["weights"][column[g]] for g in {*words, *m._pairs(words)} & column.keys()), 0 * model["bias"])
            p = m.np.exp((z - z.max()) / model["temperature"])
            family, probability = model["families"][int(p.argmax())], p.max() / p.sum()
            if family != m.UNKNOWN and probability >= m.LEAST_PROBABILITY:
                shared = max(len(set(m._pairs(words)) & x) / len(x) for n in m.NOTICES[family] for x in [set(m._pairs(m._words(n)))])
                want.add((r.doc_id, at, family, round(float(probability), 4), round(shared, 6), shared >= m.LEAST_SHARED))
    rows = m.scan(docs, model).filter("text not like '%\n%'").collect()
    assert {(r.doc_id, r.paragraph, r.family, round(r.probability, 4), r.shared, r.confirmed) for r in rows} == want


def test_most_of_a_notice_has_a_needed_word():
    needed = m.needed_words()
    rng = m.np.random.default_rng(0)
    for notice in (n for own in m.NOTICES.values() for n in own):
        pairs = sorted(set(m._pairs(m._words(notice))))
        least = int(m.np.ceil(m.LEAST_SHARED * len(pairs)))
        for _ in range(50):
            some = rng.choice(pairs, least, replace=False)
            assert any(w in " ".join(some) for w in needed)
    assert len(needed) < 60


def test_rows_of_files_are_not_broadcast_by_their_compressed_size(spark, documents, monkeypatch):
    plans, held, threshold = {}, m.held, "spark.sql.autoBroadcastJoinThreshold"

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return held(df, label)

    notice = m.NOTICES["MIT"][2]
    texts = ["\n".join(["All rights reserved.", *textwrap.wrap(notice, 60)] * 50)] * 20
    monkeypatch.setattr(m, "held", seen)
    before = spark.conf.get(threshold)
    # Above the size of all files, far below that of what is read from them.
    spark.conf.set(threshold, "50k")
    try:
        df = documents(texts)
        found = m.scan(df, m.train(df.limit(0)))
        plans["found"] = found._jdf.queryExecution().executedPlan().toString()
        rows = found.filter("confirmed").collect()
    finally:
        spark.conf.set(threshold, before)
    assert len(rows) == 2 * 50 * 20 and {r.family for r in rows} == {"All rights reserved", "MIT"}
    for plan in plans.values():
        lines = plan.splitlines()
        for k, line in enumerate(lines):
            if "BroadcastExchange" in line:
                depth = line.index("BroadcastExchange")
                below = next((n for n in range(k + 1, len(lines)) if re.search(r"\w", lines[n]).start() <= depth), len(lines))
                assert "FileScan" not in "".join(lines[k:below]), plan
