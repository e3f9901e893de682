from pyspark.sql import functions as F

from martloom.llm import quality as m

SF = "/root/testdata/sf0.1"


def test_held_out_labels_agree(spark):
    """No label is used to fit, so all of them are held out."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = m.judged(docs).join(labels.filter("quality IS NOT NULL"), "doc_id")
    share = {r.quality: r.kept for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.99
    assert share[0] < 0.1


def test_em_trusts_a_labeller_that_alone_sees_a_fault():
    counts = {"g" * 8: 9000, "gggbgggg": 300, "bbgggggb": 500, "-" * 8: 20}
    p = m.posteriors(counts)
    assert p["g" * 8] > 0.9
    assert p["bbgggggb"] < 0.01
    assert p["gggbgggg"] < m.LEAST_GOOD
    assert p["-" * 8] > 0.7


def test_odd_rows(odd):
    rows = m.judged(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    kept = m.keep_rows(odd)
    assert kept.columns == odd.columns
    scored = m.scored(odd, m.train(odd))
    assert sorted(scored.columns) == sorted(odd.columns)


def test_empty_table(odd):
    assert m.judged(odd.limit(0)).count() == 0
    assert m.keep_rows(odd.limit(0)).count() == 0
    assert m.posteriors({}) == {}


def test_variety_is_that_of_the_whole_text():
    sound = [" ".join(f"word{j % 900}" for j in range(k, k + 2000)) for k in range(0, 18_000, 2000)]
    loop = " ".join(["the same few words come again and again"] * 250)
    loops_later = m.features(" ".join([sound[0], *[loop] * 9]).encode())[1]
    loops_first = m.features(" ".join([loop, *sound]).encode())[1]
    one_window = m.features(" ".join([*sound, loop]).encode())[1]
    assert m.votes(loops_later)[1] == "b"
    assert m.votes(loops_first)[1] != "b"
    assert loops_first.varied == one_window.varied and loops_first.least_varied == one_window.least_varied < 0.01
    assert m.votes(one_window)[1] == "-"
    x, y = (m.features(" ".join(parts).encode())[0] for parts in (sound, [*sound, loop]))
    assert (x[m.DIMENSIONS // 2 :] != y[m.DIMENSIONS // 2 :]).any()
    assert m.features(b"a b c " * 700)[1].varied == 3 / 2000 * 2000 / 2100 + 3 / 100 * 100 / 2100
