from pyspark.sql import functions as F

from martloom.llm import url_filter as m


def test_hosts_and_paths(spark):
    cases = {
        "http://WWW.Example.NET/en/a?b#c": ("www.example.net", "/en/a"),
        "no scheme": ("", ""),
        None: ("", ""),
        "": ("", ""),
        "://": ("", ""),
        "x://h?q://z/": ("h", ""),
        "ftp://a.B:80#f/x": ("a.b:80", ""),
        "http://h/a\nb": ("h", "/a\nb"),
        "http://ÄB.org/Ü": ("Äb.org", "/Ü"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: (r.h, r.p) for r in df.select("url", m.host_of(F.col("url")).alias("h"), m.path_of(F.col("url")).alias("p")).collect()}
    assert got == cases


def test_longest_rule_wins(spark):
    cases = {
        ("a.example.net", "/en/x"): "example.net/en/",
        ("a.example.net", "/fr/x"): "net/",
        ("net", "/"): "net/",
        ("a.net", ""): None,
        ("notexample.com", "/de/"): None,
        ("example.com", "/de/"): "example.com/de/",
        ("x.org", "/fr/"): "org/fr/",
        ("anet", "/"): None,
        ("", ""): None,
        ("." * 500 + "net", "/"): "net/",
    }
    df = spark.createDataFrame([(h, p) for h, p in cases], "h string, p string")
    got = {(r.h, r.p): r.rule for r in df.select("h", "p", m.rule_of(F.col("h"), F.col("p"))["rule"].alias("rule")).collect()}
    assert got == cases
    assert df.select(m.rule_of(F.col("h"), F.col("p"), [])["rule"].alias("rule")).filter("rule IS NOT NULL").count() == 0


def test_reputations_are_shrunk_and_block_by_their_bound(spark):
    good = [("good.example.com", 1)] * 200 + [("bad.example.com", 0)] * 200 + [("few.example.com", 0), ("few.example.com", 1)]
    good += [(f"h{k}.ok.org", 1) for k in range(30)] + [("x.org", None)]
    outcomes = spark.createDataFrame(good, "host string, good int")
    hosts = ["good.example.com", "bad.example.com", "few.example.com", "new.ok.org", "elsewhere.xyz"]
    pages = spark.createDataFrame([(k, f"http://{h}/") for k, h in enumerate(hosts)] + [(9, None)], "page_id long, url string")
    rows = {r.host: r for r in m.judged(pages, outcomes, rules=[]).collect()}
    assert rows["bad.example.com"].verdict == "block"
    assert rows["good.example.com"].verdict == "allow"
    assert rows["few.example.com"].verdict == "allow"
    assert rows["bad.example.com"].mean < rows["few.example.com"].mean < rows["good.example.com"].mean
    assert rows["new.ok.org"].mean > rows["few.example.com"].mean
    assert rows[""].path == "" and rows[""].verdict == "allow"


def test_no_outcomes_and_no_pages(spark):
    outcomes = spark.createDataFrame([], "host string, good int")
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in m.judged(pages, outcomes).collect()] == ["allow"] * 3
    assert m.judged(pages.limit(0), outcomes).count() == 0
