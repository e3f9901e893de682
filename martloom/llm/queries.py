"""The registered queries of the text operators; importing this module fills the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.llm import (
    byte_bpe,
    exact_dedup,
    jaccard_join,
    license_scan,
    mixing,
    phrases,
    quality,
    resample,
    simhash,
    suffix_dedup,
    top_k,
    toxicity,
    url_filter,
)
from martloom.llm.common import ORACLES, QUERIES, register, table

__all__ = ["ORACLES", "QUERIES"]


@register(
    "op9_exact_dedup",
    """
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(coalesce(d.text, '')) AS text_sha256
    FROM documents d
    JOIN (SELECT coalesce(text, '') AS body, max(doc_id) AS keep_id, count(*) AS group_size
          FROM documents GROUP BY coalesce(text, '')) g
      ON coalesce(d.text, '') = g.body
    """,
)
def op9_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"
    )


@register("op5_simhash")
def op5_simhash(spark, sf_dir):
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    tokens = byte_bpe.tokens_of(spark, table(spark, sf_dir, "documents"))
    return byte_bpe.digests(byte_bpe.decode(tokens, byte_bpe.default_vocabulary()[0]))


@register("op2_quality")
def op2_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


@register("op8_mixing")
def op8_mixing(spark, sf_dir):
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "block", "slot", "release", "deadline", "in_mix")


@register("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rows = toxicity.scored(docs, toxicity.train(docs, labels, ~held_out))
    return rows.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"),
    )


# Hosts, domains and suffixes are shrunk in turn; the constants are those of the operator's module.
_URL_SQL = """
WITH cut AS (
    SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           CASE WHEN length(html) > 0 THEN
               CASE WHEN (length(html) - length(regexp_replace(html, '[%#*$|!]', '', 'g'))) / CAST(length(html) AS DOUBLE) < 0.03
                    THEN 1 ELSE 0 END END AS good
    FROM cut
), counted AS (
    SELECT host, regexp_extract(host, '([^.]*\\.)?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix,
           CAST(count(good) AS DOUBLE) AS n, CAST(coalesce(sum(good), 0) AS DOUBLE) AS good
    FROM named GROUP BY host
), whole AS (
    SELECT (sum(good) + 1) / (sum(n) + 2) AS prior FROM counted
), s AS (
    SELECT suffix, sum(n) AS n, sum(good) AS good, max(prior) AS prior FROM counted, whole GROUP BY suffix
), s_part AS (
    SELECT sum(n * power(good / n - prior, 2) / (prior * (1 - prior))) AS spread, count(*) - 1 AS free,
           sum(n) - sum(n * n) / sum(n) AS room
    FROM s WHERE n > 0
), s_rho AS (
    SELECT CASE WHEN sum(spread) IS NULL OR sum(room) - sum(free) <= 0 THEN 0.05
                ELSE least(0.5, greatest(0.001, (sum(spread) - sum(free)) / (sum(room) - sum(free)))) END AS rho
    FROM s_part
), s_mean AS (
    SELECT suffix, (prior * (1 - rho) / rho + good) / ((1 - rho) / rho + n) AS prior FROM s, s_rho
), d AS (
    SELECT c.domain, c.suffix, sum(c.n) AS n, sum(c.good) AS good, max(m.prior) AS prior
    FROM counted c JOIN s_mean m ON c.suffix = m.suffix GROUP BY c.domain, c.suffix
), d_part AS (
    SELECT sum(n * power(good / n - prior, 2) / (prior * (1 - prior))) AS spread, count(*) - 1 AS free,
           sum(n) - sum(n * n) / sum(n) AS room
    FROM d WHERE n > 0 GROUP BY suffix
), d_rho AS (
    SELECT CASE WHEN sum(spread) IS NULL OR sum(room) - sum(free) <= 0 THEN 0.05
                ELSE least(0.5, greatest(0.001, (sum(spread) - sum(free)) / (sum(room) - sum(free)))) END AS rho
    FROM d_part
), d_mean AS (
    SELECT domain, suffix, (prior * (1 - rho) / rho + good) / ((1 - rho) / rho + n) AS prior FROM d, d_rho
), h AS (
    SELECT c.host, c.domain, c.n, c.good, m.prior
    FROM counted c JOIN d_mean m ON c.domain = m.domain AND c.suffix = m.suffix
), h_part AS (
    SELECT sum(n * power(good / n - prior, 2) / (prior * (1 - prior))) AS spread, count(*) - 1 AS free,
           sum(n) - sum(n * n) / sum(n) AS room
    FROM h WHERE n > 0 GROUP BY domain
), h_rho AS (
    SELECT CASE WHEN sum(spread) IS NULL OR sum(room) - sum(free) <= 0 THEN 0.05
                ELSE least(0.5, greatest(0.001, (sum(spread) - sum(free)) / (sum(room) - sum(free)))) END AS rho
    FROM h_part
), h_mean AS (
    SELECT host, (prior * (1 - rho) / rho + good) / ((1 - rho) / rho + n) AS mean, (1 - rho) / rho + n AS weight FROM h, h_rho
)
SELECT p.page_id, p.host, p.path, p.rule,
       CASE p.rule WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
                   WHEN 'net/' THEN 'block'
                   ELSE CASE WHEN m.mean + 1.645 * sqrt(m.mean * (1 - m.mean) / (m.weight + 1)) < 0.6 THEN 'block' ELSE 'allow' END
       END AS verdict
FROM (
    SELECT page_id, host, path,
           CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
    FROM named
) p JOIN h_mean m ON p.host = m.host
"""


@register("op1_url_filter", _URL_SQL)
def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    outcomes = pages.select(url_filter.host_of(F.col("url")).alias("host"), url_filter.outcome_of(F.col("html")).alias("good"))
    return url_filter.judged(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


@register(
    "op10_top_k",
    """
    WITH v AS (
        SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
)
def op10_top_k(spark, sf_dir):
    vectors = top_k.whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    spans = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"))


@register("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.train(docs))
    return found.select("doc_id", "paragraph", "family", "probability", "shared", "confirmed")


@register(
    "op11_phrases",
    """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\n\x0B\x0C\r]')) AS piece
        FROM documents
    ), cut AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces
    ), grams AS (
        SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
        FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
    ), counted AS (
        SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
    ), known AS (
        SELECT * FROM counted WHERE f >= 30
    ), totals AS (
        SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
    ), cuts AS (
        SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM known WHERE k > 1
    ), scored AS (
        SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, c.j,
               CAST(2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
        FROM cuts c
        JOIN known x ON c.lang = x.lang AND array_to_string(c.w[1 : c.j], ' ') = x.phrase
        JOIN known y ON c.lang = y.lang AND array_to_string(c.w[c.j + 1 : c.k], ' ') = y.phrase
    ), worst AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
    ), spans AS (
        SELECT lang, phrase AS outer_phrase, a, k, w, unnest(range(2, k)) AS m
        FROM (SELECT DISTINCT lang, phrase, a, k, w FROM cuts) WHERE k > 2
    ), inside AS (
        SELECT lang, a, unnest([array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase FROM spans
    ), covered AS (
        SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY lang, phrase
    ), kept AS (
        SELECT s.* FROM worst s LEFT JOIN covered o ON s.lang = o.lang AND s.phrase = o.phrase
        WHERE o.longer IS NULL OR 100 * o.longer < 80 * s.a
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
    )
    SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, r.score
    FROM ranked r JOIN totals t ON r.lang = t.lang WHERE r.rank <= 2000
    """,
)
def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register("op12_resample")
def op12_resample(spark, sf_dir):
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register(
    "op13_jaccard_join",
    """
    WITH RECURSIVE worded AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                       ELSE [array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
        FROM worded
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * common >= 85 * (x.n + y.n - common)
    ), edges AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reached AS (
        SELECT doc_id AS root, doc_id FROM documents
        UNION
        SELECT r.root, e.b FROM reached r JOIN edges e ON e.a = r.doc_id WHERE e.b > r.root
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
    FROM documents d
    JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) c ON d.doc_id = c.doc_id
    LEFT JOIN sizes s ON d.doc_id = s.doc_id
    """,
)
def op13_jaccard_join(spark, sf_dir):
    rows = jaccard_join.groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")
