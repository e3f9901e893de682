"""URL filter: host rules first, then an empirical-Bayes reputation of the host. DataFrame functions only.

Labelled outcomes of pages, good or not, are counted by host, registered domain and suffix. Each level's share of good pages
is shrunk towards that of the level above: a suffix towards all pages, a domain towards its suffix, a host towards its
domain. How strongly is estimated from the data: a level whose members differ little from their parents gets a strong
beta prior. A host is blocked if even the upper bound of its posterior share is below a limit, so a host with little
evidence of its own stands or falls with its domain and suffix.

The registered domain is the last two labels of the host and the suffix the last one; a list of longer suffixes can be given.

Defined results: a null url, or one without `://`, has empty host and path; the empty host is a host like any other. Null
outcomes don't count. A host without outcomes has its domain's posterior as prior. Rows that repeat are judged alike, and
outcomes that repeat count as often as they come. An empty table of outcomes blocks nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import held

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: A host is blocked if its share of good pages is below this, at this many standard deviations.
LEAST_GOOD = 0.6
DEVIATIONS = 1.645
LEAST_RHO, MOST_RHO, USUAL_RHO = 0.001, 0.5, 0.05


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _last_labels(host: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(host, r"\."), -F.least(F.size(F.split(host, r"\.")), F.lit(n)), F.lit(2**30)), ".")


def suffix_of(host: Column, longer: Iterable[str] = ()) -> Column:
    longer = list(longer)
    two = _last_labels(host, 2)
    return F.when(two.isin(longer), two).otherwise(_last_labels(host, 1)) if longer else _last_labels(host, 1)


def domain_of(host: Column, longer: Iterable[str] = ()) -> Column:
    longer = list(longer)
    two = _last_labels(host, 2)
    return F.when(two.isin(longer), _last_labels(host, 3)).otherwise(two) if longer else two


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does.

    Only names that end the host, of as many labels as a rule's host has at most, are looked up.
    """
    by_host: dict[str, list] = {}
    for rule_host, rule_path, verdict in rules:
        by_host.setdefault(rule_host, []).append((rule_path, verdict))
    if not by_host:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")

    def rule(of: str, at: str, verdict: str) -> Column:
        return F.struct(
            F.lit(len(of + at)).alias("length"), F.lit(of + at).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(at).alias("path")
        )

    most = max(h.count(".") + 1 for h in by_host)
    known = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*[rule(h, *r) for r in own]))])
    none = F.array().cast("array<struct<length:int,rule:string,verdict:string,path:string>>")
    fitting = F.flatten(
        F.array(
            *[
                F.when(F.size(F.split(host, r"\.")) >= k, F.coalesce(F.element_at(known, _last_labels(host, k)), none)).otherwise(none)
                for k in range(1, most + 1)
            ]
        )
    )
    return F.array_max(F.filter(fitting, lambda r: F.startswith(path, r["path"])))


def _rho(rows: DataFrame, parent: str, prior: str) -> float:
    """How much the members of a level differ from their parents beyond chance, by the method of moments.

    rows: (n, good) of each member, its parent and its parent's share of good pages.
    """
    m = F.col(prior)
    own = rows.filter("n > 0").groupBy(parent).agg(
        F.sum(F.pow(F.col("good") / F.col("n") - m, 2) * F.col("n") / (m * (1 - m))).alias("spread"),
        F.count(F.lit(1)).alias("members"),
        F.sum("n").alias("n"),
        F.sum(F.pow("n", F.lit(2))).alias("squares"),
    )
    t = own.agg(
        F.sum("spread").alias("spread"),
        F.sum(F.col("members") - 1).alias("free"),
        F.sum(F.col("n") - F.col("squares") / F.col("n")).alias("room"),
    ).first()
    if t["spread"] is None or t["room"] - t["free"] <= 0:
        return USUAL_RHO
    return min(MOST_RHO, max(LEAST_RHO, (t["spread"] - t["free"]) / (t["room"] - t["free"])))


def reputations(outcomes: DataFrame, hosts: DataFrame, longer: Iterable[str] = ()) -> DataFrame:
    """(host, n, good, mean, deviation) of each host of either table.

    outcomes: (host, good), good being 0 or 1. hosts: (host).
    """
    counted = (
        outcomes.filter(F.col("good").isNotNull())
        .select("host", F.lit(1).alias("n"), F.col("good").cast("int").alias("good"))
        .union(hosts.select("host", F.lit(0), F.lit(0)))
    )
    own = counted.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    own = held(
        own.select("host", domain_of(F.col("host"), longer).alias("domain"), suffix_of(F.col("host"), longer).alias("suffix"), "n", "good"),
        "hosts",
    )
    total = own.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)

    def shrunk(rows: DataFrame, parent: str) -> DataFrame:
        """With mean and deviation of the posterior: beta, with the parent's mean as prior."""
        rho = _rho(rows, parent, "prior")
        strength = (1 - rho) / rho
        share = (F.col("prior") * strength + F.col("good")) / (strength + F.col("n"))
        return rows.withColumn("mean", share).withColumn(
            "deviation", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (strength + F.col("n") + 1))
        )

    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    suffixes = own.groupBy("suffix").agg(*sums).withColumn("all", F.lit(0)).withColumn("prior", F.lit(mean))
    suffixes = held(shrunk(suffixes, "all").select("suffix", F.col("mean").alias("prior")), "suffixes")
    domains = own.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = held(shrunk(domains, "suffix").select("domain", "suffix", F.col("mean").alias("prior")), "domains")
    return held(
        shrunk(own.join(domains, ["domain", "suffix"]), "domain").select("host", "n", "good", "mean", "deviation"), "reputations"
    )


def judged(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    least_good: float = LEAST_GOOD,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mean, upper) of each row of pages. outcomes: (host, good)."""
    own = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = reputations(outcomes, own.select("host"))
    upper = F.col("mean") + deviations * F.col("deviation")
    rows = own.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).join(known, "host", "left")
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(upper < least_good, "block").otherwise("allow")).alias("verdict"),
        "mean",
        upper.alias("upper"),
    )


def outcome_of(html: Column, most_junk: float = 0.03) -> Column:
    """1 if few of a page's characters are symbols that prose hardly has, 0 if many are; null without a page."""
    symbols = F.length(html) - F.length(F.translate(html, "%#*$|!", ""))
    return F.when(F.length(html) > 0, (symbols / F.length(html) < most_junk).cast("int"))
