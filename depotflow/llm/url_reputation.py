"""Url filter by host reputation: empirical Bayes with beta-binomial priors, DataFrame functions only.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain and suffix.  A level's rate is
shrunk to that of the level above: (good + strength * rate above) / (n + strength).  The strength of each
level, a beta prior's sum of parameters, is fitted by moments from how much the groups of that level differ
from the level above beyond chance.  A host is blocked when the lower bound of its posterior, so many standard deviations below
the mean, is under a threshold.  Hosts without labels take the posterior of their domain, or of what lies
above it.  Rules given by name come first: the longest that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Standard deviations below the mean, least bound that is allowed.
DEVIATIONS, LEAST = 1.645, 0.5

#: Bounds of a level's prior strength.
WEAKEST, STRONGEST = 1.0, 1000.0

#: Suffixes of two labels (parameter; all other suffixes are the last label).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in")

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(two.isin(*LONG_SUFFIXES), three).otherwise(two)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (verdict, ``host/path``) that fits, as ``host/path``, or null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    found = F.lit(None).cast("string")
    for rule in sorted({rule for _, rule in rules}, key=len):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _moments(groups: DataFrame):
    """Labelled groups, pages, sums of n r squared and of n r (1 - r), r being a group's rate."""
    good, n = F.col("good"), F.col("n")
    return groups.where(n > 0).agg(
        F.count("*").alias("k"),
        F.sum("n").cast("double").alias("n"),
        F.sum(good / n * good).alias("squares"),
        F.sum(good * (1 - good / n)).alias("binomial"),
    ).first()


def _strength(groups, above) -> float:
    """Strength of the beta prior that spreads a level's rates around those of the level above, from the
    moments of both, within bounds.

    With no two groups under one, or no more variance than chance gives, the groups count as alike.
    """
    if not groups["n"] or groups["k"] <= above["k"]:
        return STRONGEST
    binomial = above["binomial"] / above["n"]
    between = (groups["squares"] - above["squares"]) / above["n"]
    excess = between - binomial * (groups["k"] - above["k"]) / above["n"]
    if excess <= 0:
        return STRONGEST
    return float(min(max(binomial / excess - 1, WEAKEST), STRONGEST))


def reputation(counts: DataFrame) -> DataFrame:
    """Posterior lower bound ``bound`` of every host, from labelled pages and good ones (host, n, good).

    Hosts with n = 0 are allowed: they have the bound of the level above.
    """
    hosts = counts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "good")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    every = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = ((every["good"] or 0) + 0.5) / ((every["n"] or 0) + 1.0)
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    moments = [_moments(level) for level in (whole, suffixes, domains, hosts)]
    of_suffix, of_domain, of_host = (_strength(own, above) for above, own in zip(moments, moments[1:]))

    def shrunk(above, strength: float) -> Column:
        return (F.col("good") + above * strength) / (F.col("n") + strength)

    suffixes = suffixes.select("suffix", shrunk(F.lit(rate), of_suffix).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(F.col("suffix_rate"), of_domain).alias("domain_rate"))
    mean = shrunk(F.col("domain_rate"), of_host)
    return hosts.join(domains, "domain").select(
        "host", "n", "good", (mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (F.col("n") + of_host + 1))).alias("bound")
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the host's labelled and good pages and bound.

    ``pages`` has page_id and url, ``outcomes`` url and good (0 or 1; other values are ignored); other columns
    are ignored.  A url that is null or has no ``://`` has an empty host and path; the empty host has a
    reputation as any other.  Repeated pages give a row each; empty tables are allowed (without outcomes all
    hosts have the bound of the prior).
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = parts.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("good"))
    known = (
        outcomes.where(F.col("good").isin(0, 1))
        .select(host_of(F.col("url")).alias("host"), F.col("good").cast("long"))
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    )
    counts = seen.unionByName(known).groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    judged = parts.join(reputation(counts), "host", "left")
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for decides, rule in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(decides)).otherwise(verdict)
    own = F.when(F.coalesce(F.col("bound"), F.lit(0.0)) >= LEAST, "allow").otherwise("block")
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(verdict, own).alias("verdict"),
        "n",
        "good",
        "bound",
    )
