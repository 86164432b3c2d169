"""URL filters: fixed rules, and host reputation by empirical Bayes. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import ascii_lower
from vecloom.sources.staging import stage

# (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# A host goes if its bad share is above LIMIT even this many deviations below the mean.
LIMIT = 0.5
DEVIATIONS = 1.645
# Bounds of a prior's weight, in observations.
WEIGHTS = (1.0, 1000.0)


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


# Labels that countries keep for a second level, under which names are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "gv", "mil", "ne", "net", "nom", "or", "org", "sch")
WIDE = rf"(^|\.)({'|'.join(SECOND_LEVEL)})\.[a-z][a-z]$"
ADDRESS = r"^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*)$"


def site(host: Column) -> Column:
    """The host without user name, port and closing dot: what a reputation belongs to."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), "\\.$", "")


def suffix(site: Column) -> Column:
    """The last label, or the last two where a country keeps the second level; `ip` for addresses."""
    labels = F.when(site.rlike(WIDE), F.substring_index(site, ".", -2)).otherwise(F.substring_index(site, ".", -1))
    return F.when(site.rlike(ADDRESS), F.lit("ip")).otherwise(labels)


def registered_domain(site: Column) -> Column:
    """The suffix and the label before it; an address is its own domain."""
    labels = F.when(site.rlike(WIDE), F.substring_index(site, ".", -3)).otherwise(F.substring_index(site, ".", -2))
    return F.when(site.rlike(ADDRESS), site).otherwise(labels)


def rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _weight(df: DataFrame, mean: str) -> Column:
    """Weight of the prior above a level, from how far the shares of its groups spread around `mean`.

    The variance of a share k/n under a beta-binomial is m(1-m)/n * (1 + (n-1) r) with r =
    1/(weight+1); r is read from the squared deviations.
    """
    m = F.col(mean)
    base = m * (1 - m)
    extra = F.sum((F.col("bad") / F.col("n") - m) * (F.col("bad") / F.col("n") - m) * F.col("n") - base)
    r = extra / F.sum(base * (F.col("n") - 1))
    return F.greatest(F.lit(WEIGHTS[0]), F.least(F.lit(WEIGHTS[1]), F.coalesce(F.when(r > 0, 1 / r - 1), F.lit(WEIGHTS[1]))))


def reputations(pages: DataFrame, limit: float = LIMIT, deviations: float = DEVIATIONS) -> DataFrame:
    """(host, n, bad, mean, bound, blocked) from (host, outcome): 1 bad, 0 good, null unknown.

    The share of bad outcomes of a suffix is drawn towards the overall share, that of a domain
    towards its suffix, that of a host towards its domain, each by a prior whose weight comes
    from the data. `bound` is the posterior mean less `deviations` posterior standard deviations.
    A host without outcomes has its domain's share. Hosts are those of `site`. Tables after the first are one row a host.
    """
    n = F.count("outcome").cast("double")
    counts = pages.groupBy("host").agg(n.alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("double").alias("bad"))
    counts = stage(counts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))}), "hosts")
    domains = stage(counts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()

    def shrunk(level: DataFrame, name: str) -> tuple[DataFrame, float]:
        """`level` holds n, bad and the prior share p; one weight for the whole level."""
        level = stage(level, name)
        w = level.where("n > 0").agg(_weight(level, "p")).first()[0]
        return level.withColumn(name, (F.col("bad") + F.lit(w) * F.col("p")) / (F.col("n") + F.lit(w))), w

    top, _ = shrunk(suffixes.withColumn("p", F.lit(((bad or 0.0) + 0.5) / ((n or 0.0) + 1))), "p_suffix")
    middle, _ = shrunk(domains.join(top.select("suffix", F.col("p_suffix").alias("p")), "suffix"), "p_domain")
    found, w = shrunk(counts.join(middle.select("domain", F.col("p_domain").alias("p")), "domain"), "mean")
    found = found.withColumn("bound", F.col("mean") - deviations * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + w + 1)))
    return found.select("host", "n", "bad", "mean", "bound", (F.col("bound") > limit).alias("blocked"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    limit: float = LIMIT,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of (page_id, url, outcome).

    A rule's verdict stands; other pages are blocked if their host's bound is above the limit, where hosts that
    differ in a user name, a port or a closing dot are one. A
    url that is null or has no `://` has an empty host and path; the empty host is judged like any
    other. Rows are neither merged nor dropped. An empty table gives an empty table.
    """
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), F.col("outcome").cast("int").alias("outcome"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("site", site(F.col("host")))
    known = reputations(rows.select(F.col("site").alias("host"), "outcome"), limit, deviations).select(F.col("host").alias("site"), "blocked")
    return rows.join(known, "site", "left").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
