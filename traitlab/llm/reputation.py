"""Url filters: explicit rules first, then empirical-Bayes host reputation.

A url is decided by the longest explicit rule that fits its host and path.
The others are judged by their host's reputation: labelled page outcomes (1
bad, 0 good, null unlabelled) are counted per host and shrunk through
beta-binomial priors from the suffix over the registered domain to the host.
Each level's prior has the mean of the level above and a strength estimated
from the spread of the rates at its own level (method of moments). A host is
blocked when the lower posterior bound of its bad rate exceeds ``MAX_BAD``; a
host without labels has its domain's posterior.

Defined results: a null url, or one without ``://``, has empty host and path
and is allowed; hosts are compared with A-Z lowered; repeated rows are judged
one by one; an empty table gives an empty result; input columns are carried,
those named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, broadcast_if_small

RULES = (("block", "net/"), ("allow", "example.net/en/"),
         ("block", "example.com/de/"), ("allow", "org/fr/"))
# Suffixes of two labels under which domains are registered; others have one.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz",
                   "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in",
                   "co.kr", "co.za", "com.ar", "com.tw")
MAX_BAD = 0.5
Z = 1.645
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1e4


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.regexp_extract(host, "([^.]*\\.[^.]*)$", 1)
    return F.when(two.isin(*DOUBLE_SUFFIXES), two).otherwise(F.regexp_extract(host, "([^.]*)$", 1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it; a bare suffix is its own domain."""
    two, three = (F.regexp_extract(host, p, 1) for p in ("([^.]*\\.[^.]*)$", "([^.]*\\.[^.]*\\.[^.]*)$"))
    found = F.when(two.isin(*DOUBLE_SUFFIXES), three).otherwise(two)
    return F.when(found == "", host).otherwise(found)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as (verdict, rule), or null."""
    chosen = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        where, _, rest = rule.partition("/")
        fits = ((host == where) | host.endswith("." + where)) & path.startswith("/" + rest)
        chosen = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
                        ).otherwise(chosen)
    return chosen


def _strength(groups: DataFrame) -> tuple[float, float]:
    """Overall rate and prior strength of a level with counts ``n`` and ``bad``."""
    rate = F.col("bad") / F.col("n")
    n, k, bad, square = groups.where("n > 0").agg(
        F.sum("n"), F.count(F.lit(1)), F.sum("bad"), F.sum(F.col("n") * rate * rate)).first()
    if not n:
        return 0.0, MAX_STRENGTH
    p = bad / n
    noise, spread = p * (1 - p), square / n - p * p
    excess = spread - noise * k / n
    if excess <= 1e-9:
        return p, MAX_STRENGTH
    return p, min(max((noise - spread) / excess, MIN_STRENGTH), MAX_STRENGTH)


def host_reputation(pages: DataFrame) -> DataFrame:
    """Per host: labelled pages ``n``, ``bad`` ones, posterior ``bad_rate``
    and its lower bound ``bad_at_least``. ``pages`` has ``host`` and ``outcome``.

    Counts combine on the map side; only two scalars a level reach the driver.
    """
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    hosts = (pages.where(F.col("host") != "").groupBy("host")
             .agg(F.count("outcome").alias("n"),
                  F.coalesce(F.sum(F.col("outcome").cast("long")), F.lit(0)).alias("bad"))
             .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
             .checkpoint())
    domains = hosts.groupBy("domain", "suffix").agg(*counts).checkpoint()
    suffixes = domains.groupBy("suffix").agg(*counts).checkpoint()
    rate, k_suffix = _strength(suffixes)
    _, k_domain = _strength(domains)
    _, k_host = _strength(hosts)
    suffixes = suffixes.select("suffix", ((rate * k_suffix + F.col("bad")) / (k_suffix + F.col("n"))
                                          ).alias("suffix_rate"))
    domains = (domains.join(suffixes, "suffix")
               .select("domain", ((F.col("suffix_rate") * k_domain + F.col("bad"))
                                  / (k_domain + F.col("n"))).alias("domain_rate")))
    total = k_host + F.col("n")
    mean = (F.col("domain_rate") * k_host + F.col("bad")) / total
    return (hosts.join(domains, "domain")
            .select("host", "n", "bad", mean.alias("bad_rate"),
                    (mean - Z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("bad_at_least")))


def filter_urls(pages: DataFrame, outcome: Column, url: str = "url",
                rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``outcome`` is an expression over the page's columns. Only the blocked
    hosts are joined back to the pages.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "_rule", "_blocked")
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    blocked = (host_reputation(parsed.select("host", outcome.alias("outcome")))
               .where(F.col("bad_at_least") > MAX_BAD)
               .select(F.col("host").alias("_blocked")).checkpoint())
    judged = (parsed.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
              .join(broadcast_if_small(blocked, "_blocked"), F.col("host") == F.col("_blocked"), "left"))
    return judged.withColumns({
        "rule": F.col("_rule")["rule"],
        "verdict": F.coalesce(F.col("_rule")["verdict"], F.when(F.col("_blocked").isNotNull(), "block"),
                              F.lit("allow")),
    }).drop("_rule", "_blocked")


# Terms and symbol runs whose presence makes a fetched page a bad outcome.
BAD_PAGE = ("(?i)idiot|stupid|pathetic|disgusting|worthless|moron|"
            "cheap pills|[%]{3}|[#]{3}|[*]{3}")


def page_outcome(html: Column) -> Column:
    """1 for a page with abusive terms or symbol junk, 0 for another page with
    content, null (unlabelled) without content."""
    return F.when(F.coalesce(html, F.lit("")) != "", html.rlike(BAD_PAGE).cast("int"))
