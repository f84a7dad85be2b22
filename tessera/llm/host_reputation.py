"""URL filters: empirical-Bayes host reputation, after explicit host and path rules.

Labelled page outcomes (bad or not) are counted per host, registered domain
and suffix.  Each level's bad rate is a beta-binomial posterior whose prior has
the parent's posterior mean - all pages, suffix, domain, host - and a
concentration estimated from the data: the within-parent (intraclass)
correlation of the level by analysis of variance, pooled over parents and kept
within ``[MIN_PRIOR, MAX_PRIOR]`` pseudo-pages.  A level whose parents have one
child each adds nothing: the parent's prior passes through.  A host is blocked when the
lower bound of its posterior, ``mean - Z * sd`` of the beta distribution,
exceeds ``MARGIN`` times the bad rate of all labelled pages: few labels shrink to
the domain, many speak for themselves, and hosts without any label inherit the
domain's rate.

Counts are map-side combined sums; a host with a third of all pages is one row
per task.  Pages meet their host's verdict in a skew-splittable join of slim
rows; html is never read.

Defined results: a url that is null or has no ``://`` has an empty host and
path and is judged by the method like any host; the empty host, hosts of one
label and suffixes themselves are their own domain; outcomes with no label at
all do not count; repeated labels count each; without any label the prior rate
is one half with no evidence, which blocks nothing; an empty table gives an
empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

MIN_PRIOR, MAX_PRIOR = 1.0, 1000.0
Z = 1.645
#: A host goes when it is surely this many times as bad as the labelled pages are on the whole.
MARGIN = 1.2


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path prefix; fits the host and its subdomains."""

    text: str
    allow: bool


#: Fixed values of the contract.
RULES = (
    Rule("com/", True), Rule("example.com/en/", False), Rule("www.example.com/en/", True),
    Rule("net/es/", False), Rule("net/fr/", False),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest fitting rule's text and its verdict, null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        name, slash, prefix = rule.text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit("allow" if rule.allow else "block")).otherwise(verdict)
    return text, verdict


def _levels(host: Column, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and suffix: the longest listed suffix or else the last label, and one label more."""
    suffix = F.substring_index(host, ".", -1)
    for s in sorted(suffixes, key=len):
        suffix = F.when((host == s) | host.endswith("." + s), F.lit(s)).otherwise(suffix)
    extra = F.substring(host, F.lit(1), F.char_length(host) - F.char_length(suffix) - 1)
    domain = F.when(host == suffix, host).otherwise(F.concat_ws(".", F.substring_index(extra, ".", -1), suffix))
    return domain, suffix


def _within(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """``children`` with their parent's counts ``pn, pb``."""
    return children.join(parents.select(F.col(parent), F.col("n").alias("pn"), F.col("b").alias("pb")), parent)


def _concentration(children: DataFrame, parent: str) -> float | None:
    """Pseudo-pages of the prior: ``(1 - rho) / rho`` for the pooled intraclass correlation ``rho``; none where every
    parent has a single child, so that the level has nothing to estimate.

    ``children``: ``parent, n, b`` and the parent's counts ``pn, pb``.
    """
    p = F.try_divide("pb", "pn")  # a parent without labels has no child with labels
    r = children.where("n > 0").agg(
        F.count("*").alias("k"), F.countDistinct(parent).alias("g"), F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("b") / F.col("n") - p) * (F.col("b") / F.col("n") - p)).alias("between"),
        F.sum(F.col("b") * (1 - F.col("b") / F.col("n"))).alias("within"),
        F.sum(F.try_divide(F.col("n") * F.col("n"), F.col("pn"))).alias("load"),
    ).first()
    if r.k and r.k == r.g:
        return None
    if not r.k or r.n == r.k:
        return MAX_PRIOR
    between, within, n0 = r.between / (r.k - r.g), r.within / (r.n - r.k), (r.n - r.load) / (r.k - r.g)
    spread = between - within
    if spread <= 0:
        return MAX_PRIOR
    rho = spread / (between + (n0 - 1) * within)
    return min(max((1 - rho) / rho, MIN_PRIOR), MAX_PRIOR)


def reputations(pages: DataFrame, outcomes: DataFrame, suffixes: tuple[str, ...] = (), z: float = Z, margin: float = MARGIN) -> DataFrame:
    """``host, domain, suffix, n, bad, mean, lower, blocked`` per host.

    ``pages``: ``_id, host``; ``outcomes``: ``_id, bad`` (boolean).
    """
    domain, suffix = _levels(F.col("host"), suffixes)
    seen = pages.join(outcomes, "_id").groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("b")
    )
    zero = F.lit(0).cast("long")
    hosts = written(
        pages.select("host").distinct().join(seen, "host", "left")
        .select("host", domain.alias("domain"), suffix.alias("suffix"), F.coalesce("n", zero).alias("n"), F.coalesce("b", zero).alias("b")),
        "hosts",
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    whole = tops.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    n, b = whole.n or 0, whole.b or 0
    rate = (b + 1) / (n + 2)
    m1 = _concentration(tops.withColumns({"root": F.lit(0), "pn": F.lit(n), "pb": F.lit(b)}), "root")
    m2 = _concentration(_within(domains, tops, "suffix"), "suffix")
    m3 = _concentration(_within(hosts, domains, "domain"), "domain")
    # a level without a concentration of its own hands its children the prior that it was given
    m1 = MAX_PRIOR if m1 is None else m1
    tops = tops.select("suffix", ((F.col("b") + m1 * rate) / (F.col("n") + m1)).alias("p1"), F.lit(rate).alias("p0"))
    domains = domains.join(tops, "suffix")
    p1, m2 = (F.col("p0"), m1) if m2 is None else (F.col("p1"), m2)
    domains = domains.select("domain", p1.alias("p1"), ((F.col("b") + m2 * p1) / (F.col("n") + m2)).alias("p2"))
    p2, m3 = (F.col("p1"), m2) if m3 is None else (F.col("p2"), m3)
    a, b = F.col("b") + m3 * p2, F.col("n") - F.col("b") + m3 * (1 - p2)
    posed = hosts.join(domains, "domain").withColumns({"alpha": a, "beta": b})
    total = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / total
    lower = mean - z * F.sqrt(mean * (1 - mean) / (total + 1))
    return posed.select("host", "domain", "suffix", "n", F.col("b").alias("bad"), mean.alias("mean"), lower.alias("lower"),
                        (lower > margin * rate).alias("blocked"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, suffixes: tuple[str, ...] = (),
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, ``host, path, rule, verdict`` and the host's ``n_labelled, n_bad``.

    ``outcomes``: ``id_col`` and ``bad`` (boolean or null).
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = outcomes.select(F.col(id_col).alias("_id"), "bad").where("bad is not null")
    found = reputations(rows.select("_id", "host"), known, suffixes)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    joined = rows.join(found.select("host", "n", "bad", "blocked"), "host")
    return joined.select(
        F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"),
    )
