"""URL filters: host rules, and an empirical-Bayes reputation where no rule fits.

Labelled page outcomes are shrunk down a chain of beta-binomial priors: the
whole table gives the prior of each public suffix, a suffix that of its
registered domains, a domain that of its hosts.  How strongly a level pulls is
estimated from the data: the intra-class correlation rho of the level (by
moments) makes a prior worth 1/rho - 1 pages.  A host is blocked when the lower
bound of its posterior rate of bad pages reaches the limit, so a host with few
labels is judged as its domain is, and one without labels is never blocked by
chance.  DataFrame functions only; the urls are read twice, their html never.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, spool

#: Public suffixes of two labels.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr", "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "com.ar")

#: (host and path, verdict): the production rules.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

Z, LIMIT, RHO_LEAST, RHO_MOST = 1.645, 0.5, 0.001, 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest rule that fits (value 0) or its verdict (value 1); null if none fits.  Equally long rules go by text."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, slash, tail = rule[0].partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + tail)
        out = F.when(fits, F.lit(rule[value])).otherwise(out)
    return out


def with_domain(hosts: DataFrame) -> DataFrame:
    """Adds ``domain`` and ``suffix`` to rows with ``host``; user and port are set aside, an address is its own domain and suffix."""
    bare = F.regexp_replace(F.regexp_extract("host", r"(?s)([^@]*)$", 1), r":\d*$", "")
    parts = F.split(bare, r"\.")
    n = F.size(parts)
    last = lambda k: F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    taken = F.when(last(2).isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    whole = bare.rlike(r"^[0-9.]+$|^\[") | (n == 1)
    return hosts.withColumns({
        "suffix": F.when(whole, bare).when(taken == 2, last(2)).otherwise(last(1)),
        "domain": F.when(whole, bare).when(taken == 2, last(3)).otherwise(last(2)),
    })


def _strength(groups: DataFrame, m: Column) -> float:
    """Pages that a prior with means ``m`` is worth, from groups of n pages with b bad ones: one row comes to the driver."""
    noise = F.col("n") * m * (1 - m)
    row = groups.agg(F.sum(F.pow(F.col("b") - F.col("n") * m, F.lit(2.0)) - noise).alias("over"), F.sum((F.col("n") - 1) * noise).alias("base")).first()
    rho = row["over"] / row["base"] if row["base"] else RHO_LEAST
    return 1 / min(max(rho, RHO_LEAST), RHO_MOST) - 1


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): labelled pages n, bad ones b, posterior mean and its lower bound.

    ``outcomes`` has (page_id, bad); rows with null bad are no outcome, several
    rows for a page are several trials.  Without any outcome the rate is 1/2
    with a bound near 0, so nothing is blocked.
    """
    seen = pages.select("page_id", "host").join(outcomes.where("bad is not null").select("page_id", F.col("bad").cast("long").alias("bad")), "page_id", "left")
    hosts = spool(with_domain(seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    n, b = total["n"] or 0, total["b"] or 0
    top = (b + 0.5) / (n + 1.0)

    def posterior(groups: DataFrame, m: Column, name: str) -> tuple[DataFrame, float]:
        s = _strength(groups, m)
        return groups.withColumn(name, (F.col("b") + s * m) / (F.col("n") + s)), s

    sums = [F.sum("n").alias("n"), F.sum("b").alias("b")]
    suffixes, _ = posterior(hosts.groupBy("suffix").agg(*sums), F.lit(top), "m_suffix")
    domains, _ = posterior(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", "m_suffix"), "suffix"), F.col("m_suffix"), "m_domain")
    leaves, s = posterior(hosts.join(domains.select("suffix", "domain", "m_domain"), ["suffix", "domain"]), F.col("m_domain"), "mean")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + s + 1))
    return leaves.select("host", "n", "b", "mean", F.greatest(F.lit(0.0), F.col("mean") - z * spread).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, limit: float = LIMIT, z: float = Z, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """Every row of ``pages`` with host, path, rule, verdict, n_labelled and bad_bound.

    A rule's verdict goes before the method's.  Null urls and urls without
    ``://`` have an empty host and path and are judged as that host; repeated
    pages are judged one by one; an empty table gives an empty result.  Other
    columns of ``pages`` don't matter, whatever their names.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = host_reputation(rows, outcomes, z)
    host, path = F.col("host"), F.col("path")
    judged = rows.join(known, "host", "left")
    own = F.when(F.col("bound") >= limit, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", fitting_rule(host, path, rules, 0).alias("rule"), F.coalesce(fitting_rule(host, path, rules, 1), own).alias("verdict"), F.col("n").alias("n_labelled"), F.round("bound", 6).alias("bad_bound"))


def outcomes_of(labels: DataFrame, page_id: str = "doc_id") -> DataFrame:
    """Labels as page outcomes: ``page_id`` names the column that says which page a label is of; low quality or toxic is bad."""
    return labels.select(F.col(page_id).alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0).alias("bad"))
