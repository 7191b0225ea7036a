"""Open access, full texts and what was reached of them: three axes that never stand for each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.normalize import _quoted, fulltext_urls
from paperloom.schema import FULLTEXT_KINDS, LOCATION, OA_EVIDENCE, PROBED, filled, rank_of, text_of


def stable_union(structs: Column) -> Column:
    """Distinct structs, ordered by their JSON."""
    keyed = F.array_sort(F.array_distinct(F.transform(structs, lambda s: F.struct(F.to_json(s).alias("k"), s.alias("s")))))
    return F.transform(keyed, lambda p: p["s"])


def oa_evidence() -> Column:
    """Repository ids as evidence; else the provider's flag, unless evidence was given with the row (P10)."""
    item = lambda source, kind, value, url: F.struct(source.alias("source"), F.lit(kind).alias("evidence_type"), value.alias("value"), url.alias("url"))
    repositories = F.array_compact(F.array(
        F.when(filled(F.col("pmcid")), item(F.lit("PubMed Central"), "repository_identifier", F.col("pmcid"), F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), _quoted(F.col("pmcid")), F.lit("/")))),
        F.when(filled(F.col("arxiv_id")), item(F.lit("arXiv"), "repository_identifier", F.col("arxiv_id"), F.concat(F.lit("https://arxiv.org/abs/"), _quoted(F.col("arxiv_id"))))),
    ))
    given = F.coalesce(F.col("oa_evidence"), F.array().cast(f"array<{OA_EVIDENCE}>"))
    told = F.exists(given, lambda e: filled(e["evidence_type"]))
    source = F.when(filled(F.col("source")), F.col("source")).otherwise("provider")
    flag = F.array(item(source, "provider_open_access_flag", F.col("open_access").cast("string"), F.lit(None).cast("string")))
    own = F.when((F.size(repositories) == 0) & ~told & F.col("open_access").isNotNull(), flag).otherwise(repositories)
    return stable_union(F.concat(given, own.cast(f"array<{OA_EVIDENCE}>")))


def oa_status() -> Column:
    """YES, NO or UNKNOWN, by repositories, then the flag, then what was given."""
    given = F.upper(text_of(F.col("oa_status")))
    yes = filled(F.col("pmcid")) | filled(F.col("arxiv_id")) | F.coalesce(F.col("open_access"), F.lit(False))
    return F.when(yes, "YES").when(F.col("open_access") == False, "NO").when(given.isin("YES", "NO"), given).otherwise("UNKNOWN")  # noqa: E712


def fulltext(candidates: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Adds oa_status, oa_evidence, access_status, fulltext_kind, download_urls, fulltext_locations, fulltext_access_status.

    ``probes`` has (work_id, url, status, http_status).  Only a probe of exactly
    one of the direct urls says anything about access.
    """
    rows = candidates.withColumn("download_urls", fulltext_urls())
    if probes is None:
        rows = rows.withColumns({"_url": F.lit(None).cast("string"), "_status": F.lit(None).cast("string"), "_http": F.lit(None).cast("int")})
    else:
        one = probes.groupBy("work_id").agg(F.max_by(F.struct("url", "status", F.col("http_status").cast("int").alias("http")), F.struct("url", "status")).alias("p"))
        rows = rows.join(one.select("work_id", F.col("p.url").alias("_url"), F.col("p.status").alias("_status"), F.col("p.http").alias("_http")), "work_id", "left")
    seen = (
        F.when(F.col("_status") == "SUCCESS", "ACCESSIBLE")
        .when(F.col("_http") == 402, "PAYWALLED")
        .when(F.col("_http").isin(401, 403, 429), "BLOCKED")
        .when(F.col("_status").isin("BLOCKED", "PAYWALLED", "FAILED"), F.col("_status"))
        .otherwise("NOT_CHECKED")
    )
    status = F.when(F.array_contains("download_urls", F.col("_url")), seen).otherwise("NOT_CHECKED")
    rows = rows.withColumn("access_status", F.coalesce(status, F.lit("NOT_CHECKED")))
    kind = F.when(filled(F.col("arxiv_id")), "PDF").when(filled(F.col("pmcid")), "REPOSITORY").otherwise("ABSTRACT_ONLY")

    def location(u: Column) -> Column:
        mine = F.when(u == F.col("_url"), F.col("access_status")).otherwise("NOT_CHECKED")
        of = F.when(F.contains(u, F.lit("arxiv.org/pdf/")) | u.rlike("/pdf/*$"), "PDF").when(F.contains(u, F.lit("pmc.ncbi.nlm.nih.gov/articles/")), "REPOSITORY").otherwise("HTML")
        why = F.when(mine == "NOT_CHECKED", "direct repository url was not probed").otherwise("direct repository probe result")
        return F.struct(u.alias("url"), of.alias("kind"), F.lit("REPOSITORY").alias("host_type"), mine.alias("access_status"), why.alias("reason"))

    return rows.withColumns({
        "oa_status": oa_status(), "oa_evidence": oa_evidence(), "fulltext_kind": kind, "fulltext_locations": F.transform("download_urls", location).cast(f"array<{LOCATION}>"),
        "fulltext_access_status": F.when(F.size("download_urls") > 0, F.col("access_status")).otherwise("UNKNOWN"),
    }).drop("_url", "_status", "_http")


def access_depth(probe_status: Column) -> Column:
    """The deepest content reached: a url that was not opened is no access."""
    opened = F.exists("fulltext_locations", lambda x: x["access_status"] == "ACCESSIBLE")
    return F.when(opened, "FULL_TEXT").when(F.trim(text_of(F.col("abstract"))) != "", "ABSTRACT").when(probe_status == "SUCCESS", "LANDING_PAGE").otherwise("METADATA")


def merge_status(prior: Column, new: Column) -> Column:
    """A new probe result, else an old one, else the new word: what was not checked erases nothing."""
    known = (*PROBED, "NOT_CHECKED")
    return F.when(new.isin(*PROBED), new).when(prior.isin(*PROBED), prior).when(new.isin(*known), new).when(prior.isin(*known), prior).otherwise("UNKNOWN")


def merge_fulltext(prior: DataFrame, incoming: DataFrame, key: str = "work_id") -> DataFrame:
    """Full-outer merge of full-text columns by work: urls united, probes kept, the better kind (A3)."""
    cols = ("oa_status", "access_status", "fulltext_kind", "download_urls", "fulltext_locations")
    p = prior.select(key, *[F.col(c).alias(f"p_{c}") for c in cols])
    n = incoming.select(key, *[F.col(c).alias(f"n_{c}") for c in cols])
    both = p.join(n, key, "full_outer")
    no_urls, none = F.array().cast("array<string>"), F.array().cast(f"array<{LOCATION}>")
    urls = F.array_sort(F.array_union(F.coalesce("p_download_urls", no_urls), F.coalesce("n_download_urls", no_urls)))
    old, new = F.coalesce("p_fulltext_locations", none), F.coalesce("n_fulltext_locations", none)
    names = F.array_sort(F.array_union(F.transform(old, lambda x: x["url"]), F.transform(new, lambda x: x["url"])))

    def merged(u: Column) -> Column:
        a, b = (F.get(F.filter(side, lambda x: x["url"] == u), F.lit(0)) for side in (old, new))
        keep = b.isNull() | (~b["access_status"].isin(*PROBED) & a["access_status"].isin(*PROBED))
        base = F.coalesce(b, a)
        return F.struct(*[F.when(keep, F.coalesce(a[f], base[f])).otherwise(base[f]).alias(f) if f in ("access_status", "reason") else base[f].alias(f) for f in ("url", "kind", "host_type", "access_status", "reason")])

    status = merge_status(F.upper(text_of(F.col("p_access_status"))), F.upper(text_of(F.col("n_access_status"))))
    said = F.array(F.upper(text_of(F.col("p_oa_status"))), F.upper(text_of(F.col("n_oa_status"))))
    kinds = [rank_of(F.col(f"{s}_fulltext_kind"), FULLTEXT_KINDS, 0) for s in "pn"]
    return both.select(
        key,
        F.when(F.array_contains(said, "YES"), "YES").when(F.array_contains(said, "NO"), "NO").otherwise("UNKNOWN").alias("oa_status"),
        status.alias("access_status"),
        F.element_at(F.array(*map(F.lit, FULLTEXT_KINDS)), F.greatest(*kinds) + 1).alias("fulltext_kind"),
        urls.alias("download_urls"),
        F.transform(names, merged).alias("fulltext_locations"),
        F.when(F.size(urls) > 0, status).otherwise("UNKNOWN").alias("fulltext_access_status"),
    )
