"""A discovery run: observations to ranked works, ledgers and state, as lazily composed tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.normalize import publisher_url
from paperloom.operators import access, coverage, rank, resolve, score, state
from paperloom.operators import events as E
from paperloom.sources import payloads
from paperloom.storage import spool


@dataclass
class Config:
    start: datetime
    end: datetime
    timezone: str = E.TIMEZONE
    terms: list[str] = field(default_factory=list)
    minimum: dict[str, int] = field(default_factory=dict)
    categories: list[str] = field(default_factory=list)
    policy: rank.Policy = field(default_factory=rank.Policy)
    adapters: dict[str, str] = field(default_factory=dict)  # source to adapter, where the source isn't named like it
    listings: dict[str, dict] = field(default_factory=dict)  # source to the arguments of payloads.listing
    fully_open: frozenset[str] = frozenset()  # sources whose every record is open access


def _days(c: Config) -> tuple[str, str]:
    return c.start.date().isoformat(), c.end.date().isoformat()


def _records(records: DataFrame, p: DataFrame, key: str, source: str, c: Config) -> DataFrame:
    """Records with the stream and category of the payload that their key names, as candidates."""
    of = p.select(F.col("query_id").alias("_query"), "stream", "category").distinct()
    rows = records.withColumnRenamed(key, "query_id").join(of, F.col("query_id") == F.col("_query")).drop("_query")
    return payloads.record_candidates(rows, source, source in c.fully_open)


def _feed(p: DataFrame, source: str, c: Config) -> DataFrame:
    return _records(payloads.feed_records(p.withColumnRenamed("query_id", "feed_id")), p, "feed_id", source, c)


def _registry(p: DataFrame, source: str, c: Config) -> DataFrame:
    return _records(payloads.crossref_pages(p.withColumnRenamed("query_id", "inventory_id").withColumn("page", F.lit(0))), p, "inventory_id", source, c)


def _listing(p: DataFrame, source: str, c: Config) -> DataFrame:
    if source not in c.listings:
        raise ValueError(f"no listing rules for the source {source}")
    pages = p.select(F.col("query_id").alias("page_id"), F.col("body").alias("html"))
    found = payloads.listing(pages, **c.listings[source]).where("usable").withColumns({"summary": F.lit(""), "authors": F.array().cast("array<string>"), "venue": F.lit("")})
    return payloads.listing_access(_records(found, p, "page_id", source, c), source in c.fully_open)


def _proceedings_feed(p: DataFrame, source: str, c: Config) -> DataFrame:
    return _of_query(payloads.proceedings_atom(p.withColumnRenamed("query_id", "feed_id"), source, keep=("feed_id",)), p, "feed_id")


def _proceedings_page(p: DataFrame, source: str, c: Config) -> DataFrame:
    pages = p.select(F.col("query_id").alias("page_id"), F.col("body").alias("html"))
    found = payloads.proceedings_html(pages).withColumns({"publication_date": F.lit(""), "summary": F.lit(""), "venue": F.lit("")})
    return _records(found, p, "page_id", source, c)


def _of_query(rows: DataFrame, p: DataFrame, key: str) -> DataFrame:
    of = p.select(F.col("query_id"), "stream", "category").distinct()
    return rows.drop("stream", "category").join(of, F.col(key) == of["query_id"]).drop(key)


#: Adapter keys and the parsers behind them (S15, S28): each takes payloads, the source's name and the run's configuration.
ADAPTERS: dict[str, Callable[[DataFrame, str, Config], DataFrame]] = {
    "pubmed": lambda p, s, c: payloads.pubmed(p),
    "europe_pmc": lambda p, s, c: payloads.europe_pmc(p),
    "openalex": lambda p, s, c: payloads.openalex(p),
    "openreview": lambda p, s, c: payloads.openreview(p, *_days(c)),
    "arxiv": lambda p, s, c: payloads.arxiv(p, *_days(c)),
    "acl_anthology": _proceedings_feed,
    "pmlr": _proceedings_page,
    "rss_atom": _feed,
    "crossref": _registry,
    "publisher_listing": _listing,
}


def discover(store: DataFrame, queries: DataFrame, config: Config) -> DataFrame:
    """All sources' observations (S26, S28): ``store`` has (source, query_id, body), ``queries`` (query_id, stream, category).

    The store is read once, into a table ordered by source, of which each adapter reads its own row groups; its queries are
    rows, not loops.  Sources are the adapters of their own name and those that ``config.adapters`` names.  Payloads that
    couldn't be read (a null body) have no observations.
    """
    unknown = set(config.adapters.values()) - set(ADAPTERS)
    if unknown:
        raise ValueError(f"no such adapter: {', '.join(sorted(unknown))}")
    asked = spool(store.where("body IS NOT NULL").join(queries, "query_id").sortWithinPartitions("source"), "payloads")
    out = None
    for name, adapter in ({k: k for k in ADAPTERS if k != "publisher_listing"} | config.adapters).items():
        rows = ADAPTERS[adapter](asked.where(F.col("source") == name), name, config)
        rows = rows.withColumn("query_ids", F.array("query_id")).drop("query_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@dataclass
class Run:
    ledger: DataFrame
    featured: DataFrame
    counts: DataFrame
    works: DataFrame


def execute(observations: DataFrame, config: Config, prior: DataFrame, notified: DataFrame, probes: DataFrame) -> Run:
    """Scores, resolves, triages and gates observations, ranks the works and brings the state up to date.

    ``prior`` is the table of works that ``state.upsert`` returns, ``notified`` has (event_id), ``probes`` (work_id, url, status, http_status).
    """
    scored = score.routing_score(observations, config.terms)
    works = spool(resolve.fold(resolve.label(scored)).drop("component"), "works")
    works = score.triage(works, config.minimum)
    works = E.annotate(works, config.start, config.end, config.timezone)
    works = access.fulltext(works.withColumn("publisher_url", publisher_url()), probes)
    ledger = state.ledger(works, probes, notified)
    ledger = ledger.withColumn("access_depth", access.access_depth(F.col("probe.status"))).withColumn("routing_score", F.col("score"))
    ledger = spool(rank.display_order(ledger, config.categories), "ledger")
    seen = ledger.select("work_id", "title", "category", F.lit(config.end.isoformat()).alias("first_seen_at"), F.lit(config.end.isoformat()).alias("last_seen_at"), F.lit(1).cast("long").alias("seen_count"), F.col("observed_streams").alias("streams"), "access_depth", "oa_status")
    return Run(ledger, rank.featured(ledger, config.policy), coverage.run_counts(ledger), state.upsert(prior, seen))
