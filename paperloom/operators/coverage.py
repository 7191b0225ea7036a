"""What a run looked at: roll-ups per source, receipts of requests, and the registry of sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.dialects import translate
from paperloom.functions.ids import canonical_list, stable_id
from paperloom.functions.normalize import canonical_url, source_role, source_type
from paperloom.schema import strings, text_of
from paperloom.operators.state import require_empty


def source_coverage(access: DataFrame, requested: DataFrame, run_end: str) -> DataFrame:
    """One check per requested source (A10): FAILED before SUCCESS before NO_RESULTS before NOT_ATTEMPTED.

    ``access`` has (provider, status, result_count, window_record_count, accessed_at, url, error), ``requested`` (source_id).
    A check says that a source was looked at, not that it answered.
    """
    has = lambda *s: F.bool_or(F.col("status").isin(*s))
    status = F.when(has("FAILED", "PARTIAL"), "FAILED").when(has("SUCCESS"), "SUCCESS").when(F.bool_and(F.col("status") == "NO_RESULTS"), "NO_RESULTS").otherwise("NOT_ATTEMPTED")
    urls = F.collect_set(F.when(F.col("url").rlike("^https?://"), F.col("url")))
    found = access.groupBy(F.col("provider").alias("source_id")).agg(
        status.alias("status"),
        F.count(F.lit(1)).alias("n_checks"),
        F.sum(F.coalesce("result_count", F.lit(0))).cast("long").alias("result_count"),
        F.max("window_record_count").alias("window_record_count"),
        F.max("accessed_at").alias("checked_at"),
        F.when(F.size(urls) == 1, F.get(urls, F.lit(0))).alias("url"),
        F.array_sort(F.collect_set(F.nullif("error", F.lit("")))).alias("notes"),
    )
    rows = requested.select("source_id").distinct().join(found, "source_id", "left")
    return rows.select("source_id", F.coalesce("status", F.lit("NOT_ATTEMPTED")).alias("status"), F.coalesce("n_checks", F.lit(0)).alias("n_checks"), F.coalesce("result_count", F.lit(0)).alias("result_count"), "window_record_count", F.coalesce("checked_at", F.lit(run_end)).alias("checked_at"), "url", strings(F.col("notes")).alias("notes"))


def run_counts(ledger: DataFrame) -> DataFrame:
    """The run's counts in one pass."""
    n = lambda c: F.count(F.when(c, 1))
    is_ = lambda c, v: F.col(c) == v
    return ledger.agg(
        F.count(F.lit(1)).alias("deduplicated_candidates"),
        F.coalesce(F.sum("n_observations"), F.lit(0)).alias("raw_candidates"),
        *[n(is_("triage_status", v)).alias(f"triage_{v.lower()}") for v in ("PRIORITY", "REVIEW_REQUIRED", "LOWER_PRIORITY")],
        *[n(is_("event_class", v)).alias(f"class_{v.lower()}") for v in ("NEW_PUBLICATION", "BACKFILL_INDEXING", "CORRECTION_NOTICE", "OTHER")],
        *[n(is_("event_status", v)).alias(f"event_{v.lower()}") for v in ("QUALIFYING", "ALREADY_NOTIFIED", "NO_QUALIFYING_EVENT")],
        *[n(is_("oa_status", v)).alias(f"oa_{v.lower()}") for v in ("YES", "NO", "UNKNOWN")],
    )


def count_mismatches(ledger: DataFrame, stated: DataFrame) -> DataFrame:
    """(name, stated, found) of the counts a run states that its ledger does not bear out."""
    melt = lambda df, v: df.unpivot([], df.columns, "name", v)
    long_ = lambda df: df.select(*[F.col(c).cast("long").alias(c) for c in df.columns])
    return melt(long_(stated), "stated").join(melt(long_(run_counts(ledger)), "found"), "name").where("not (stated <=> found)")


def status_counts(rows: DataFrame, column: str = "status") -> DataFrame:
    """Rows per status."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def run_status(checks: DataFrame, history_complete: bool, verified: bool, selected: int) -> Column:
    """The run's status by precedence: history, verification, discovery, emptiness."""
    if not history_complete:
        return F.lit("HISTORY_INCOMPLETE")
    if not verified:
        return F.lit("SOURCE_ACCESS_GAP")
    gap = checks.where(F.col("status").isin("FAILED", "NOT_ATTEMPTED")).limit(1).count() > 0
    return F.lit("PARTIAL_SOURCE_COVERAGE" if gap else "NO_QUALIFYING_ITEMS" if not selected else "COMPLETE")


def shard_rollup(records: DataFrame, by: str = "source_id") -> DataFrame:
    """Containers and completeness of a sharded listing (A17): distinct containers, all shards complete."""
    return records.groupBy(by).agg(F.count_distinct("container").alias("containers"), F.bool_and("complete").alias("all_shards_complete"), F.sum("n_records").alias("n_records"))


def http_telemetry(requests: DataFrame) -> DataFrame:
    """Requests and responses per source, redirects included."""
    return requests.groupBy("source_id").agg(F.sum(F.col("redirects") + 1).alias("http_requests_attempted"), F.sum(F.when(F.col("responded"), F.col("redirects") + 1).otherwise(F.col("redirects"))).alias("http_responses_received"))


def _pages(status: Column, requested: Column, received: Column) -> tuple[Column, Column]:
    fine = (requested >= 0) & (received >= 0) & (received <= requested)
    return F.when(fine, requested).when(status == "NOT_ATTEMPTED", 0).otherwise(1), F.when(fine, received).when(status.isin("SUCCESS", "NO_RESULTS", "PARTIAL"), 1).otherwise(0)


def receipts(queries: DataFrame, access: DataFrame, candidates: DataFrame, run_id: str, start: datetime, end: datetime, limit: int) -> DataFrame:
    """One receipt per query and source, per other access row, and per neither.

    ``queries`` has (query_id, query, source_ids, status, result_count, searched_at), ``access`` (source_id, provider, status,
    result_count, url, accessed_at, work_id, http_requests_attempted, http_responses_received), ``candidates`` (work_id, query_ids,
    discovery_sources).  An access row belongs to the query whose id it carries; the rest of a provider's rows pair with its
    queries without one, in the order of their ids.
    """
    asked = queries.select("*", F.explode(F.array_sort("source_ids")).alias("source")).withColumn("access_id", F.concat_ws("-", "query_id", "source"))
    a = access.select(F.col("source_id").alias("a_id"), F.col("provider").alias("a_provider"), F.col("status").alias("a_status"), F.col("url").alias("a_url"), F.col("accessed_at").alias("a_at"), F.col("work_id").alias("a_work"), F.col("result_count").alias("a_results"), F.col("http_requests_attempted").alias("a_req"), F.col("http_responses_received").alias("a_res"))
    exact = asked.join(a, asked["access_id"] == a["a_id"], "left")
    lone = exact.where("a_id is null").drop(*a.columns)
    free = a.join(asked.select(F.col("access_id").alias("a_id")), "a_id", "left_anti")
    lone = lone.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy("query_id")))
    free = free.withColumn("_m", F.row_number().over(Window.partitionBy("a_provider").orderBy("a_id")))
    paired = lone.join(free, (lone["source"] == free["a_provider"]) & (F.col("_n") == F.col("_m")), "left").drop("_n", "_m")
    rows = exact.where("a_id is not null").unionByName(paired)
    works = candidates.select("work_id", F.explode("query_ids").alias("query_id"), "discovery_sources").select("work_id", "query_id", F.explode("discovery_sources").alias("source"))
    works = works.groupBy("query_id", "source").agg(F.array_sort(F.collect_set("work_id")).alias("works"))
    rows = rows.join(works, ["query_id", "source"], "left")
    sent = _translations(rows, start, end)
    status = F.coalesce(F.nullif("status", F.lit("")), "a_status", F.lit("NOT_ATTEMPTED"))
    pages = _pages(status, F.col("a_req"), F.col("a_res"))
    own = rows.join(sent, ["query", "source"]).select(
        stable_id("attempt", F.lit(run_id), F.lit("DISCOVERY"), F.col("query_id"), F.col("source")).alias("attempt_id"),
        F.lit("DISCOVERY").alias("stage"), F.col("source").alias("source_id"), F.coalesce("a_id", "access_id").alias("source_access_id"), "query_id",
        F.coalesce("searched_at", "a_at").alias("attempted_at"), status.alias("status"), F.col("query").alias("requested_query"), F.col("sent").alias("actual_query"),
        F.sha2(canonical_list(text_of(F.col("a_url")), F.col("source"), F.col("sent"), F.lit(start.isoformat()), F.lit(end.isoformat()), F.lit(limit)), 256).alias("request_fingerprint"),
        F.coalesce("result_count", F.lit(0)).cast("long").alias("result_count"),
        F.sha2(F.to_json(strings(F.col("works"))), 256).alias("result_ids_sha256"),
        pages[0].cast("int").alias("pages_requested"), pages[1].cast("int").alias("pages_received"),
        (F.coalesce("result_count", F.lit(0)) >= limit).alias("limit_reached"),
        F.when(status == "PARTIAL", "INCOMPLETE_PROVIDER_INVENTORY").when(status == "FAILED", "PROVIDER_REQUEST_FAILED").when(status == "NOT_ATTEMPTED", "REQUEST_NOT_ATTEMPTED").alias("error_class"),
    )
    left = a.join(rows.where("a_id is not null").select("a_id"), "a_id", "left_anti")
    stage = F.when(F.col("a_provider").isin("publisher", "formal", "formal_proceedings_or_publisher"), "CONTENT_FETCH").otherwise("DISCOVERY")
    pages = _pages(F.col("a_status"), F.col("a_req"), F.col("a_res"))
    other = left.select(
        stable_id("attempt", F.lit(run_id), stage, F.col("a_id")).alias("attempt_id"),
        stage.alias("stage"), F.col("a_provider").alias("source_id"), F.col("a_id").alias("source_access_id"), F.lit(None).cast("string").alias("query_id"),
        F.col("a_at").alias("attempted_at"), F.col("a_status").alias("status"), F.lit(None).cast("string").alias("requested_query"), F.lit(None).cast("string").alias("actual_query"),
        F.sha2(canonical_list(text_of(F.col("a_url")), F.col("a_provider"), text_of(F.col("a_work"))), 256).alias("request_fingerprint"),
        F.coalesce("a_results", F.lit(0)).cast("long").alias("result_count"),
        F.sha2(F.to_json(F.array_compact(F.array(F.nullif("a_work", F.lit(""))))), 256).alias("result_ids_sha256"),
        pages[0].cast("int").alias("pages_requested"), pages[1].cast("int").alias("pages_received"), F.lit(False).alias("limit_reached"),
        F.when(F.col("a_status") == "FAILED", "ACCESS_BLOCKED_OR_FAILED").when(F.col("a_status") == "NOT_ATTEMPTED", "REQUEST_NOT_ATTEMPTED").alias("error_class"),
    )
    return own.unionByName(other)


def _translations(rows: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """(query, source, sent): queries in the sources' languages, each compiled once, in the executors."""
    first, last = start.date(), end.date()

    def compiled(batches):
        import pyarrow as pa

        for b in batches:
            sent = [translate(source, query or "", first, last) for query, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent, pa.string())], ["query", "source", "sent"])

    return rows.select("query", "source").distinct().mapInArrow(compiled, "query string, source string, sent string")


def expansions(receipt_rows: DataFrame) -> DataFrame:
    """Queries that were sent in other words than asked (part of J7)."""
    odd = receipt_rows.where("actual_query <> requested_query")
    return odd.select(stable_id("expansion", F.col("query_id"), F.col("source_id"), F.col("actual_query")).alias("expansion_id"), "query_id", "source_id", F.col("requested_query").alias("original_query"), F.col("actual_query").alias("expanded_query"))


def source_registry(works: DataFrame, access: DataFrame) -> DataFrame:
    """Every url of a work once, with its kind, role and last access (J8).  Raises if a url belongs to two works.

    ``works`` has (work_id, urls), ``access`` (url, status, accessed_at).
    """
    each = works.select("work_id", F.explode("urls").alias("u")).withColumn("url", canonical_url(F.col("u"))).where("url <> ''").select("work_id", "url").distinct()
    require_empty(each.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("url"), "urls of several works")
    seen = access.withColumn("url", canonical_url(F.col("url"))).where("url <> ''").groupBy("url").agg(F.max_by("status", F.struct("accessed_at", "status")).alias("last_status"), F.max("accessed_at").alias("last_accessed_at"))
    kind = source_type(F.col("url"))
    return each.join(seen, "url", "left").select(stable_id("src", F.col("url")).alias("source_id"), "work_id", "url", kind.alias("source_type"), source_role(F.col("url"), kind).alias("source_role"), "last_status", "last_accessed_at")


def evidence_sources(registry: DataFrame, observations: DataFrame, works: DataFrame) -> DataFrame:
    """Registry rows with their latest observation and their work.

    ``observations`` has (source_id, observed_at, outcome, access_depth), ``works`` (work_id, title, oa_status).
    """
    last = observations.groupBy("source_id").agg(F.max_by(F.struct("observed_at", "outcome", "access_depth"), F.struct("observed_at", "outcome")).alias("o"))
    return registry.join(last, "source_id", "left").join(works.select("work_id", "title", "oa_status"), "work_id", "left").select("source_id", "work_id", "url", "source_type", "source_role", "title", "oa_status", "o.observed_at", F.coalesce("o.outcome", F.lit("NOT_CHECKED")).alias("outcome"), F.coalesce("o.access_depth", F.lit("NONE")).alias("access_depth"))


def parity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of the ids that only one side has."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    return l.join(r, key, "left_anti").withColumn("side", F.lit("left")).unionByName(r.join(l, key, "left_anti").withColumn("side", F.lit("right")))


def field_parity(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, left, right) where two tables that should say the same don't."""
    l, r = left.alias("l"), right.alias("r")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l.{f}").cast("string").alias("left"), F.col(f"r.{f}").cast("string").alias("right")) for f in fields])
    rows = l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}")).select(F.col(f"l.{key}").alias(key), F.explode(each).alias("x"))
    return rows.select(key, "x.*").where("not (left <=> right)")


def expand_groups(streams: DataFrame, groups: DataFrame) -> DataFrame:
    """Streams with the sources of their groups, in order, each once (J15, J16).  ``streams`` (stream, groups), ``groups`` (group, sources)."""
    each = streams.select("stream", F.posexplode("groups").alias("i", "group"))
    rows = each.join(groups, "group").select("stream", "i", "sources")
    lists = rows.groupBy("stream").agg(F.array_sort(F.collect_list(F.struct("i", "sources"))).alias("x"))
    return lists.select("stream", F.array_distinct(F.flatten(F.transform("x", lambda r: r["sources"]))).alias("sources"))


def category_lookup(categories: DataFrame) -> DataFrame:
    """(stream, category) from categories and their streams."""
    return categories.select(F.explode("streams").alias("stream"), "category")
