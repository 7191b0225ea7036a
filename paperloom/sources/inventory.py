"""Inventories: what a provider lists, from its feed, its registry and its shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.normalize import host_of
from paperloom.functions.text import fold_markup, matches_feed_query
from paperloom.operators.events import in_provider_window
from paperloom.operators.rank import newest_first
from paperloom.operators.resolve import merge_feed_and_registry
from paperloom.schema import text_of


def feed_inventory(feed: DataFrame, registry: DataFrame, start: str, end: str, query: str, most: int = 40) -> DataFrame:
    """The newest records of a feed and its registry that are in the window and match a query, each once.

    Rows have record_id, doi, landing_url, title, publication_date, authors, venue, summary.
    """
    both = merge_feed_and_registry(feed, registry)
    day = lambda v: F.lit(v).cast("date")
    text = fold_markup(F.concat_ws(" ", text_of(F.col("title")), text_of(F.col("summary"))))
    rows = both.where(in_provider_window(F.col("publication_date"), day(start), day(end))).withColumn("_t", text)
    return newest_first(rows.where(matches_feed_query(F.col("_t"), query)).drop("_t"), most)


def sharded(records: DataFrame, shards: DataFrame, most: int = 40) -> tuple[DataFrame, DataFrame]:
    """(newest records of all shards, each once; (source_id, complete)).

    ``shards`` has (source_id, shard, complete): a source is complete if all its shards are.
    """
    one = newest_first(records, most)
    return one, shards.groupBy("source_id").agg(F.bool_and("complete").alias("complete"))


def dispatch(configured: DataFrame) -> DataFrame:
    """(source_id, adapter): which adapter reads a source (S15): sharded listing, listing or feed, by its template and shards."""
    listing = F.col("template") == "publisher_listing_v1"
    return configured.select("source_id", F.when(listing & (F.col("n_shards") > 0), "sharded_listing").when(listing, "listing").otherwise("feed").alias("adapter"))


def input_faults(observations: DataFrame, queries: DataFrame) -> DataFrame:
    """(rule, key) of a work input that doesn't hold together (S19, J17): repeated or unknown ids, fewer raw than unique rows."""
    twice = observations.groupBy("observation_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("observation_unique").alias("rule"), F.col("observation_id").alias("key"))
    unknown = observations.select(F.explode("query_ids").alias("query_id")).distinct().join(queries.select("query_id"), "query_id", "left_anti").select(F.lit("query_known").alias("rule"), F.col("query_id").alias("key"))
    few = queries.where("raw_count < unique_count").select(F.lit("raw_at_least_unique").alias("rule"), F.col("query_id").alias("key"))
    return twice.unionByName(unknown).unionByName(few)


PRIVATE = r"^(0|10|127)\.|^169\.254\.|^172\.(1[6-9]|2\d|3[01])\.|^192\.168\.|^100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.|^(22[4-9]|2[3-5]\d)\."


def is_public_url(url: Column) -> Column:
    """Whether a url may be requested at all (F13): http(s), no user, standard port, and a host that isn't local by name or number."""
    authority = host_of(url)
    host = F.regexp_replace(authority, r":\d*$", "")
    port = F.regexp_extract(authority, r":(\d+)$", 1)
    named = host.rlike(r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$") & ~host.rlike(r"(^|\.)(localhost|local|internal|localdomain)$")
    number = host.rlike(r"^[0-9.]+$")
    address = host.rlike(r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$") & ~host.rlike(PRIVATE)
    fine = url.rlike("(?i)^https?://") & ~F.contains(authority, F.lit("@")) & port.isin("", "80", "443") & F.when(number, address).otherwise(named)
    return F.coalesce(fine, F.lit(False))


def metadata_summary(template: str, labels: dict[str, tuple[str, ...]], other: str) -> Column:
    """A summary from metadata alone (P31): ``template`` names {topic}, {kind}, {venue}, {date}; topics by the words of the title."""
    title = F.lower(text_of(F.col("title")))
    topic = F.lit(other)
    for name, words in reversed(list(labels.items())):
        topic = F.when(title.rlike("|".join(words)), name).otherwise(topic)
    out = F.lit(template)
    for key, value in {"topic": topic, "kind": F.replace(F.col("document_type"), F.lit("_"), F.lit(" ")), "venue": text_of(F.col("venue")), "date": text_of(F.col("publication_date"))}.items():
        out = F.replace(out, F.lit(f"{{{key}}}"), value)
    return out
