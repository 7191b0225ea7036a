"""Events of a work and the rolling window they must fall into.

Times keep the precision they came with.  A time stamp is in the closed interval
of the window; a date is in if its day is after the day the window starts on and
not after the day it ends on, so a 72 hour window never grows by the hours that
a bare date leaves open.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.ids import fingerprint
from paperloom.functions.normalize import iso_date
from paperloom.schema import EVENT, FORMAL_EVENTS, QUALIFYING_EVENTS, filled, text_of

TIMEZONE = "Asia/Tokyo"
CORRECTION_TITLE = r"(?i)\b(?:correction|corrigendum|erratum|retraction|expression of concern|error in byline|withdrawn|addendum)\b|更正|勘誤|撤回|撤稿"


def event(event_type, occurred_at, source, source_field, source_url, precision, confidence) -> Column:
    """An event; the precision ``instant`` is called ``timestamp``."""
    p = precision if isinstance(precision, Column) else F.lit(precision)
    cols = {"event_type": event_type, "occurred_at": occurred_at, "source": source, "source_field": source_field, "source_url": source_url, "precision": F.when(p == "instant", "timestamp").otherwise(p), "confidence": confidence}
    return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).cast("string").alias(k) for k, c in cols.items()])


def event_time(value: Column, timezone: str = TIMEZONE) -> Column:
    """An ISO time as a time stamp; without offset, in the run's time zone; a date as its midnight; else null."""
    t = text_of(value)
    offset = t.rlike(r"T.*(?:Z|[+-]\d{2}:?\d{2})$")
    local = F.coalesce(*[F.try_to_timestamp(F.replace(t, F.lit("T"), F.lit(" ")), F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")], iso_date(t).cast("timestamp"))
    here = F.to_utc_timestamp(local.cast("timestamp"), timezone)
    return F.when(offset, F.try_to_timestamp(t)).otherwise(here)


def in_window(e: Column, start: datetime, end: datetime, timezone: str = TIMEZONE) -> Column:
    """Whether an event qualifies: one of the eight types, at a time in the window (F1).  ``start`` and ``end`` are aware; the session runs in UTC."""
    import zoneinfo

    zone, utc = zoneinfo.ZoneInfo(timezone), zoneinfo.ZoneInfo("UTC")
    at = event_time(e["occurred_at"], timezone)
    day = F.to_date(F.from_utc_timestamp(at, timezone))
    first, last = (F.lit(t.astimezone(zone).date().isoformat()).cast("date") for t in (start, end))
    by_day = (day > first) & (day <= last)
    lo, hi = (F.lit(t.astimezone(utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp") for t in (start, end))
    fits = F.when(e["precision"] == "date", by_day).otherwise(at.between(lo, hi))
    return e["event_type"].isin(*QUALIFYING_EVENTS) & F.coalesce(fits, F.lit(False))


def in_provider_window(value: Column, start: Column, end: Column) -> Column:
    """A date in the closed interval; what is no date is not."""
    return F.coalesce(iso_date(value).between(start, end), F.lit(False))


def qualifying_event(start: datetime, end: datetime, timezone: str = TIMEZONE) -> Column:
    """The event that sorts last by time and type as texts, of those in the window; null for preprints."""
    found = F.filter("events", lambda e: in_window(e, start, end, timezone))
    keyed = F.transform(found, lambda e: F.struct(text_of(e["occurred_at"]).alias("a"), text_of(e["event_type"]).alias("t"), e.alias("e")))
    preprint = F.coalesce(F.col("is_preprint"), F.lit(False)) | (F.col("document_type") == "preprint")
    return F.when(~preprint, F.array_max(keyed)["e"])


def event_class(qualifying: Column, start: datetime, timezone: str = TIMEZONE) -> Column:
    """CORRECTION_NOTICE, OTHER, BACKFILL_INDEXING (indexed now, published before the window) or NEW_PUBLICATION."""
    import zoneinfo

    first = F.lit(start.astimezone(zoneinfo.ZoneInfo(timezone)).date().isoformat()).cast("date")
    kind = qualifying["event_type"]
    old = (kind == "first_formal_indexing") & F.coalesce(iso_date(F.col("publication_date")) < first, F.lit(False))
    new = kind.isin("version_of_record_first_online", "oa_fulltext_first_available", "formal_proceedings_release")
    return F.when(text_of(F.col("title")).rlike(CORRECTION_TITLE), "CORRECTION_NOTICE").when(qualifying.isNull(), "OTHER").when(old, "BACKFILL_INDEXING").when(new, "NEW_PUBLICATION").otherwise("OTHER")


def annotate(candidates: DataFrame, start: datetime, end: datetime, timezone: str = TIMEZONE) -> DataFrame:
    """Adds qualifying_event and event_class; a PRIORITY candidate without an event is LOWER_PRIORITY; reasons say so."""
    rows = candidates.withColumn("qualifying_event", qualifying_event(start, end, timezone))
    rows = rows.withColumn("event_class", event_class(F.col("qualifying_event"), start, timezone))
    none = F.col("qualifying_event").isNull()
    more = F.array_compact(F.array(F.when(none, F.lit("MISSING_QUALIFYING_EVENT")), F.when(F.col("event_class") == "BACKFILL_INDEXING", F.lit("BACKFILL_INDEXING")), F.when(F.col("event_class") == "CORRECTION_NOTICE", F.lit("CORRECTION_AUDIT"))))
    status = F.when(none & (F.col("triage_status") == "PRIORITY"), "LOWER_PRIORITY").otherwise(F.col("triage_status"))
    return rows.withColumns({"triage_status": status, "triage_reasons": F.array_sort(F.array_union("triage_reasons", more))})


def gate(candidates: DataFrame, start: datetime, end: datetime, timezone: str = TIMEZONE) -> DataFrame:
    """The candidates with at least one event in the window, and those events."""
    rows = candidates.withColumn("qualifying_events", F.filter("events", lambda e: in_window(e, start, end, timezone)))
    return rows.where(F.size("qualifying_events") > 0)


def verification_source() -> Column:
    """Where a candidate is verified: its proceedings or its publisher."""
    released = F.exists("events", lambda e: e["event_type"] == "formal_proceedings_release")
    return F.when((F.col("document_type") == "conference_paper") | released, "formal_proceedings_or_publisher").otherwise("publisher")


def merge_events(*lists: Column) -> Column:
    """All events, each fingerprint once, ordered by it."""
    none = F.array().cast(f"array<{EVENT}>")
    keyed = F.array_sort(F.transform(F.concat(*[F.coalesce(x, none) for x in lists]), lambda e: F.struct(fingerprint(e).alias("k"), e.alias("e"))))
    first = F.filter(keyed, lambda p, i: (i == 0) | (F.get(keyed, i - 1)["k"] != p["k"]))
    return F.transform(first, lambda p: p["e"])


def add_event(events: Column, new: Column) -> Column:
    """The list with an event of a known type and time, unless one like it is there."""
    known = F.exists(events, lambda e: fingerprint(e) == fingerprint(new))
    fine = new["event_type"].isin(*QUALIFYING_EVENTS) & filled(new["occurred_at"])
    return F.when(fine & ~known, F.array_append(events, new)).otherwise(events)


def with_provider_event(events: Column, publication_types: Column) -> Column:
    """The list with a formal event on the publication date, if it has no formal event and the paper is no preprint."""
    kind = F.when(F.contains(F.lower(F.array_join(publication_types, " ")), F.lit("proceedings")), "formal_proceedings_release").otherwise("formal_version_verified")
    made = event(kind, F.col("publication_date"), F.col("source"), "publication_date", "", "date", "provider_metadata")
    formal = F.exists(events, lambda e: e["event_type"].isin(*FORMAL_EVENTS))
    skip = F.coalesce(F.col("is_preprint"), F.lit(False)) | ~filled(F.col("publication_date")) | formal
    return F.when(skip, events).otherwise(add_event(events, made))


# Events by how much they say to a reader.
DISPLAY_ORDER = ("preprint_to_peer_reviewed_upgrade", "embargo_lifted", "oa_fulltext_first_available", "author_accepted_manuscript_first_available", "version_of_record_first_online", "formal_proceedings_release", "formal_version_verified", "first_formal_indexing")


def display_event(qualifying: Column, events: Column) -> Column:
    """The event to show: by the fixed order, then the earliest."""
    at = F.array(*map(F.lit, DISPLAY_ORDER))
    place = lambda e: F.when(F.array_contains(at, e["event_type"]), F.array_position(at, e["event_type"])).otherwise(99)
    pool = F.when(F.size(qualifying) > 0, qualifying).otherwise(events)
    return F.array_min(F.transform(pool, lambda e: F.struct(place(e).alias("p"), text_of(e["occurred_at"]).alias("a"), e.alias("e"))))["e"]


def search_bounds(end: datetime, hours: int):
    """(first day to search, last day, cutoff) of a window of so many hours."""
    cutoff = end - timedelta(hours=hours)
    return cutoff.date(), end.date(), cutoff
