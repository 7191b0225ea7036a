"""Stable ids: hashes of canonical texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_list(*parts: Column) -> Column:
    """The parts as a JSON list of strings, nulls as empty strings."""
    return F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def stable_id(prefix: str, *parts: Column) -> Column:
    """The prefix and 24 hex digits of the hash of the parts."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(canonical_list(*parts), 256), 1, 24))


def event_id(work: Column, event: Column) -> Column:
    """Identity of an event of a work, whoever reports it again."""
    return F.concat(F.lit("event:"), F.sha2(F.concat_ws("|", work, event["event_type"], event["occurred_at"], event["source"], event["source_field"]), 256))


def fingerprint(event: Column, kind: str = "event_type") -> Column:
    """What makes two events the same: type, time, source and field, whatever their case."""
    return F.lower(F.concat_ws("|", *[F.coalesce(event[f], F.lit("")) for f in (kind, "occurred_at", "source", "source_field")]))


def strict_json(text: Column) -> Column:
    """The document as a variant; null if it isn't strict JSON (repeated keys, NaN)."""
    return F.try_parse_json(text)


def canonical_json(text: Column) -> Column:
    """The document with sorted keys."""
    return F.to_json(F.try_parse_json(text))
