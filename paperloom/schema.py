"""Schemas of the engine's tables and the rank maps of its ordered enums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT = "struct<event_type:string,occurred_at:string,source:string,source_field:string,source_url:string,precision:string,confidence:string>"
OA_EVIDENCE = "struct<source:string,evidence_type:string,value:string,url:string>"
LOCATION = "struct<url:string,kind:string,host_type:string,access_status:string,reason:string>"

#: One provider observation of a work.  Texts that are missing are empty strings.
CANDIDATE = (
    "title string, stream string, category string, source string, publication_date string, authors array<string>, venue string, abstract string, "
    "doi string, pmid string, pmcid string, arxiv_id string, anthology_id string, openalex_id string, landing_url string, open_access boolean, "
    f"oa_status string, oa_evidence array<{OA_EVIDENCE}>, is_preprint boolean, provider_publication_types array<string>, events array<{EVENT}>, "
    "query_ids array<string>, observed_streams array<string>, observed_sources array<string>, score int"
)

#: A row of the older, weighted ranking.
PAPER = (
    "title string, abstract string, journal_or_venue string, stream string, secondary_streams array<string>, source string, publication_date string, "
    "doi string, pmid string, pmcid string, openalex_id string, publication_types array<string>, is_preprint boolean, open_access boolean, repository_versions array<string>"
)

# The enums, weakest first where they are ordered.
IDENTIFIERS = ("doi", "pmid", "pmcid", "arxiv_id", "anthology_id", "openalex_id")
QUALIFYING_EVENTS = (
    "version_of_record_first_online", "first_formal_indexing", "formal_proceedings_release", "oa_fulltext_first_available",
    "author_accepted_manuscript_first_available", "embargo_lifted", "preprint_to_peer_reviewed_upgrade", "formal_version_verified",
)
FORMAL_EVENTS = ("version_of_record_first_online", "first_formal_indexing", "formal_proceedings_release", "preprint_to_peer_reviewed_upgrade", "formal_version_verified")
ACCESS_DEPTHS = ("NONE", "METADATA", "LANDING_PAGE", "ABSTRACT", "FULL_TEXT")
FULLTEXT_KINDS = ("ABSTRACT_ONLY", "REPOSITORY", "HTML", "PDF")
CLAIM_STATUSES = ("SUPPORTED", "PARTIAL", "UNVERIFIED", "CONFLICT")
PROBED = ("ACCESSIBLE", "BLOCKED", "PAYWALLED", "FAILED")
TRIAGE = ("PRIORITY", "REVIEW_REQUIRED", "LOWER_PRIORITY")


def rank_of(value: Column, order: tuple[str, ...], other: int = -1) -> Column:
    """Place of the value in the order; ``other`` for what isn't in it."""
    out = F.lit(other)
    for i, name in enumerate(order):
        out = F.when(value == name, i).otherwise(out)
    return out


def strings(col: Column) -> Column:
    """The array, or an empty one for null."""
    return F.coalesce(col, F.array().cast("array<string>"))


def filled(col: Column) -> Column:
    """Whether a text is there: neither null nor empty."""
    return F.coalesce(col, F.lit("")) != ""


def text_of(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
