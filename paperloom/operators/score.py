"""Scores and triage.  Two named policies: one routing score, and the older weighted total."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import contains_term, count_contained, count_terms, fold_markup, has_any
from paperloom.operators import classify as C
from paperloom.schema import filled, text_of

# Title words that decide triage, and the points of the older interest score.
REVIEW_TITLES = {"retracted": "RETRACTION_SIGNAL_REQUIRES_REVIEW", "withdrawn": "WITHDRAWAL_SIGNAL_REQUIRES_REVIEW"}
LOWER_TITLES = {"protocol": "PROTOCOL_TITLE_ROUTED_LOWER", "editorial": "EDITORIAL_TITLE_ROUTED_LOWER", "letter to the editor": "LETTER_TITLE_ROUTED_LOWER"}
INTEREST = {"longitudinal": 10, "field experiment": 15, "real-world": 8, "real world": 8, "randomized": 7, "randomised": 7, "mechanistic": 8, "paradox": 12, "dose-response": 7, "digital trace": 10, "conversation logs": 12, "chat logs": 12, "ecological momentary": 10}
CHAT_INTEREST = ("companion", "attachment", "intimacy", "loneliness", "self-disclosure", "dependency")
PRACTICAL = ("performance", "mortality", "injury", "recovery", "clinical", "health", "training", "nutrition")
WEIGHTS = {"evidence_quality": 0.4, "personal_relevance": 0.3, "novelty_interest": 0.2, "practical_impact": 0.1}


def capped(points: Column) -> Column:
    return F.least(F.lit(100), points).cast("int")


def routing_score(candidates: DataFrame, terms: Iterable[str], folded: Callable[[Column], Column] = fold_markup) -> DataFrame:
    """Adds score: 40, 6 a term in title or abstract, 3 more in the title, 8 with a DOI or PubMed id, 4 if open.

    ``folded``: what terms are looked for in, of a text; another function for texts that are no markup.
    """
    terms = list(terms)
    rows = candidates.withColumn("_t", folded(text_of(F.col("title")))).withColumn("_a", folded(F.concat_ws(" ", text_of(F.col("title")), text_of(F.col("abstract")))))
    points = 40 + 6 * count_terms(F.col("_a"), terms) + 3 * count_terms(F.col("_t"), terms)
    points = points + F.when(filled(F.col("doi")) | filled(F.col("pmid")), 8).otherwise(0) + F.when(F.coalesce(F.col("open_access"), F.lit(False)), 4).otherwise(0)
    return rows.withColumn("score", capped(points)).drop("_t", "_a")


def triage(candidates: DataFrame, minimum: Mapping[str, int]) -> DataFrame:
    """Adds triage_status and sorted triage_reasons from the title and the category's least score (R2)."""
    title = F.lower(text_of(F.col("title")))
    hits = lambda table: F.array_compact(F.array(*[F.when(F.contains(title, F.lit(t)), F.lit(code)) for t, code in table.items()]))
    least = F.lit(0)
    for name, points in minimum.items():
        least = F.when(F.col("category") == name, points).otherwise(least)
    review = hits(REVIEW_TITLES)
    lower = F.array_sort(F.concat(hits(LOWER_TITLES), F.array_compact(F.array(F.when(F.col("score") < least, F.lit("BELOW_CATEGORY_ROUTING_THRESHOLD"))))))
    status = F.when(F.size(review) > 0, "REVIEW_REQUIRED").when(F.size(lower) > 0, "LOWER_PRIORITY").otherwise("PRIORITY")
    reasons = F.when(F.size(review) > 0, review).when(F.size(lower) > 0, lower).otherwise(F.array(F.lit("MEETS_CATEGORY_ROUTING_THRESHOLD")))
    return candidates.withColumns({"triage_status": status, "triage_reasons": reasons})


def eligible(candidates: DataFrame) -> DataFrame:
    """Those that stay in the run's priority set (F8)."""
    return candidates.where(F.col("triage_status").isin("PRIORITY", "REVIEW_REQUIRED"))


# --- the older scores


def _relevance(base: int, each: int, in_title: int, terms: list[str]) -> Column:
    return base + each * count_contained(C.paper_text(), terms) + in_title * count_contained(C.paper_title(), terms)


def base_relevance(terms: list[str]) -> Column:
    """48 with any term and 42 without, 7 a term, 4 more in the title."""
    return capped(F.when(count_contained(C.paper_text(), terms) > 0, _relevance(48, 7, 4, terms)).otherwise(42))


def relevance(terms: list[str], policy: str = "taxonomy") -> Column:
    """0 outside the stream; else by the stream's kind: quality (R5), clinical (R6) or a research direction."""
    clinical = _relevance(68, 4, 4, terms) + F.when(has_any(F.lower(text_of(F.col("journal_or_venue"))), C.CLINICAL_JOURNALS), 8).otherwise(0)
    points = F.when(F.col("stream") == "clinical_medicine", clinical)
    if policy == "taxonomy":
        points = points.when(F.col("stream").isin(*C.STREAM_DIRECTION), _relevance(66, 4, 5, terms))
    return F.when(C.is_relevant(policy), capped(points.otherwise(_relevance(62, 6, 5, terms)))).otherwise(0).cast("int")


def interest() -> Column:
    """43, points of signals, 5 a relational signal in the chat stream, sample size and evidence."""
    text, n = C.paper_text(), C.sample_size()
    points = F.lit(43)
    for signal, value in INTEREST.items():
        points = points + F.when(F.contains(text, F.lit(signal)), value).otherwise(0)
    points = points + F.when(F.col("stream") == "llm_social", 5 * count_contained(text, CHAT_INTEREST)).otherwise(0)
    points = points + F.when(n >= 10000, 15).when(n >= 1000, 10).when(n >= 200, 5).otherwise(0)
    return capped(points + F.when(F.col("evidence_score") >= 85, 5).otherwise(0))


def ai_interest() -> Column:
    """3 more for each direction beyond the first, 12 at most, in the streams of directions."""
    more = F.least(F.lit(12), 3 * F.greatest(F.lit(0), F.size(C.directions()) - 1))
    return capped(interest() + F.when(F.col("stream").isin(*C.STREAM_DIRECTION), more).otherwise(0))


def practical() -> Column:
    """40, 25 for syntheses and guidelines or 18 for strong designs, 4 a signal."""
    d = F.col("study_design")
    bonus = F.when(d.isin("Guideline", "Consensus statement", "Meta-analysis", "Systematic review"), 25).when(d.isin("Randomized controlled trial", "Field experiment", "Longitudinal study"), 18).otherwise(0)
    return capped(40 + bonus + 4 * count_contained(C.paper_text(), PRACTICAL))


def total(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """The weighted sum of the four scores, to one decimal."""
    w = dict(WEIGHTS) | dict(weights)
    parts = (("evidence_score", "evidence_quality"), ("relevance_score", "personal_relevance"), ("interest_score", "novelty_interest"), ("practical_score", "practical_impact"))
    return F.round(sum((F.col(c) * F.lit(float(w[k])) for c, k in parts), F.lit(0.0)), 1)


def paper_scores(papers: DataFrame, terms: list[str], weights: Mapping[str, float] = WEIGHTS, policy: str = "taxonomy") -> DataFrame:
    """Papers with study_design, evidence_tier, the four scores and total_score; ``policy`` base, quality or taxonomy."""
    rows = papers.withColumn("_s", C.base_study() if policy == "base" else C.study())
    rows = rows.select("*", "_s.*").drop("_s")
    rows = rows.withColumn("relevance_score", base_relevance(terms) if policy == "base" else relevance(terms, policy))
    rows = rows.withColumn("interest_score", ai_interest() if policy == "taxonomy" else interest()).withColumn("practical_score", practical())
    return rows.withColumn("total_score", total(weights))


__all__ = ["ai_interest", "base_relevance", "contains_term", "eligible", "interest", "paper_scores", "practical", "relevance", "routing_score", "total", "triage"]
