"""The evidence contract's rules that go beyond a table at a time: claims against bindings and estimates, follow-ups against
gaps and receipts, requests against the inventories they fetched.  All give (rule, key, detail); see ``rules``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.ids import stable_id
from paperloom.operators.gaps import CONTENT_PROVIDERS
from paperloom.operators.rules import dealt, foreign, holds, recomputed_id, union
from paperloom.schema import filled, strings, text_of

# What a number in a claim looks like, what a measurement states, kinds that metadata may carry, triggers by kind of gap.
NUMBER = r"(?<![A-Za-z0-9_])[-+]?(?:\d+(?:[.,]\d+)?|\.\d+)(?:%|‰)?"
MEASURED = ("population", "denominator", "timeframe", "estimator", "method", "uncertainty")
BIBLIOGRAPHIC = ("BIBLIOGRAPHIC_FACT", "ATTRIBUTION")
TRIGGERS = {
    "SOURCE_UNAVAILABLE": ("PRIMARY_SOURCE_MISSING",),
    "CONTENT_INACCESSIBLE": ("FULLTEXT_MISSING", "FORMAL_VERSION_UNRESOLVED"),
    "IDENTITY_UNRESOLVED": ("IDENTIFIER_CONFLICT", "FORMAL_VERSION_UNRESOLVED", "PREPRINT_TO_VOR_CHECK"),
    "CLAIM_UNVERIFIED": ("POPULATION_GAP", "CLAIM_CONTRADICTION", "PRIMARY_SOURCE_MISSING"),
    "NUMERIC_CONFLICT": ("NUMERIC_CONFLICT", "POPULATION_GAP"),
}
DONE = ("SUCCESS", "NO_RESULTS", "PARTIAL")


def _implies(when: Column, then: Column) -> Column:
    return ~F.coalesce(when, F.lit(False)) | then


def _ids(col: str) -> Column:
    return F.array_sort(strings(F.col(col)))


def numeric_rules(claims: DataFrame, estimates: DataFrame) -> DataFrame:
    """Numbers in a claim are measured, and the estimates are those of the ledger (V3).

    ``claims`` has (claim_id, claim_text, measurement: struct of MEASURED or null, effect_estimate_ids), ``estimates`` (estimate_id, claim_id).
    """
    used = claims.select("claim_id", F.explode("effect_estimate_ids").alias("estimate_id"))
    claims = dealt(claims, "claim_id")
    own = estimates.groupBy("claim_id").agg(F.array_sort(F.collect_set("estimate_id")).alias("_own"))
    both = claims.join(own, "claim_id", "left")
    measured = F.col("measurement").isNotNull()
    lacks = F.filter(F.array(*[F.when(~filled(F.trim(f"measurement.{m}")), m) for m in MEASURED]), lambda m: m.isNotNull())
    known = estimates.select("estimate_id", F.col("claim_id").alias("_of")).distinct()
    odd = used.join(known, "estimate_id", "left").groupBy("claim_id", "estimate_id").agg(F.bool_or(F.coalesce(F.col("_of") == F.col("claim_id"), F.lit(False))).alias("ok"))
    return union(
        holds("number_is_measured", claims, "claim_id", _implies(F.col("claim_text").rlike(NUMBER), measured), F.regexp_extract("claim_text", NUMBER, 0)),
        holds("measurement_is_whole", claims, "claim_id", _implies(measured, F.size(lacks) == 0), F.array_join(lacks, ",")),
        holds("measurement_has_estimates", claims, "claim_id", _implies(measured, F.size(strings(F.col("effect_estimate_ids"))) > 0)),
        holds("estimate_is_the_claims", odd, "claim_id", F.col("ok"), "estimate_id"),
        foreign("estimate_claim_known", estimates, "claim_id", claims, "claim_id"),
        holds("estimates_are_the_ledgers", both, "claim_id", _ids("effect_estimate_ids") == strings(F.col("_own")), F.array_join(strings(F.col("_own")), ",")),
    )


def locator_rules(claims: DataFrame, bindings: DataFrame) -> DataFrame:
    """A claim's citations, url, locator and origin are those of its bindings (V3).

    ``claims`` has (claim_id, claim_kind, claim_origin, source_url, locator, citation_binding_ids), ``bindings`` (binding_id, claim_id,
    source_url, locator, extraction_origin).
    """
    claims = dealt(claims, "claim_id")
    own = bindings.groupBy("claim_id").agg(F.array_sort(F.collect_set("binding_id")).alias("_ids"), *[F.collect_set(c).alias(f"_{c}") for c in ("source_url", "locator", "extraction_origin")])
    both = claims.join(own, "claim_id", "left")
    among = lambda c, of: F.coalesce(F.array_contains(f"_{of}", F.col(c)), F.lit(False))
    return union(
        holds("citations_are_bindings", both, "claim_id", _ids("citation_binding_ids") == strings(F.col("_ids")), F.array_join(strings(F.col("_ids")), ",")),
        holds("url_is_bound", both, "claim_id", among("source_url", "source_url"), "source_url"),
        holds("locator_is_bound", both, "claim_id", among("locator", "locator"), "locator"),
        holds("claims_infer_nothing", claims, "claim_id", ~(text_of(F.col("claim_origin")) == "MODEL_INFERENCE")),
        holds("origin_is_bound", both.where(filled(F.col("claim_origin")) & (F.col("claim_origin") != "MODEL_INFERENCE")), "claim_id", among("claim_origin", "extraction_origin"), "claim_origin"),
        holds("metadata_is_bibliographic", claims, "claim_id", _implies(F.col("claim_origin") == "METADATA_REPORTED", F.col("claim_kind").isin(*BIBLIOGRAPHIC)), "claim_kind"),
    )


def conflict_rules(claims: DataFrame, groups: DataFrame, inferences: DataFrame, bindings: DataFrame) -> DataFrame:
    """Conflicts are grouped, groups are sorted and resolved with a reason; inferences say that they are and on what they rest (V3).

    ``claims`` has (claim_id, status), ``groups`` (conflict_id, claim_ids, dimensions, status, resolution), ``inferences``
    (inference_id, claim_id, origin, basis_binding_ids), ``bindings`` (binding_id).
    """
    inside = groups.select("conflict_id", F.explode("claim_ids").alias("claim_id"))
    lone = claims.where("status = 'CONFLICT'").join(inside.select("claim_id").distinct(), "claim_id", "left_anti")
    in_order = lambda c: F.col(c) == F.array_sort(F.col(c))
    return union(
        holds("conflict_is_grouped", lone, "claim_id", F.lit(False)),
        holds("group_claims_sorted", groups, "conflict_id", in_order("claim_ids")),
        holds("group_dimensions_sorted", groups, "conflict_id", in_order("dimensions")),
        foreign("group_claim_known", inside, "claim_id", claims, "claim_id"),
        holds("resolved_says_why", groups, "conflict_id", _implies(F.col("status") == "RESOLVED", filled(F.trim("resolution")))),
        holds("inference_says_so", inferences, "inference_id", F.col("origin") == "MODEL_INFERENCE", "origin"),
        foreign("inference_claim_known", inferences, "claim_id", claims, "claim_id"),
        foreign("inference_basis_known", inferences.select(F.explode("basis_binding_ids").alias("binding_id")), "binding_id", bindings, "binding_id"),
    )


def followup_rules(followups: DataFrame, gaps: DataFrame, attempts: DataFrame, run_id: str) -> DataFrame:
    """A follow-up is of a gap that was there before, and says what its receipt says (V3).

    ``followups`` is as ``gaps.followups`` makes it, ``gaps`` as ``gaps.after_run``, ``attempts`` has (attempt_id, source_id, stage, status,
    query, attempted_at).
    """
    g = gaps.select("gap_id", *[F.col(c).alias(f"g_{c}") for c in ("gap_type", "scope_type", "scope_id", "first_seen_run", "receipt_ids")], F.lit(True).alias("_gap"))
    a = attempts.select("attempt_id", *[F.col(c).alias(f"a_{c}") for c in ("source_id", "stage", "status", "query", "attempted_at")], F.lit(True).alias("_attempt"))
    rows = followups.join(g, "gap_id", "left").join(a, "attempt_id", "left")
    of_gap, of_try = rows.where("_gap"), rows.where("_attempt")
    fits = F.lit(False)
    for kind, triggers in TRIGGERS.items():
        fits = fits | ((F.col("g_gap_type") == kind) & F.col("trigger").isin(*triggers))
    good = F.col("a_status").isin("SUCCESS", "NO_RESULTS")
    same = lambda c, of: holds(f"followup_{c}_is_the_receipts", of_try, "followup_id", F.col(c).eqNullSafe(text_of(F.col(of).cast("string"))), c)
    return union(
        holds("followup_gap_was_there", rows, "followup_id", F.col("_gap") & (F.col("g_first_seen_run") != run_id), "gap_id"),
        holds("followup_was_made", rows, "followup_id", F.col("_attempt") & (F.col("a_status") != "NOT_ATTEMPTED"), "attempt_id"),
        holds("followup_stage", of_try.where("a_status <> 'NOT_ATTEMPTED'"), "followup_id", F.col("a_stage") == "FOLLOWUP", "a_stage"),
        holds("followup_in_the_ledger", of_gap, "followup_id", F.array_contains("g_receipt_ids", F.col("attempt_id")), "attempt_id"),
        holds("followup_scope", of_gap, "followup_id", (F.col("scope_type") == F.col("g_scope_type")) & (F.col("scope_id") == F.col("g_scope_id")), "scope_id"),
        holds("followup_trigger", of_gap, "followup_id", fits, "trigger"),
        holds("followup_names_its_work", of_gap, "followup_id", _implies(F.col("g_scope_type") == "WORK", F.col("parent_candidate_id") == F.col("g_scope_id")), "parent_candidate_id"),
        same("source_backend", "a_source_id"), same("attempted_at", "a_attempted_at"), same("result", "a_status"), same("query", "a_query"),
        holds("followup_outcome", of_try, "followup_id", F.col("outcome") == F.when(good, "RESOLVED").otherwise("STILL_OPEN"), "outcome"),
        holds("followup_resolves", of_try, "followup_id", F.col("resolved_gap_ids") == F.when(good, F.array("gap_id")).otherwise(F.array().cast("array<string>"))),
        recomputed_id("followup_id_stable", followups, "followup_id", stable_id("followup", F.col("gap_id"), F.col("attempt_id"))),
    )


def backlog_rules(checks: DataFrame, access: DataFrame, gaps: DataFrame) -> DataFrame:
    """What failed is in the backlog (V3), and gaps end where their attempts do.

    ``checks`` has (source_id, status), ``access`` (provider, work_id, status), ``gaps`` (gap_id, status, attempt_count, max_attempts).
    """
    failed = checks.where(F.col("status").isin("FAILED", "NOT_ATTEMPTED")).select("source_id", stable_id("gap", F.lit("SOURCE_UNAVAILABLE"), F.col("source_id")).alias("gap_id"))
    shut = access.where((F.col("status") == "FAILED") & filled(F.col("work_id")) & F.col("provider").isin(*CONTENT_PROVIDERS)).select("work_id", stable_id("gap", F.lit("CONTENT_INACCESSIBLE"), F.col("work_id")).alias("gap_id")).distinct()
    kept = gaps.where(F.col("status").isin("OPEN", "UNRESOLVABLE", "DEFERRED")).select("gap_id")
    spent = F.col("attempt_count") >= F.col("max_attempts")
    return union(
        holds("failed_source_has_a_gap", failed.join(kept, "gap_id", "left_anti"), "source_id", F.lit(False), "gap_id"),
        holds("failed_content_has_a_gap", shut.join(gaps.select("gap_id"), "gap_id", "left_anti"), "work_id", F.lit(False), "gap_id"),
        holds("spent_gap_is_closed", gaps, "gap_id", _implies(spent, F.col("status").isin("RESOLVED", "UNRESOLVABLE")), "status"),
        holds("unresolvable_gap_is_spent", gaps, "gap_id", _implies(F.col("status") == "UNRESOLVABLE", spent), "attempt_count"),
    )


def inventory_rules(access: DataFrame) -> DataFrame:
    """An inventory is complete or says that it isn't, and is the same for all queries of a provider (V3).

    ``access`` has (source_access_id, provider, status, retrieval_complete, feed_entry_count, registry_record_count,
    window_record_count, unusable_record_count, pages_requested, pages_received); rows without retrieval_complete are no inventories.
    """
    rows = access.where("retrieval_complete IS NOT NULL")
    key, whole, broken = "source_access_id", F.col("retrieval_complete"), F.col("status").isin("FAILED", "PARTIAL")
    said = F.struct("retrieval_complete", "feed_entry_count", "registry_record_count", "window_record_count", "unusable_record_count", "pages_requested", "pages_received")
    differ = rows.groupBy("provider").agg(F.min(said).alias("a"), F.max(said).alias("b"))
    asked, got = F.col("pages_requested"), F.col("pages_received")
    return union(
        holds("incomplete_is_said", rows, key, _implies(~whole, broken), "status"),
        holds("complete_is_said", rows, key, _implies(whole, ~broken), "status"),
        holds("unusable_is_incomplete", rows, key, _implies(F.col("unusable_record_count") > 0, ~whole), "unusable_record_count"),
        holds("window_within_inventory", rows, key, F.coalesce(F.col("window_record_count") <= F.col("feed_entry_count") + F.col("registry_record_count"), F.lit(True)), "window_record_count"),
        holds("inventory_pages", rows.where("pages_requested IS NOT NULL OR pages_received IS NOT NULL"), key, (asked >= 1) & (got >= 0) & (got <= asked), F.concat_ws("/", got, asked)),
        holds("complete_has_its_pages", rows, key, _implies(whole & (asked >= 1) & (got >= 0) & (got <= asked), got == asked), F.concat_ws("/", got, asked)),
        holds("inventory_is_one", differ, "provider", F.col("a").eqNullSafe(F.col("b"))),
    )


def http_rules(access: DataFrame) -> DataFrame:
    """Requests and responses are counts that a status can have, and cover the inventory that they fetched (V3).

    ``access`` has the columns of ``inventory_rules`` and (http_requests_attempted, http_responses_received, cache_reused, error).
    """
    rows, key = access.where("http_requests_attempted IS NOT NULL OR http_responses_received IS NOT NULL OR cache_reused IS NOT NULL"), "source_access_id"
    asked, got, cached = F.col("http_requests_attempted"), F.col("http_responses_received"), F.coalesce("cache_reused", F.lit(False))
    fine = F.coalesce((asked >= 0) & (got >= 0) & (got <= asked) & F.col("cache_reused").isNotNull(), F.lit(False))
    counts, replay = F.concat_ws("/", got, asked), (F.col("status") == "FAILED") & (F.col("retrieval_complete") == F.lit(False)) & filled(F.col("error"))
    return union(
        holds("http_counts", rows, key, fine, counts),
        holds("cache_asks_nothing", rows.where(fine & cached), key, (asked == 0) & (got == 0), counts),
        holds("cache_has_a_result", rows.where(fine & cached), key, F.col("status").isin(*DONE) | F.coalesce(replay, F.lit(False)), "status"),
        holds("done_has_a_response", rows.where(fine & ~cached), key, _implies(F.col("status").isin(*DONE), (asked >= 1) & (got >= 1)), counts),
        holds("http_covers_the_inventory", rows.where(fine & ~cached & F.col("pages_requested").isNotNull() & F.col("pages_received").isNotNull()), key, (asked >= F.col("pages_requested")) & (got >= F.col("pages_received")), counts),
    )
