"""Gaps over their life: what a run found, what follow-ups used up, when the next one is due.

A run's evidence is one row per scope.  A gap after a run follows from
the gap before it and that row, so runs can be folded one by one as tables
(``after_run``) or as a stream with state (``streaming.gap_stream``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.ids import stable_id
from paperloom.schema import filled, strings, text_of

# Providers whose pages hold a work's content, attempts that a gap has, days until the next, triggers by kind of gap.
CONTENT_PROVIDERS = ("publisher", "formal_proceedings_or_publisher", "formal")
MOST_ATTEMPTS, COOLDOWN_DAYS = 3, 1
TRIGGERS = {"SOURCE_UNAVAILABLE": "PRIMARY_SOURCE_MISSING", "CONTENT_INACCESSIBLE": "FULLTEXT_MISSING", "IDENTITY_UNRESOLVED": "IDENTIFIER_CONFLICT", "CLAIM_UNVERIFIED": "CLAIM_CONTRADICTION", "NUMERIC_CONFLICT": "NUMERIC_CONFLICT"}

TRY = "struct<attempt_id:string,stage:string,status:string,source_id:string,query:string,attempted_at:string>"
EVIDENCE = f"gap_id string, gap_type string, scope_type string, scope_id string, is_gap boolean, may_resolve boolean, tries array<{TRY}>"
GAP = "gap_id string, gap_type string, scope_type string, scope_id string, first_seen_run string, last_attempt_run string, attempt_count int, status string, max_attempts int, receipt_ids array<string>, resolution_receipt_id string, cooldown_until timestamp"


def evidence(checks: DataFrame, access: DataFrame, attempts: DataFrame) -> DataFrame:
    """EVIDENCE of a run (J11): one row per source that was checked, and per work whose content was asked for.

    ``checks`` has (source_id, status), ``access`` (source_id, provider, work_id, status), ``attempts`` (attempt_id, source_id,
    source_access_id, stage, status, query, attempted_at).  A source's tries are all attempts at it, a work's those whose access
    row it is.  A work with several access rows is accessible if one of them is.
    """
    tries = attempts.select("source_id", "source_access_id", F.struct("attempt_id", "stage", "status", "source_id", "query", F.col("attempted_at").cast("string").alias("attempted_at")).alias("t"))
    listed = lambda t, key: t.where(filled(F.col(key))).groupBy(F.col(key).alias("scope")).agg(F.array_sort(F.collect_list("t")).alias("tries"))
    row = lambda t, kind, scope_type, gap, fine: t.select(
        stable_id("gap", F.lit(kind), F.col("scope")).alias("gap_id"), F.lit(kind).alias("gap_type"), F.lit(scope_type).alias("scope_type"), F.col("scope").alias("scope_id"),
        gap.alias("is_gap"), fine.alias("may_resolve"), F.coalesce("tries", F.array().cast(f"array<{TRY}>")).alias("tries"),
    )
    by_source = checks.select(F.col("source_id").alias("scope"), "status").join(listed(tries, "source_id"), "scope", "left")
    sources = row(by_source, "SOURCE_UNAVAILABLE", "SOURCE_SYSTEM", F.col("status").isin("FAILED", "NOT_ATTEMPTED"), F.col("status").isin("SUCCESS", "NO_RESULTS"))
    asked = access.where(F.col("provider").isin(*CONTENT_PROVIDERS) & filled(F.col("work_id"))).select(F.col("source_id").alias("source_access_id"), F.col("work_id").alias("scope"), "status")
    state = asked.groupBy("scope").agg(F.bool_or(F.col("status") == "SUCCESS").alias("fine"), F.bool_or(F.col("status") == "FAILED").alias("failed"))
    own = asked.select("source_access_id", "scope").distinct().join(tries.drop("source_id"), "source_access_id").drop("source_access_id")
    works = state.join(listed(own, "scope"), "scope", "left")
    return sources.unionByName(row(works, "CONTENT_INACCESSIBLE", "WORK", F.col("failed") & ~F.col("fine"), F.col("fine")))


def _did(tries: Column) -> Column:
    return F.filter(tries, lambda t: t["status"] != "NOT_ATTEMPTED")


def _followed(tries: Column) -> Column:
    return F.filter(_did(tries), lambda t: t["stage"] == "FOLLOWUP")


def _good(tries: Column) -> Column:
    return F.filter(tries, lambda t: t["status"].isin("SUCCESS", "NO_RESULTS"))


def after_run(found: DataFrame, prior: DataFrame, run_id: str, at: Column) -> DataFrame:
    """GAP rows after a run.

    A failure opens a gap or keeps it open, a success closes it, and follow-ups,
    not routine searches, use up its attempts; an open gap rests for a day after one.
    What wasn't a gap and isn't one leaves none.
    """
    p = prior.select(*[F.col(c).alias(f"p_{c}") for c in prior.columns])
    both = found.join(p, F.col("gap_id") == F.col("p_gap_id"), "full_outer")
    tries, known = F.coalesce("tries", F.array().cast(f"array<{TRY}>")), F.col("p_gap_id").isNotNull()
    success = F.when(F.col("may_resolve"), F.get(_good(_did(tries)), F.lit(0))["attempt_id"])
    changed = F.coalesce(F.col("is_gap") | (known & success.isNotNull()), F.lit(False))
    count = F.coalesce("p_attempt_count", F.lit(0)) + F.size(_followed(tries))
    most = F.coalesce("p_max_attempts", F.lit(MOST_ATTEMPTS))
    status = F.when(success.isNotNull(), "RESOLVED").when(F.col("is_gap") & (count >= most), "UNRESOLVABLE").otherwise("OPEN")
    rests = F.when(status == "OPEN", F.when(F.size(_followed(tries)) > 0, at + F.make_dt_interval(F.lit(COOLDOWN_DAYS))).otherwise(F.col("p_cooldown_until")))
    pick = lambda new, old: F.when(changed, new).otherwise(F.col(f"p_{old}")).alias(old)
    same = lambda c: F.coalesce(c, f"p_{c}").alias(c)
    ids = F.array_sort(F.array_union(strings(F.col("p_receipt_ids")), F.transform(tries, lambda t: t["attempt_id"])))
    return both.where(changed | known).select(
        *map(same, ("gap_id", "gap_type", "scope_type", "scope_id")), pick(F.coalesce("p_first_seen_run", F.lit(run_id)), "first_seen_run"),
        pick(F.when(F.size(_did(tries)) > 0, run_id).otherwise(F.coalesce("p_last_attempt_run", F.lit(run_id))), "last_attempt_run"), pick(count, "attempt_count").cast("int").alias("attempt_count"), pick(status, "status"),
        most.cast("int").alias("max_attempts"), pick(ids, "receipt_ids"), pick(success, "resolution_receipt_id"), pick(rests, "cooldown_until"),
    )


def followups(found: DataFrame, prior: DataFrame, at: Column) -> DataFrame:
    """What a run's follow-ups of open gaps came to (J11): the first that succeeded, else the last; one row per gap."""
    open_ = prior.where("status = 'OPEN'").select(F.col("gap_id"))
    rows = found.join(open_, "gap_id", "left_semi").where(F.size(_followed(F.col("tries"))) > 0)
    tries = F.col("tries")
    success = F.when(F.col("may_resolve"), F.get(_good(_did(tries)), F.lit(0))["attempt_id"])
    chosen = F.coalesce(F.get(_good(_followed(tries)), F.lit(0)), F.element_at(_followed(tries), -1))
    trigger = F.element_at(F.create_map(*[F.lit(x) for pair in TRIGGERS.items() for x in pair]), F.col("gap_type"))
    rows = rows.where(F.col("is_gap") | success.isNotNull()).withColumn("t", chosen)
    return rows.select(
        stable_id("followup", F.col("gap_id"), F.col("t.attempt_id")).alias("followup_id"), "gap_id", trigger.alias("trigger"), "scope_type", "scope_id", F.when(F.col("scope_type") == "WORK", F.col("scope_id")).alias("parent_candidate_id"), F.col("t.attempt_id").alias("attempt_id"),
        F.coalesce(F.nullif("t.query", F.lit("")), "scope_id").alias("query"), F.coalesce(F.nullif("t.source_id", F.lit("")), F.lit("unknown")).alias("source_backend"), F.coalesce(F.nullif("t.attempted_at", F.lit("")), at.cast("string")).alias("attempted_at"),
        text_of(F.col("t.status")).alias("result"), F.when(success.isNotNull(), F.array("gap_id")).otherwise(F.array().cast("array<string>")).alias("resolved_gap_ids"), F.when(success.isNotNull(), "RESOLVED").otherwise("STILL_OPEN").alias("outcome"),
    )


def due(gaps: DataFrame, at: Column) -> DataFrame:
    """Open gaps that may be followed up: those that have rested."""
    return gaps.where((F.col("status") == "OPEN") & (F.col("cooldown_until").isNull() | (F.col("cooldown_until") <= at)))
