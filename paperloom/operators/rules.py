"""Integrity rules as queries: each gives its violations, all have (rule, key, detail)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.ids import stable_id
from paperloom.functions.normalize import canonical_url, source_role, source_type
from paperloom.operators.classify import FORMAL_TYPES, TITLE_DESIGNS
from paperloom.schema import ACCESS_DEPTHS, rank_of, strings

VIOLATION = "rule string, key string, detail string"

#: Rows, by count, from which a table is dealt by its key; both ways give the same violations.
MANY = 1 << 18


def dealt(rows: DataFrame, key: str, many: bool | None = None) -> DataFrame:
    """Many rows (more than MANY, unless it is said) by key over the session's number of shuffle partitions, and as many tasks.

    AQE puts partitions together by their compressed bytes, and keys in order compress so well that one task would get
    tens of millions of rows.  It leaves alone partitions whose number was asked for, and those that are joined with them.
    """
    if getattr(rows, "_dealt_by", None) == key:
        return rows
    many = rows.count() > MANY if many is None else many
    out = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key) if many else rows.select("*")
    out._dealt_by, out._many = key, many
    return out


def _as_violations(rule: str, rows: DataFrame, key: Column | str, detail: Column | str = "") -> DataFrame:
    c = lambda x: F.col(x) if isinstance(x, str) and x else x if isinstance(x, Column) else F.lit(x)
    return rows.select(F.lit(rule).alias("rule"), c(key).cast("string").alias("key"), c(detail).cast("string").alias("detail"))


def unique(rule: str, rows: DataFrame, key: str) -> DataFrame:
    """Keys that several rows have."""
    return _as_violations(rule, dealt(rows, key).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), key, "n")


def foreign(rule: str, rows: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values that the parent table doesn't have; ``key`` is the parent's own, so few of its rows share one."""
    own = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct()
    return _as_violations(rule, own.join(dealt(parent, key).select(F.col(key).alias("_v")), "_v", "left_anti"), "_v", F.lit("unknown"))


def holds(rule: str, rows: DataFrame, key: str, condition: Column, detail: Column | str = "") -> DataFrame:
    """Rows for which a condition is false or unknown."""
    return _as_violations(rule, rows.where(~F.coalesce(condition, F.lit(False))), key, detail)


def recomputed_id(rule: str, rows: DataFrame, key: str, made: Column) -> DataFrame:
    """Rows whose id isn't the hash of what it stands for."""
    return holds(rule, rows, key, F.col(key) == made, made)


def same_counts(rule: str, rows: DataFrame, group: str, stated: DataFrame) -> DataFrame:
    """Groups whose number of rows isn't the stated ``n``."""
    found = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_found"))
    both = found.join(stated.select(group, "n"), group, "full_outer").where("not (n <=> _found)")
    return _as_violations(rule, both, group, F.concat_ws("/", F.coalesce("n", F.lit(0)), F.coalesce("_found", F.lit(0))))


def union(*violations: DataFrame) -> DataFrame:
    """All violations of a suite (V2)."""
    out = violations[0]
    for v in violations[1:]:
        out = out.unionByName(v)
    return out


# --- suites


def study_rules(rows: DataFrame, key: str = "work_id") -> DataFrame:
    """Classification columns are what they may be, sorted, and named by a basis (V6)."""
    designs = strings(F.col("study_designs"))
    known = [*TITLE_DESIGNS, "clinical_trial", "review", "observational_study"]
    return union(
        holds("document_type_known", rows, key, F.col("document_type").isin(*FORMAL_TYPES, "preprint", "other", "unknown"), "document_type"),
        holds("study_designs_sorted", rows, key, designs == F.array_sort(F.array_distinct(designs))),
        holds("study_designs_known", rows, key, F.size(F.array_except(designs, F.array(*map(F.lit, known)))) == 0),
        holds("study_basis_iff_designs", rows, key, (F.col("study_design_basis") == "UNKNOWN") == (F.size(designs) == 0), "study_design_basis"),
        holds("document_basis_iff_type", rows, key, (F.col("document_type_basis") == "UNKNOWN") == (F.col("document_type") == "unknown"), "document_type_basis"),
    )


def access_rules(rows: DataFrame, key: str = "work_id") -> DataFrame:
    """Open access and access are kept apart (V5): a url is no access, a landing page is no full text."""
    opened = F.exists("fulltext_locations", lambda x: x["access_status"] == "ACCESSIBLE")
    return union(
        holds("access_status_known", rows, key, F.col("access_status").isin("ACCESSIBLE", "BLOCKED", "PAYWALLED", "FAILED", "NOT_CHECKED"), "access_status"),
        holds("oa_status_known", rows, key, F.col("oa_status").isin("YES", "NO", "UNKNOWN"), "oa_status"),
        holds("accessible_needs_location", rows, key, (F.col("access_status") != "ACCESSIBLE") | opened),
        holds("fulltext_unknown_iff_no_url", rows, key, (F.size("download_urls") == 0) == (F.col("fulltext_access_status") == "UNKNOWN"), "fulltext_access_status"),
        holds("locations_are_download_urls", rows, key, F.size(F.array_except(F.transform("fulltext_locations", lambda x: x["url"]), F.col("download_urls"))) == 0),
    )


def ledger_rules(ledger: DataFrame) -> DataFrame:
    """The candidate table is one row a work, with statuses that fit together (V4)."""
    return union(
        unique("work_id_unique", ledger, "work_id"),
        holds("triage_known", ledger, "work_id", F.col("triage_status").isin("PRIORITY", "REVIEW_REQUIRED", "LOWER_PRIORITY"), "triage_status"),
        holds("reasons_sorted", ledger, "work_id", F.col("triage_reasons") == F.array_sort(F.array_distinct("triage_reasons"))),
        holds("priority_has_event", ledger, "work_id", (F.col("triage_status") != "PRIORITY") | (F.col("event_status") != "NO_QUALIFYING_EVENT")),
        holds("score_in_range", ledger, "work_id", F.col("score").between(0, 100), F.col("score")),
    )


def registry_rules(registry: DataFrame, observations: DataFrame, works: DataFrame) -> DataFrame:
    """Sources are canonical, of known works, with ids that are their hashes; observations are of known sources (V3, V7)."""
    kind = source_type(F.col("url"))
    return union(
        unique("source_id_unique", registry, "source_id"),
        unique("source_url_unique", registry, "url"),
        holds("source_url_canonical", registry, "source_id", F.col("url") == canonical_url(F.col("url")), "url"),
        recomputed_id("source_id_stable", registry, "source_id", stable_id("src", F.col("url"))),
        foreign("source_work_known", registry, "work_id", works, "work_id"),
        holds("source_type_fits", registry, "source_id", (F.col("source_type") == kind) & (F.col("source_role") == source_role(F.col("url"), kind)), "source_type"),
        foreign("observation_source_known", observations, "source_id", registry, "source_id"),
    )


def receipt_rules(receipts: DataFrame) -> DataFrame:
    """Receipts are what their status allows (V3): pages, errors, results, hashes."""
    failed = F.col("status").isin("FAILED", "NOT_ATTEMPTED", "PARTIAL")
    return union(
        unique("attempt_id_unique", receipts, "attempt_id"),
        holds("pages_in_order", receipts, "attempt_id", (F.col("pages_received") >= 0) & (F.col("pages_received") <= F.col("pages_requested"))),
        holds("not_attempted_asks_nothing", receipts, "attempt_id", (F.col("status") != "NOT_ATTEMPTED") | (F.col("pages_requested") == 0)),
        holds("error_iff_failed", receipts, "attempt_id", failed == F.col("error_class").isNotNull(), "status"),
        holds("failed_has_no_results", receipts, "attempt_id", ~F.col("status").isin("FAILED", "NOT_ATTEMPTED") | (F.col("result_count") == 0), F.col("result_count")),
        holds("fingerprint_is_sha256", receipts, "attempt_id", F.col("request_fingerprint").rlike("^[0-9a-f]{64}$")),
    )


def claim_rules(claims: DataFrame, bindings: DataFrame, sources: DataFrame, inferences: DataFrame) -> DataFrame:
    """Claims rest on their bindings, and on full texts if they are called supported.

    ``claims`` (claim_id, kind, status, source_ids), ``bindings`` (claim_id, source_id, depth), ``sources`` (source_id,
    source_role, access_depth), ``inferences`` (inference_id, claim_id).
    """
    supported = claims.where("status = 'SUPPORTED'")
    claims = dealt(claims, "claim_id")
    bound = bindings.groupBy("claim_id").agg(F.array_sort(F.collect_set("source_id")).alias("bound"))
    both = claims.join(bound, "claim_id", "left")
    deep = dealt(bindings.join(sources, "source_id").where(supports_claim()).select("claim_id"), "claim_id", claims._many)  # an anti-join is done before what it keeps is dealt
    beyond = bindings.join(sources, "source_id").where(rank_of(F.col("depth"), ACCESS_DEPTHS) > rank_of(F.col("access_depth"), ACCESS_DEPTHS))
    return union(
        unique("claim_id_unique", claims, "claim_id"),
        foreign("binding_source_known", bindings, "source_id", sources, "source_id"),
        foreign("binding_claim_known", bindings, "claim_id", claims, "claim_id"),
        foreign("inference_claim_known", inferences, "claim_id", claims, "claim_id"),
        holds("claim_sources_are_bindings", both, "claim_id", F.array_sort(strings(F.col("source_ids"))) == strings(F.col("bound"))),
        _as_violations("supported_needs_full_text", supported.join(deep, "claim_id", "left_anti"), "claim_id"),
        _as_violations("binding_deeper_than_access", beyond, "claim_id", "source_id"),
    )


def supports_claim() -> Column:
    """Whether a source can carry a claim: a direct full text that was opened."""
    return (F.col("access_depth") == "FULL_TEXT") & F.col("source_role").isin("PRIMARY_RESEARCH", "FORMAL_PUBLICATION")


def supports_kind(kind: Column) -> Column:
    """Whether a source can carry a claim of a kind (F16): effects need primary research."""
    return supports_claim() & (~kind.isin("EFFECT", "NUMERIC") | (F.col("source_role") == "PRIMARY_RESEARCH"))


def relation_rules(relations: DataFrame) -> DataFrame:
    """Relations join two works and are named by them (V3)."""
    made = stable_id("workrel", F.col("from_work_id"), F.col("to_work_id"), F.col("relation_type"))
    return union(unique("relation_id_unique", relations, "relation_id"), holds("relation_not_to_itself", relations, "relation_id", F.col("from_work_id") != F.col("to_work_id")), recomputed_id("relation_id_stable", relations, "relation_id", made))


def gap_rules(gaps: DataFrame, receipts: DataFrame) -> DataFrame:
    """Gaps use no more attempts than they have, and are resolved by a receipt (V3)."""
    used = gaps.select("gap_id", F.explode("receipt_ids").alias("attempt_id"))
    return union(
        unique("gap_id_unique", gaps, "gap_id"),
        holds("attempts_in_limit", gaps, "gap_id", F.col("attempt_count") <= F.col("max_attempts"), F.col("attempt_count")),
        holds("resolved_has_receipt", gaps, "gap_id", (F.col("status") == "RESOLVED") == F.col("resolution_receipt_id").isNotNull(), "status"),
        foreign("gap_receipt_known", used, "attempt_id", receipts, "attempt_id"),
    )


def inventory_url_rules(rows: DataFrame, window: tuple[str, str], key: str = "source_access_id", url: str = "url") -> DataFrame:
    """Inventory urls that carry a window carry the run's (V7)."""
    since = F.regexp_extract(url, r"from-(?:online-)?pub-date:(\d{4}-\d{2}-\d{2})", 1)
    until = F.regexp_extract(url, r"until-(?:online-)?pub-date:(\d{4}-\d{2}-\d{2})", 1)
    return holds("inventory_window", rows.where(F.contains(F.col(url), F.lit("pub-date"))), key, (since == window[0]) & (until == window[1]), url)


def marker_rules(html: DataFrame, ids: DataFrame, key: str = "work_id") -> DataFrame:
    """The ids a report shows are exactly those of the ledger (V8).  ``html`` has (report_id, html)."""
    shown = dealt(html.select(F.explode(F.regexp_extract_all("html", F.lit(r'data-work-id="([^"]*)"'), 1)).alias(key)), key)
    return union(unique("marker_unique", shown, key), foreign("marker_known", shown, key, ids, key), foreign("marker_missing", ids, key, shown, key))


# --- documents

_KINDS: Mapping[str, Callable[[object], bool]] = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "null": lambda v: v is None,
}


def document_faults(value, schema: dict, root: dict | None = None, at: str = "$") -> list[str]:
    """What in a document a JSON schema does not allow (V1); for single documents on the driver."""
    root = root or schema
    if "$ref" in schema:
        target = root
        for step in schema["$ref"].lstrip("#/").split("/"):
            target = target[step]
        return document_faults(value, target, root, at)
    out: list[str] = []
    say = lambda text: out.append(f"{at}: {text}")
    for part in schema.get("allOf", ()):
        out += document_faults(value, part, root, at)
    if "anyOf" in schema and all(document_faults(value, s, root, at) for s in schema["anyOf"]):
        say("fits none of anyOf")
    if "oneOf" in schema and sum(not document_faults(value, s, root, at) for s in schema["oneOf"]) != 1:
        say("does not fit exactly one of oneOf")
    if "not" in schema and not document_faults(value, schema["not"], root, at):
        say("fits what it must not")
    kinds = schema.get("type")
    if kinds and not any(_KINDS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        say(f"is not {kinds}")
        return out
    if "const" in schema and value != schema["const"]:
        say(f"is not {schema['const']!r}")
    if "enum" in schema and value not in schema["enum"]:
        say("is none of the values")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        out += [f"{at}: lacks {k}" for k in schema.get("required", ()) if k not in value]
        more = schema.get("additionalProperties", True)
        for k, v in value.items():
            if k in own:
                out += document_faults(v, own[k], root, f"{at}.{k}")
            elif more is False:
                say(f"has {k}")
            elif isinstance(more, dict):
                out += document_faults(v, more, root, f"{at}.{k}")
        size, low, high = len(value), "minProperties", "maxProperties"
    elif isinstance(value, list):
        for i, v in enumerate(value):
            out += document_faults(v, schema.get("items", {}), root, f"{at}[{i}]")
        if schema.get("uniqueItems") and len({repr(v) for v in value}) < len(value):
            say("repeats an item")
        size, low, high = len(value), "minItems", "maxItems"
    elif isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            say("does not match the pattern")
        size, low, high = len(value), "minLength", "maxLength"
    else:
        size, low, high = value if _KINDS["number"](value) else 0, "minimum", "maximum"
    if low in schema and size < schema[low] or high in schema and size > schema[high]:
        say("is out of bounds")
    return out


def state_shape(works: DataFrame, required: tuple[str, ...] = ("work_id", "title", "first_seen_at", "last_seen_at")) -> DataFrame:
    """Works that lack what every work has, or were last seen before they were first."""
    return union(*[holds(f"{c}_present", works, "work_id", F.coalesce(F.col(c).cast("string"), F.lit("")) != "") for c in required], holds("seen_in_order", works, "work_id", F.col("first_seen_at") <= F.col("last_seen_at")))


def master_faults(master: dict) -> list[str]:
    """References in a configuration to streams, groups or sources that it doesn't define (V9)."""
    sources, groups, streams = set(master.get("sources", {})), master.get("source_groups", {}), master.get("streams", {})
    out = [f"group {g} names unknown source {s}" for g, xs in groups.items() for s in xs if s not in sources]
    out += [f"stream {n} names unknown group {g}" for n, s in streams.items() for g in s.get("source_groups", ()) if g not in groups]
    return out + [f"profile {n} names unknown stream {s}" for n, p in master.get("profiles", {}).items() for s in p.get("streams", ()) if s not in streams]


def resolved_limits(defaults: dict, profile: dict) -> dict:
    """Defaults with a profile's values over them, at every depth."""
    out = dict(defaults)
    for k, v in profile.items():
        out[k] = resolved_limits(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
