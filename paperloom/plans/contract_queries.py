"""Queries that hold rows made of the test tables against the evidence contract, fold gaps over runs, and prove lists.

Remainders of keys decide which rows break a rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators import classify, contract, digests, gaps, json_schema, score, state
from paperloom.operators.state import spool
from paperloom.plans import pages
from paperloom.plans.bindings import docs, nth, query, sql_nth
from paperloom.plans.rule_queries import every, keyed
from paperloom.session import table

def key() -> Column:
    return F.col("k")


def named(prefix: str, n: Column | None = None) -> Column:
    return F.concat(F.lit(prefix), (key() if n is None else n).cast("string"))


def listed(col: Column, there: Column) -> Column:
    return F.when(there, F.array(col)).otherwise(F.array().cast("array<string>"))


@query("""WITH c AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS number, o_orderkey % 6 <> 0 AS measured, CASE WHEN o_orderkey % 7 <> 0 THEN ['e' || o_orderkey] ELSE [] END AS said FROM orders),
    e AS (SELECT 'e' || k AS e, CASE WHEN k % 11 = 0 THEN (k + 1)::VARCHAR WHEN k % 13 = 0 THEN 'z' || k ELSE k::VARCHAR END AS of FROM c), own AS (SELECT of, list_sort(list(e)) AS own FROM e GROUP BY of), b AS (SELECT k, said, coalesce(own, []) AS own FROM c LEFT JOIN own ON of = k::VARCHAR)
    SELECT 'number_is_measured' AS rule, k::VARCHAR AS key, '12.5%' AS detail FROM c WHERE number AND NOT measured UNION ALL SELECT 'measurement_is_whole', k::VARCHAR, 'population,method' FROM c WHERE measured AND k % 5 = 0 UNION ALL SELECT 'measurement_has_estimates', k::VARCHAR, '' FROM c WHERE measured AND len(said) = 0
    UNION ALL SELECT 'estimate_is_the_claims', k::VARCHAR, 'e' || k FROM c WHERE k % 7 <> 0 AND (k % 11 = 0 OR k % 13 = 0) UNION ALL SELECT DISTINCT 'estimate_claim_known', of, 'unknown' FROM e WHERE of NOT IN (SELECT k::VARCHAR FROM c) UNION ALL SELECT 'estimates_are_the_ledgers', k::VARCHAR, array_to_string(own, ',') FROM b WHERE said <> own""")
def numeric_violations(spark, d):
    o = keyed(spark, d, "orders", "o_orderkey")
    parts = [F.when(every(5), F.lit("" if m == "population" else " ")).otherwise("x").alias(m) if m in ("population", "method") else F.lit("x").alias(m) for m in contract.MEASURED]
    claims = o.select(key().cast("string").alias("claim_id"), F.when(every(3), "a share of 12.5% rose").otherwise("v2 rose").alias("claim_text"), F.when(~every(6), F.struct(*parts)).alias("measurement"), listed(named("e"), ~every(7)).alias("effect_estimate_ids"))
    estimates = o.select(named("e").alias("estimate_id"), F.when(every(11), (key() + 1).cast("string")).when(every(13), named("z")).otherwise(key().cast("string")).alias("claim_id"))
    return contract.numeric_rules(claims, estimates)


@query("""WITH c AS (SELECT o_orderkey AS k, ['EFFECT', 'ATTRIBUTION', 'BIBLIOGRAPHIC_FACT'][o_orderkey % 3 + 1] AS kind, ['FULLTEXT_EXTRACTED', 'METADATA_REPORTED', '', 'MODEL_INFERENCE'][o_orderkey % 4 + 1] AS origin FROM orders),
    b AS (SELECT 'b' || k AS b, k AS c, k % 5 <> 0 AS url, k % 7 <> 0 AS spot, CASE WHEN k % 8 = 0 THEN 'ABSTRACT_EXTRACTED' ELSE origin END AS origin FROM c WHERE k % 9 <> 0 UNION ALL SELECT 'a' || k, k, TRUE, TRUE, 'OTHER' FROM c WHERE k % 10 = 0),
    own AS (SELECT c, list_sort(list(b)) AS ids, bool_or(url) AS url, bool_or(spot) AS spot, list(origin) AS origins FROM b GROUP BY c), x AS (SELECT k, kind, origin, CASE WHEN k % 6 = 0 THEN ['b' || k, 'x'] ELSE ['b' || k] END AS said, coalesce(ids, []) AS ids, coalesce(url, FALSE) AS url, coalesce(spot, FALSE) AS spot, coalesce(origins, []) AS origins FROM c LEFT JOIN own ON c = k)
    SELECT 'citations_are_bindings' AS rule, k::VARCHAR AS key, array_to_string(ids, ',') AS detail FROM x WHERE said <> ids UNION ALL SELECT 'url_is_bound', k::VARCHAR, 'https://j.org/' || k FROM x WHERE NOT url UNION ALL SELECT 'locator_is_bound', k::VARCHAR, 'p. ' || k FROM x WHERE NOT spot
    UNION ALL SELECT 'claims_infer_nothing', k::VARCHAR, '' FROM x WHERE origin = 'MODEL_INFERENCE' UNION ALL SELECT 'origin_is_bound', k::VARCHAR, origin FROM x WHERE origin NOT IN ('', 'MODEL_INFERENCE') AND NOT list_contains(origins, origin) UNION ALL SELECT 'metadata_is_bibliographic', k::VARCHAR, kind FROM x WHERE origin = 'METADATA_REPORTED' AND kind = 'EFFECT'""")
def locator_violations(spark, d):
    o = keyed(spark, d, "orders", "o_orderkey")
    origin = nth(["FULLTEXT_EXTRACTED", "METADATA_REPORTED", "", "MODEL_INFERENCE"], key())
    claims = o.select(key().alias("claim_id"), nth(["EFFECT", "ATTRIBUTION", "BIBLIOGRAPHIC_FACT"], key()).alias("claim_kind"), origin.alias("claim_origin"), named("https://j.org/").alias("source_url"), named("p. ").alias("locator"), F.when(every(6), F.array(named("b"), F.lit("x"))).otherwise(F.array(named("b"))).alias("citation_binding_ids"))
    row = lambda t, b, url, spot, how: t.select(named(b).alias("binding_id"), key().alias("claim_id"), F.when(url, named("https://j.org/")).otherwise("u").alias("source_url"), F.when(spot, named("p. ")).otherwise("s").alias("locator"), how.alias("extraction_origin"))
    bindings = row(o.where(~every(9)), "b", ~every(5), ~every(7), F.when(every(8), "ABSTRACT_EXTRACTED").otherwise(origin)).unionByName(row(o.where(every(10)), "a", F.lit(True), F.lit(True), F.lit("OTHER")))
    return contract.locator_rules(claims, bindings)


@query("""WITH c AS (SELECT c_custkey AS k FROM customer) SELECT 'conflict_is_grouped' AS rule, k::VARCHAR AS key, '' AS detail FROM c WHERE k % 4 = 0 AND k NOT IN (SELECT k FROM c WHERE k % 3 = 0 UNION ALL SELECT k + 1 FROM c WHERE k % 3 = 0) UNION ALL SELECT 'group_claims_sorted', 'g' || k, '' FROM c WHERE k % 3 = 0 AND k % 5 = 0 UNION ALL SELECT 'group_dimensions_sorted', 'g' || k, '' FROM c WHERE k % 3 = 0 AND k % 7 = 0
    UNION ALL SELECT DISTINCT 'group_claim_known', (k + 1)::VARCHAR, 'unknown' FROM c WHERE k % 3 = 0 AND k + 1 NOT IN (SELECT k FROM c) UNION ALL SELECT 'resolved_says_why', 'g' || k, '' FROM c WHERE k % 6 = 0 AND k % 9 = 0 UNION ALL SELECT 'inference_says_so', 'i' || k, 'HUMAN' FROM c WHERE k % 11 = 0
    UNION ALL SELECT 'inference_claim_known', (-k)::VARCHAR, 'unknown' FROM c WHERE k % 13 = 0 AND k > 0 UNION ALL SELECT 'inference_basis_known', 'b' || k, 'unknown' FROM c WHERE k % 17 = 0""")
def conflict_violations(spark, d):
    c = keyed(spark, d, "customer", "c_custkey")
    text = lambda x: x.cast("string")
    claims = c.select(text(key()).alias("claim_id"), F.when(every(4), "CONFLICT").otherwise("SUPPORTED").alias("status"))
    pair = F.array_sort(F.array(text(key()), text(key() + 1)))
    groups = c.where(every(3)).select(named("g").alias("conflict_id"), F.when(every(5), F.reverse(pair)).otherwise(pair).alias("claim_ids"), F.when(every(7), F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("dimensions"), F.when(every(6), "RESOLVED").otherwise("OPEN").alias("status"), F.when(every(9), " ").otherwise("because").alias("resolution"))
    inferences = c.select(named("i").alias("inference_id"), text(F.when(every(13), -key()).otherwise(key())).alias("claim_id"), F.when(every(11), "HUMAN").otherwise("MODEL_INFERENCE").alias("origin"), F.array(named("b")).alias("basis_binding_ids"))
    return contract.conflict_rules(claims, groups, inferences, c.where(~every(17)).select(named("b").alias("binding_id")))


def _runs(spark, d) -> list[tuple[DataFrame, DataFrame]]:
    """(checks, attempts) of two runs: even events and odd ones; a user is a source, a purchase a success, an error a follow-up that failed."""
    e = keyed(spark, d, "events", "event_id", "user_id", "event_type").withColumn("source_id", F.col("user_id").cast("string"))
    out = []
    for run in (0, 1):
        own = e.where((key() % 2 == run) & ((F.col("user_id") % 5 != 0) | (F.col("event_type") != "purchase") | (key() % 3 == 0)) & ((F.col("user_id") % 7 != 0) | (F.lit(run) == 1)))
        checks = own.groupBy("source_id").agg(F.when(F.bool_or((F.col("event_type") == "purchase") & (key() % 8 == run)), "SUCCESS").otherwise("FAILED").alias("status"))
        did = F.when((F.col("event_type") == "purchase") & (key() % 8 == run), "SUCCESS").when(F.col("event_type") == "error", "FAILED").otherwise("NOT_ATTEMPTED")
        attempts = own.where((F.col("event_type") != "error") | (key() % 40 < 2)).select(key().cast("string").alias("attempt_id"), "source_id", F.lit("").alias("source_access_id"), F.when(F.col("event_type") == "error", "FOLLOWUP").otherwise("DISCOVERY").alias("stage"), did.alias("status"), F.lit("").alias("query"), F.lit("").alias("attempted_at"))
        out.append((checks, attempts))
    return out


def _evidence(spark, checks: DataFrame, attempts: DataFrame) -> DataFrame:
    none = spark.createDataFrame([], "source_id string, provider string, work_id string, status string")
    return gaps.evidence(checks, none, attempts)


def _at(run: int) -> Column:
    return F.lit(f"2024-01-0{run + 1} 12:00:00").cast("timestamp")


_RUNS_SQL = """e AS (SELECT event_id AS k, user_id AS u, event_type AS t, event_id % 2 AS run FROM events WHERE (user_id % 5 <> 0 OR event_type <> 'purchase' OR event_id % 3 = 0) AND (user_id % 7 <> 0 OR event_id % 2 = 1)),
    r AS (SELECT u, run, bool_or(t = 'purchase' AND k % 8 = run) AS ok, count(*) FILTER (WHERE t = 'error' AND k % 40 < 2) AS fl, count(*) FILTER (WHERE t = 'error' AND k % 40 < 2 OR t = 'purchase' AND k % 8 = run) AS did, count(*) FILTER (WHERE t <> 'error' OR k % 40 < 2) AS n, max(k::VARCHAR) FILTER (WHERE t = 'error' AND k % 40 < 2) AS last FROM e GROUP BY u, run),
    a AS (SELECT u, fl AS count, CASE WHEN fl >= 3 THEN 'UNRESOLVABLE' ELSE 'OPEN' END AS status, n, CASE WHEN fl BETWEEN 1 AND 2 THEN '2024-01-02 12:00:00' END AS rest FROM r WHERE run = 0 AND NOT ok),
    b AS (SELECT coalesce(a.u, r.u) AS u, a.u IS NOT NULL AS known, a.status AS before, r.*, a.* EXCLUDE (u, status), r.u IS NOT NULL AND (NOT r.ok OR a.u IS NOT NULL) AS changed, r.n AS n2 FROM a FULL JOIN (SELECT * FROM r WHERE run = 1) r ON a.u = r.u)"""


@query(f"""WITH {_RUNS_SQL.replace('r.*, a.* EXCLUDE (u, status)', 'ok, fl, did, last, count, a.n AS n, rest')} SELECT 'gap-' || substr(sha256('["SOURCE_UNAVAILABLE","' || u || '"]'), 1, 24) AS gap_id, CASE WHEN NOT changed THEN before WHEN ok THEN 'RESOLVED' WHEN coalesce(count, 0) + fl >= 3 THEN 'UNRESOLVABLE' ELSE 'OPEN' END AS status,
    (coalesce(count, 0) + CASE WHEN changed THEN fl ELSE 0 END)::INTEGER AS attempt_count, CASE WHEN known THEN 'r0' ELSE 'r1' END AS first_seen_run, CASE WHEN NOT changed OR known AND did = 0 THEN 'r0' ELSE 'r1' END AS last_attempt_run, (coalesce(n, 0) + CASE WHEN changed THEN n2 ELSE 0 END)::INTEGER AS n_receipts,
    CASE WHEN NOT changed THEN rest WHEN ok OR coalesce(count, 0) + fl >= 3 THEN NULL WHEN fl > 0 THEN '2024-01-03 12:00:00' ELSE rest END AS cooldown FROM b WHERE known OR changed""")
def gap_runs(spark, d):
    """Gaps after two runs over all events."""
    prior = spark.createDataFrame([], gaps.GAP)
    for run, (checks, attempts) in enumerate(_runs(spark, d)):
        prior = spool(gaps.after_run(_evidence(spark, checks, attempts), prior, f"r{run}", _at(run)), "gaps")
    return prior.select("gap_id", "status", "attempt_count", "first_seen_run", "last_attempt_run", F.size("receipt_ids").alias("n_receipts"), F.date_format("cooldown_until", "yyyy-MM-dd HH:mm:ss").alias("cooldown"))


@query(f"""WITH {_RUNS_SQL.replace('r.*, a.* EXCLUDE (u, status)', 'ok, fl, did, last, count, a.n AS n, rest')}, g AS (SELECT *, 'gap-' || substr(sha256('["SOURCE_UNAVAILABLE","' || u || '"]'), 1, 24) AS gap_id FROM b WHERE before = 'OPEN' AND fl > 0)
    SELECT 'followup-' || substr(sha256('["' || gap_id || '","' || last || '"]'), 1, 24) AS followup_id, gap_id, 'PRIMARY_SOURCE_MISSING' AS trigger, u::VARCHAR AS query, 'FAILED' AS result, CASE WHEN ok THEN 'RESOLVED' ELSE 'STILL_OPEN' END AS outcome, CASE WHEN ok THEN 1 ELSE 0 END::INTEGER AS n_resolved FROM g""")
def gap_followups(spark, d):
    """What the second run's follow-ups of the first run's open gaps came to."""
    (checks, attempts), second = _runs(spark, d)
    first = gaps.after_run(_evidence(spark, checks, attempts), spark.createDataFrame([], gaps.GAP), "r0", _at(0))
    return gaps.followups(_evidence(spark, *second), first, _at(1)).select("followup_id", "gap_id", "trigger", "query", "result", "outcome", F.size("resolved_gap_ids").alias("n_resolved"))


@query("""WITH c AS (SELECT c_custkey AS k, 'gap-' || substr(sha256('["SOURCE_UNAVAILABLE","' || c_custkey || '"]'), 1, 24) AS g, 'gap-' || substr(sha256('["CONTENT_INACCESSIBLE","w' || c_custkey || '"]'), 1, 24) AS h, ['OPEN', 'RESOLVED', 'UNRESOLVABLE'][c_custkey % 3 + 1] AS status, c_custkey % 5 AS n FROM customer)
    SELECT 'failed_source_has_a_gap' AS rule, k::VARCHAR AS key, g AS detail FROM c WHERE k % 2 = 0 AND (k % 7 = 0 OR status = 'RESOLVED') UNION ALL SELECT 'failed_content_has_a_gap', 'w' || k, h FROM c WHERE k % 4 = 1 AND k % 11 = 0
    UNION ALL SELECT 'spent_gap_is_closed', g, status FROM c WHERE k % 7 <> 0 AND n >= 3 AND status = 'OPEN' UNION ALL SELECT 'unresolvable_gap_is_spent', g, n::VARCHAR FROM c WHERE k % 7 <> 0 AND n < 3 AND status = 'UNRESOLVABLE'""")
def backlog_violations(spark, d):
    c = keyed(spark, d, "customer", "c_custkey").withColumn("source_id", key().cast("string"))
    checks = c.select("source_id", F.when(every(4), "NOT_ATTEMPTED").when(every(2), "FAILED").otherwise("SUCCESS").alias("status"))
    access = c.select(nth(["openalex", "publisher", "formal", "pubmed"], key()).alias("provider"), named("w").alias("work_id"), F.when(every(4, 1), "FAILED").otherwise("SUCCESS").alias("status"))
    own = lambda kind, scope: gaps.stable_id("gap", F.lit(kind), scope).alias("gap_id")
    kept = c.where(~every(7)).select(own("SOURCE_UNAVAILABLE", F.col("source_id")), nth(["OPEN", "RESOLVED", "UNRESOLVABLE"], key()).alias("status"), (key() % 5).alias("attempt_count"), F.lit(3).alias("max_attempts"))
    more = c.where(~every(11)).select(own("CONTENT_INACCESSIBLE", named("w")), F.lit("OPEN").alias("status"), F.lit(0).cast("long").alias("attempt_count"), F.lit(3).alias("max_attempts"))
    return contract.backlog_rules(checks, access, kept.unionByName(more))


_STATES = ["SUCCESS", "FAILED", "PARTIAL", "NO_RESULTS"]
_ACCESS_SQL = f"""a AS (SELECT o_orderkey AS k, 'p' || o_custkey AS provider, {sql_nth(_STATES, 'o_orderkey')} AS status, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 3 = 0 END AS whole, o_orderkey % 10 AS feed, o_orderkey % 7 AS registry, o_orderkey % 17 AS win, CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END AS unusable, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 5 END AS asked, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 4 END AS got,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 11 - 1 END AS req, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 3 END AS res, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 12 = 0 END AS cached, CASE WHEN o_orderkey % 24 = 0 THEN 'e' ELSE '' END AS error FROM orders)"""


def _access(spark, d) -> DataFrame:
    o = keyed(spark, d, "orders", "o_orderkey", "o_custkey")
    known, pages = ~every(13), ~every(6)
    return o.select(
        key().alias("source_access_id"), named("p", F.col("o_custkey")).alias("provider"), nth(_STATES, key()).alias("status"), F.when(~every(9), every(3)).alias("retrieval_complete"), (key() % 10).alias("feed_entry_count"), (key() % 7).alias("registry_record_count"), (key() % 17).alias("window_record_count"), F.when(every(8), 1).otherwise(0).alias("unusable_record_count"),
        F.when(pages, key() % 5).alias("pages_requested"), F.when(pages, key() % 4).alias("pages_received"), F.when(known, key() % 11 - 1).alias("http_requests_attempted"), F.when(known, key() % 3).alias("http_responses_received"), F.when(known, every(12)).alias("cache_reused"), F.when(every(24), "e").otherwise("").alias("error"),
    )


@query(f"""WITH {_ACCESS_SQL}, i AS (SELECT * FROM a WHERE whole IS NOT NULL) SELECT 'incomplete_is_said' AS rule, k::VARCHAR AS key, status AS detail FROM i WHERE NOT whole AND status NOT IN ('FAILED', 'PARTIAL') UNION ALL SELECT 'complete_is_said', k::VARCHAR, status FROM i WHERE whole AND status IN ('FAILED', 'PARTIAL') UNION ALL SELECT 'unusable_is_incomplete', k::VARCHAR, '1' FROM i WHERE unusable > 0 AND whole
    UNION ALL SELECT 'window_within_inventory', k::VARCHAR, win::VARCHAR FROM i WHERE win > feed + registry UNION ALL SELECT 'inventory_pages', k::VARCHAR, got || '/' || asked FROM i WHERE asked IS NOT NULL AND (asked < 1 OR got > asked) UNION ALL SELECT 'complete_has_its_pages', k::VARCHAR, got || '/' || asked FROM i WHERE whole AND asked >= 1 AND got < asked
    UNION ALL SELECT 'inventory_is_one', provider, '' FROM i GROUP BY provider HAVING count(DISTINCT (whole, feed, registry, win, unusable, asked, got)) > 1""")
def inventory_violations(spark, d):
    return contract.inventory_rules(_access(spark, d))


@query(f"""WITH {_ACCESS_SQL}, h AS (SELECT *, res || '/' || req AS c, req >= 0 AND res <= req AS fine, status <> 'FAILED' AS done FROM a WHERE req IS NOT NULL) SELECT 'http_counts' AS rule, k::VARCHAR AS key, c AS detail FROM h WHERE NOT fine UNION ALL SELECT 'cache_asks_nothing', k::VARCHAR, c FROM h WHERE fine AND cached AND (req > 0 OR res > 0)
    UNION ALL SELECT 'cache_has_a_result', k::VARCHAR, status FROM h WHERE fine AND cached AND NOT done AND NOT coalesce(NOT whole AND error <> '', FALSE) UNION ALL SELECT 'done_has_a_response', k::VARCHAR, c FROM h WHERE fine AND NOT cached AND done AND (req < 1 OR res < 1) UNION ALL SELECT 'http_covers_the_inventory', k::VARCHAR, c FROM h WHERE fine AND NOT cached AND asked IS NOT NULL AND (req < asked OR res < got)""")
def http_violations(spark, d):
    return contract.http_rules(_access(spark, d))


@query("""WITH c AS (SELECT c_custkey AS k, 'gap' || c_custkey AS g, 'a' || c_custkey AS a, CASE WHEN c_custkey % 23 = 0 THEN 'x' || c_custkey ELSE 'followup-' || substr(sha256('["gap' || c_custkey || '","a' || c_custkey || '"]'), 1, 24) END AS id, c_custkey % 2 = 0 AS ok, c_custkey % 11 <> 0 AS gap, c_custkey % 13 <> 0 AS try FROM customer)
    SELECT 'followup_gap_was_there' AS rule, id AS key, g AS detail FROM c WHERE NOT gap OR k % 3 = 0 UNION ALL SELECT 'followup_was_made', id, a FROM c WHERE NOT try UNION ALL SELECT 'followup_stage', id, 'DISCOVERY' FROM c WHERE try AND k % 5 = 0 UNION ALL SELECT 'followup_in_the_ledger', id, a FROM c WHERE gap AND k % 7 = 0 UNION ALL SELECT 'followup_scope', id, 's' || k FROM c WHERE gap AND k % 17 = 0
    UNION ALL SELECT 'followup_trigger', id, 'NUMERIC_CONFLICT' FROM c WHERE gap AND k % 19 = 0 UNION ALL SELECT 'followup_names_its_work', id, 'z' FROM c WHERE gap AND k % 29 = 0 UNION ALL SELECT 'followup_source_backend_is_the_receipts', id, 'pubmed' FROM c WHERE try AND k % 31 = 0 UNION ALL SELECT 'followup_attempted_at_is_the_receipts', id, '2024' FROM c WHERE try AND k % 37 = 0
    UNION ALL SELECT 'followup_outcome', id, 'RESOLVED' FROM c WHERE try AND NOT ok AND k % 9 = 0 UNION ALL SELECT 'followup_outcome', id, 'STILL_OPEN' FROM c WHERE try AND ok AND k % 9 = 0 UNION ALL SELECT 'followup_resolves', id, '' FROM c WHERE try AND k % 8 = 0
    UNION ALL SELECT 'followup_id_stable', id, 'followup-' || substr(sha256('["' || g || '","' || a || '"]'), 1, 24) FROM c WHERE k % 23 = 0""")
def followup_violations(spark, d):
    c = keyed(spark, d, "customer", "c_custkey")
    good = every(2)
    known = c.where(~every(11)).select(named("gap").alias("gap_id"), F.lit("CONTENT_INACCESSIBLE").alias("gap_type"), F.lit("WORK").alias("scope_type"), F.when(every(17), "other").otherwise(named("s")).alias("scope_id"), F.when(every(3), "r1").otherwise("r0").alias("first_seen_run"), listed(named("a"), ~every(7)).alias("receipt_ids"))
    tries = c.where(~every(13)).select(named("a").alias("attempt_id"), F.when(every(31), "openalex").otherwise("pubmed").alias("source_id"), F.when(every(5), "DISCOVERY").otherwise("FOLLOWUP").alias("stage"), F.when(good, "SUCCESS").otherwise("FAILED").alias("status"), F.lit("q").alias("query"), F.when(every(37), "2025").otherwise("2024").alias("attempted_at"))
    own = contract.stable_id("followup", named("gap"), named("a"))
    rows = c.select(
        F.when(every(23), named("x")).otherwise(own).alias("followup_id"), named("gap").alias("gap_id"), F.when(every(19), "NUMERIC_CONFLICT").otherwise("FULLTEXT_MISSING").alias("trigger"), F.lit("WORK").alias("scope_type"), named("s").alias("scope_id"), F.when(every(29), "z").when(every(17), "other").otherwise(named("s")).alias("parent_candidate_id"), named("a").alias("attempt_id"),
        F.lit("q").alias("query"), F.lit("pubmed").alias("source_backend"), F.lit("2024").alias("attempted_at"), F.when(good, "SUCCESS").otherwise("FAILED").alias("result"), listed(named("gap"), good != every(8)).alias("resolved_gap_ids"), F.when(good != every(9), "RESOLVED").otherwise("STILL_OPEN").alias("outcome"),
    )
    return contract.followup_rules(rows, known, tries, "r1")


ORDER_SCHEMA = {
    "type": "object", "required": ["id", "status", "lines"], "additionalProperties": False,
    "properties": {"id": {"$ref": "#/$defs/id"}, "status": {"enum": ["O", "F", "P"]}, "price": {"type": "number", "minimum": 5000, "maximum": 480000}, "priority": {"oneOf": [{"type": "null"}, {"type": "string", "pattern": "^[1-5]-[A-Z ]+$"}]}, "lines": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 0}}}}},
    "$defs": {"id": {"type": "string", "minLength": 2, "pattern": "^o[0-9]+$"}},
}


@query("""WITH o AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders WHERE o_orderkey % 31 <> 0) SELECT 'schema' AS rule, o_orderkey::VARCHAR AS key, '$' AS path, 'is not JSON' AS detail FROM orders WHERE o_orderkey % 31 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$.id', 'does not match the pattern' FROM o WHERE k % 7 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$', 'lacks status' FROM o WHERE k % 11 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$', 'has extra' FROM o WHERE k % 13 = 0
    UNION ALL SELECT 'schema', k::VARCHAR, '$.price', 'is out of bounds' FROM o WHERE p NOT BETWEEN 5000 AND 480000 UNION ALL SELECT 'schema', k::VARCHAR, '$.priority', 'does not fit exactly one of oneOf' FROM o WHERE k % 17 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$.lines', 'is out of bounds' FROM o WHERE k % 4 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$.lines', 'repeats an item' FROM o WHERE k % 4 = 2
    UNION ALL SELECT 'schema', k::VARCHAR, '$.lines[' || i || ']', 'lacks n' FROM o, (VALUES (0), (1)) v(i) WHERE k % 4 = 3 AND k % 5 = 0 UNION ALL SELECT 'schema', k::VARCHAR, '$.lines[1].n', 'is not integer' FROM o WHERE k % 4 = 1""")
def document_schema(spark, d):
    """Orders as JSON documents, broken by the remainders of their keys, against a schema."""
    o = table(spark, d, "orders").withColumn("k", F.col("o_orderkey"))
    line = lambda n: F.concat(F.lit('{"n": '), n, F.lit("}"))
    text = key().cast("string")
    lines = F.when(every(4), "[]").when(every(4, 1), F.concat(F.lit("["), line(text), F.lit(', {"n": 1.5}]'))).when(every(4, 2), F.concat(F.lit("["), line(text), F.lit(", "), line(text), F.lit("]"))).when(every(5), '[{"m": 1}, {"m": 2}]').otherwise(F.concat(F.lit("["), line(text), F.lit("]")))
    member = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    body = F.concat(F.lit("{"), F.concat_ws(", ", member("id", F.concat(F.lit('"'), F.when(every(7), "x").otherwise("o"), text, F.lit('"'))), F.when(~every(11), member("status", F.concat(F.lit('"'), "o_orderstatus", F.lit('"')))), member("price", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        member("priority", F.when(every(17), "3").when(every(3), "null").otherwise(F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))), member("lines", lines), F.when(every(13), F.lit('"extra": 1'))), F.when(every(31), "").otherwise("}"))
    return json_schema.violations(o.select(key().alias("key"), body.alias("body")), ORDER_SCHEMA)


_LEVEL = "SELECT {n} AS level, node // 256 AS node, sha256(string_agg((node % 256) || ':' || digest, ',' ORDER BY node)) AS digest FROM l{m} WHERE (SELECT max(node) FROM l{m}) > 0 GROUP BY node // 256"


@query(f"""WITH l0 AS (SELECT 0 AS level, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS node, sha256('["' || o_orderkey || '","' || o_orderstatus || '"]') AS digest FROM orders), {', '.join(f'l{n} AS ({_LEVEL.format(n=n, m=n - 1)})' for n in (1, 2, 3))}
    SELECT level::INTEGER AS level, node::BIGINT AS node, digest FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)""")
def request_digest(spark, d):
    """The digest tree over all orders by date."""
    rows = digests.numbered(table(spark, d, "orders"), "o_orderdate", "o_orderkey")
    return digests.tree(rows, "place", F.col("o_orderkey").cast("string"), "o_orderstatus").select(F.col("level").cast("int").alias("level"), "node", "digest")


@query("""WITH RECURSIVE r(k, w) AS (SELECT o_orderkey, o_orderkey // 2 FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey > 0 UNION ALL SELECT k, w // 2 FROM r WHERE w % 2 = 0) SELECT 'w' || k AS old_id, 'w' || w AS work_id FROM r WHERE w % 2 = 1""")
def id_chains(spark, d):
    """Even orders succeeded by their halves, generation after generation."""
    o = keyed(spark, d, "orders", "o_orderkey").where(every(2) & (key() > 0))
    return state.resolved_ids(o.select(named("w").alias("old_id"), named("w", F.floor(key() / 2)).alias("work_id")))


#: Papers of every branch of the study rules: title (# is a number) and publication type.
PAPERS = (
    ("Reply to a note on athletes #", "letter"),
    ("Study protocol for a trial in athletes #", "article"),
    ("Running and athletes #", "retracted publication"),
    ("A scoping review of athletes #", "article"),
    ("A mouse model of training # for muscle", "article"),
    ("A systematic review of training in rats #", "article"),
    ("A quasi-experimental study of athletes #", "article"),
    ("A retrospective look at athletes #", "article"),
    ("A cross-sectional look at athletes #", "article"),
    ("A meta-analysis of athletes #", "article"),
    ("Training of athletes #", "systematic review"),
    ("Training of athletes #", "practice guideline"),
    ("A consensus statement on athletes #", "article"),
    ("Training of athletes #", "randomized controlled trial"),
    ("A field study of athletes #", "article"),
    ("A longitudinal look at athletes #", "article"),
    ("A cohort of athletes #", "article"),
    ("A crossover look at athletes #", "article"),
    ("A qualitative look at athletes #", "article"),
    ("A questionnaire for athletes #", "article"),
    ("Training of athletes #", "review"),
    ("Training of athletes #", "article"),
    ("Cooking at home #", "article"),
)
_BONUS = "CASE WHEN design IN ('Guideline', 'Consensus statement', 'Meta-analysis', 'Systematic review') THEN 25 WHEN design IN ('Randomized controlled trial', 'Field experiment', 'Longitudinal study') THEN 18 ELSE 0 END"


@query("""WITH p AS (SELECT doc_id, doc_id % 23 AS i, doc_id % 5 = 0 AS pre, 50 + doc_id * 13 AS n FROM documents),
    s AS (SELECT *, CASE WHEN pre AND i IN (21, 22) THEN 'Preprint' ELSE ['Correspondence', 'Protocol', 'Correspondence', 'Scoping review', 'Preclinical study', 'Preclinical study', 'Quasi-experimental study', 'Cohort study', 'Cross-sectional study', 'Meta-analysis', 'Systematic review', 'Guideline', 'Consensus statement', 'Randomized controlled trial', 'Field experiment', 'Longitudinal study', 'Cohort study', 'Crossover study', 'Qualitative study', 'Survey', 'Narrative review', 'Other', 'Other'][i + 1] END AS design,
        CASE WHEN pre AND i IN (21, 22) THEN 35 ELSE [12, 25, 12, 55, 40, 40, 64, 70, 50, 95, 90, 92, 78, 88, 82, 78, 72, 70, 65, 48, 58, 38, 38][i + 1] END AS evidence, CASE WHEN i IN (5, 22) THEN 0 WHEN i = 4 THEN 62 ELSE 73 END AS relevance FROM p),
    t AS (SELECT *, 43 + CASE WHEN n >= 10000 THEN 15 WHEN n >= 1000 THEN 10 WHEN n >= 200 THEN 5 ELSE 0 END + CASE WHEN evidence >= 85 THEN 5 ELSE 0 END + CASE WHEN i = 15 THEN 10 ELSE 0 END AS interest, 40 + CASE WHEN i IN (4, 5, 10, 11, 13, 20, 21) THEN 4 ELSE 0 END + """ + _BONUS + """ AS practical FROM s)
    SELECT doc_id, design AS study_design, evidence::INTEGER AS evidence_score, relevance::INTEGER AS relevance_score, interest::INTEGER AS interest_score, practical::INTEGER AS practical_score, round(0.4 * evidence + 0.3 * relevance + 0.2 * interest + 0.1 * practical, 1)::DOUBLE AS total_score,
    CASE WHEN i IN (0, 2) THEN 'correspondence/editorial' WHEN i = 1 THEN 'protocol/design paper' WHEN relevance = 0 THEN 'title-primary stream relevance gate failed' END AS exclusion,
    CASE WHEN pre THEN 'NOT_PEER_REVIEWED' ELSE CASE design WHEN 'Meta-analysis' THEN 'STUDY_QUALITY_AND_HETEROGENEITY' WHEN 'Systematic review' THEN 'SEARCH_AND_BIAS' WHEN 'Randomized controlled trial' THEN 'RANDOMISATION_AND_ENDPOINTS' WHEN 'Cohort study' THEN 'RESIDUAL_CONFOUNDING' WHEN 'Longitudinal study' THEN 'ATTRITION_AND_BASELINE' WHEN 'Cross-sectional study' THEN 'NO_TEMPORAL_ORDER' WHEN 'Survey' THEN 'SAMPLING_AND_SELF_REPORT' WHEN 'Qualitative study' THEN 'NOT_GENERALISABLE' ELSE 'AUTOMATIC_SCREENING_ONLY' END END AS caveat FROM t""")
def paper_studies(spark, d):
    """Papers of every branch of the study rules with their scores, exclusions and caveats."""
    n = F.col("doc_id")
    rows = docs(spark, d, "doc_id").select(
        "doc_id", F.replace(nth([p[0] for p in PAPERS], n), F.lit("#"), n.cast("string")).alias("title"), F.concat(F.lit("n = "), (50 + n * 13).cast("string")).alias("abstract"), F.lit("Some journal").alias("journal_or_venue"), F.lit("sport_science").alias("stream"), F.array().cast("array<string>").alias("secondary_streams"), F.lit("pubmed").alias("source"),
        F.array(nth([p[1] for p in PAPERS], n)).alias("publication_types"), (n % 5 == 0).alias("is_preprint"), F.lit(None).cast("boolean").alias("open_access"), F.array().cast("array<string>").alias("repository_versions"),
    )
    scored = score.paper_scores(rows, ["athletes"])
    return scored.select("doc_id", "study_design", "evidence_score", "relevance_score", "interest_score", "practical_score", "total_score", classify.exclusion_reason().alias("exclusion"), classify.caveat().alias("caveat"))


@query("""WITH c AS (SELECT doc_id, lang, doc_id % 9 = 0 AS best, row_number() OVER (ORDER BY lang, doc_id % 9 <> 0, doc_id) - 1 AS place FROM documents), x AS (SELECT *, min(place) OVER (PARTITION BY lang) AS first, count(*) OVER (PARTITION BY lang) AS n, count(*) OVER () AS total FROM c),
    b AS (SELECT lang, first, n, total, (place - first) // 500 AS block, count(*) AS n_cards, string_agg('<article data-work-id="w' || doc_id || '" data-triage="" data-event-class="" data-oa="" data-sources="" data-featured="' || best || '"><h3>A &amp; &quot;' || doc_id || '&quot; &lt;b&gt; it&#x27;s</h3><p></p></article>', chr(10) ORDER BY place) AS cards FROM x GROUP BY ALL)
    SELECT row_number() OVER (ORDER BY first + block * 500) - 1 AS part, lang AS category, n_cards, sha256(CASE WHEN block = 0 THEN CASE WHEN first > 0 THEN '</section>' ELSE '' END || '<section data-category="' || lang || '"><h2>' || lang || '</h2>' || chr(10) ELSE '' END || cards || CASE WHEN (block + 1) * 500 >= n AND first + n = total THEN chr(10) || '</section>' ELSE '' END) AS sha256 FROM b""")
def report_parts(spark, d):
    """A report of all documents, a card each, in parts of 500."""
    n = F.col("doc_id")
    rows = docs(spark, d, "doc_id", "lang").select(named("w", n).alias("work_id"), F.col("lang").alias("category"), F.lit(0).alias("category_rank"), n.alias("display_rank"), F.concat(F.lit('A & "'), n.cast("string"), F.lit('" <b> it\'s')).alias("title"), F.lit(None).cast("string").alias("venue"))
    return pages.parts(rows, rows.where("display_rank % 9 = 0")).select("part", "category", "n_cards", "sha256")
