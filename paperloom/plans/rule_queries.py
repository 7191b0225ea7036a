"""Queries that hold rows made of the test tables against the integrity rules, with the SQL that says what they violate.

Remainders of keys decide which rows break a rule.  All queries give (rule, key, detail).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import normalize, text
from paperloom.functions.ids import stable_id
from paperloom.operators import rules
from paperloom.plans.bindings import docs, joined, nth, query, sql_nth
from paperloom.schema import LOCATION
from paperloom.session import table
from paperloom.sources.inventory import is_public_url


def keyed(spark: SparkSession, d: str, name: str, key: str, *more: str) -> DataFrame:
    """A table's key as ``k``."""
    return table(spark, d, name).select(F.col(key).alias("k"), *more)


def every(n: int, rest: int = 0) -> Column:
    return F.col("k") % n == rest


def strings(*values: str) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def number() -> Column:
    return F.col("k").cast("string")


@query("""WITH w AS (SELECT p_partkey AS k, CASE WHEN k % 7 = 0 THEN 'novel' ELSE 'journal_article' END AS t, CASE WHEN k % 5 = 0 THEN ['review', 'clinical_trial'] WHEN k % 11 = 0 THEN ['made_up'] WHEN k % 2 = 0 THEN ['clinical_trial'] ELSE [] END AS s, CASE WHEN k % 13 = 0 THEN 'UNKNOWN' ELSE 'TITLE' END AS b FROM part)
    SELECT 'document_type_known' AS rule, k::VARCHAR AS key, t AS detail FROM w WHERE t = 'novel' UNION ALL SELECT 'study_designs_sorted', k::VARCHAR, '' FROM w WHERE k % 5 = 0 UNION ALL SELECT 'study_designs_known', k::VARCHAR, '' FROM w WHERE s = ['made_up']
    UNION ALL SELECT 'study_basis_iff_designs', k::VARCHAR, b FROM w WHERE (b = 'UNKNOWN') <> (len(s) = 0) UNION ALL SELECT 'document_basis_iff_type', k::VARCHAR, 'UNKNOWN' FROM w WHERE k % 17 = 0""")
def study_violations(spark, d):
    designs = F.when(every(5), strings("review", "clinical_trial")).when(every(11), strings("made_up")).when(every(2), strings("clinical_trial")).otherwise(strings())
    w = keyed(spark, d, "part", "p_partkey").withColumns({"work_id": F.col("k"), "document_type": F.when(every(7), "novel").otherwise("journal_article"), "study_designs": designs, "study_design_basis": F.when(every(13), "UNKNOWN").otherwise("TITLE"), "document_type_basis": F.when(every(17), "UNKNOWN").otherwise("PROVIDER")})
    return rules.study_rules(w)


@query("""WITH a AS (SELECT c_custkey AS k, CASE WHEN k % 2 = 0 THEN ['u1'] ELSE [] END AS urls, CASE WHEN k % 3 = 0 THEN 'u1' WHEN k % 7 = 0 THEN 'u2' END AS loc, k % 3 = 0 AS opened, ['ACCESSIBLE', 'BLOCKED', 'NOT_CHECKED', 'OPEN'][k % 4 + 1] AS s, ['YES', 'NO', 'UNKNOWN', 'MAYBE', 'YES'][k % 5 + 1] AS oa,
    CASE WHEN k % 11 = 0 OR k % 2 = 1 THEN 'UNKNOWN' ELSE 'NOT_CHECKED' END AS f FROM customer)
    SELECT 'access_status_known' AS rule, k::VARCHAR AS key, s AS detail FROM a WHERE s = 'OPEN' UNION ALL SELECT 'oa_status_known', k::VARCHAR, oa FROM a WHERE oa = 'MAYBE' UNION ALL SELECT 'accessible_needs_location', k::VARCHAR, '' FROM a WHERE s = 'ACCESSIBLE' AND NOT opened
    UNION ALL SELECT 'fulltext_unknown_iff_no_url', k::VARCHAR, f FROM a WHERE (len(urls) = 0) <> (f = 'UNKNOWN') UNION ALL SELECT 'locations_are_download_urls', k::VARCHAR, '' FROM a WHERE loc IS NOT NULL AND NOT list_contains(urls, loc)""")
def access_violations(spark, d):
    place = lambda u, s: F.array(F.struct(*[F.lit(v).alias(c) for c, v in (("url", u), ("kind", "PDF"), ("host_type", "publisher"), ("access_status", s), ("reason", ""))])).cast(f"array<{LOCATION}>")
    a = keyed(spark, d, "customer", "c_custkey").withColumns({
        "work_id": F.col("k"), "download_urls": F.when(every(2), strings("u1")).otherwise(strings()), "fulltext_locations": F.when(every(3), place("u1", "ACCESSIBLE")).when(every(7), place("u2", "BLOCKED")).otherwise(F.array().cast(f"array<{LOCATION}>")),
        "access_status": nth(["ACCESSIBLE", "BLOCKED", "NOT_CHECKED", "OPEN"], F.col("k")), "oa_status": nth(["YES", "NO", "UNKNOWN", "MAYBE", "YES"], F.col("k")), "fulltext_access_status": F.when(every(11) | every(2, 1), "UNKNOWN").otherwise("NOT_CHECKED"),
    })
    return rules.access_rules(a)


TRIAGED = "['PRIORITY', 'REVIEW_REQUIRED', 'LOWER_PRIORITY', 'MAYBE'][k % 4 + 1]"


@query(f"""WITH o AS (SELECT o_orderkey AS k, {TRIAGED} AS t FROM orders), l AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE k % 50 = 0)
    SELECT 'work_id_unique' AS rule, k::VARCHAR AS key, '2' AS detail FROM o WHERE k % 50 = 0 UNION ALL SELECT 'triage_known', k::VARCHAR, t FROM l WHERE t = 'MAYBE' UNION ALL SELECT 'reasons_sorted', k::VARCHAR, '' FROM l WHERE k % 6 = 0
    UNION ALL SELECT 'priority_has_event', k::VARCHAR, '' FROM l WHERE t = 'PRIORITY' AND k % 3 = 0 UNION ALL SELECT 'score_in_range', k::VARCHAR, (k % 110)::VARCHAR FROM l WHERE k % 110 > 100""")
def ledger_violations(spark, d):
    o = keyed(spark, d, "orders", "o_orderkey")
    ledger = o.unionByName(o.where(every(50))).withColumns({"work_id": F.col("k"), "triage_status": nth(["PRIORITY", "REVIEW_REQUIRED", "LOWER_PRIORITY", "MAYBE"], F.col("k")), "triage_reasons": F.when(every(6), strings("b", "a")).otherwise(strings("a", "b")), "event_status": F.when(every(3), "NO_QUALIFYING_EVENT").otherwise("QUALIFYING"), "score": F.col("k") % 110})
    return rules.ledger_rules(ledger)


@query("""WITH s AS (SELECT s_suppkey AS k, 'https://j.org/' || k || CASE WHEN k % 9 = 0 THEN '/?utm_source=x' ELSE '' END AS url, 'src-' || substr(sha256('["' || url || '"]'), 1, 24) AS made, CASE WHEN k % 8 = 0 THEN 'src-bad' || k ELSE made END AS id FROM supplier)
    SELECT 'source_url_canonical' AS rule, id AS key, url AS detail FROM s WHERE k % 9 = 0 UNION ALL SELECT 'source_id_stable', id, made FROM s WHERE k % 8 = 0 UNION ALL SELECT 'source_work_known', k::VARCHAR, 'unknown' FROM s WHERE k % 6 = 0
    UNION ALL SELECT 'source_type_fits', id, 'publisher' FROM s WHERE k % 10 = 0 UNION ALL SELECT DISTINCT 'observation_source_known', 'src-none' || (k % 3), 'unknown' FROM s""")
def registry_violations(spark, d):
    s = keyed(spark, d, "supplier", "s_suppkey").withColumn("url", F.concat(F.lit("https://j.org/"), number(), F.when(every(9), "/?utm_source=x").otherwise("")))
    registry = s.select(F.when(every(8), F.concat(F.lit("src-bad"), number())).otherwise(stable_id("src", F.col("url"))).alias("source_id"), "url", F.col("k").alias("work_id"), F.lit("publisher").alias("source_type"), F.when(every(10), "DISCOVERY_ONLY").otherwise("FORMAL_PUBLICATION").alias("source_role"))
    seen = s.select(F.concat(F.lit("src-none"), (F.col("k") % 3).cast("string")).alias("source_id"))
    return rules.registry_rules(registry, seen, s.where(~every(6)).select(F.col("k").alias("work_id")))


@query("""WITH r AS (SELECT o_orderkey AS k, ['SUCCESS', 'FAILED', 'NOT_ATTEMPTED', 'PARTIAL'][k // 5 % 4 + 1] AS s FROM orders), a AS (SELECT *, s <> 'SUCCESS' AS bad, (s <> 'SUCCESS' AND k % 7 <> 0) OR k % 11 = 0 AS err FROM r)
    SELECT 'pages_in_order' AS rule, k::VARCHAR AS key, '' AS detail FROM a WHERE k % 4 > k % 3 UNION ALL SELECT 'not_attempted_asks_nothing', k::VARCHAR, '' FROM a WHERE s = 'NOT_ATTEMPTED' AND k % 3 > 0 UNION ALL SELECT 'error_iff_failed', k::VARCHAR, s FROM a WHERE bad <> err
    UNION ALL SELECT 'failed_has_no_results', k::VARCHAR, '1' FROM a WHERE s IN ('FAILED', 'NOT_ATTEMPTED') AND k % 2 = 1 UNION ALL SELECT 'fingerprint_is_sha256', k::VARCHAR, '' FROM a WHERE k % 13 = 0""")
def receipt_violations(spark, d):
    status = nth(["SUCCESS", "FAILED", "NOT_ATTEMPTED", "PARTIAL"], F.floor(F.col("k") / 5))
    r = keyed(spark, d, "orders", "o_orderkey").withColumn("status", status)
    return rules.receipt_rules(r.withColumns({"attempt_id": F.col("k"), "pages_received": F.col("k") % 4, "pages_requested": F.col("k") % 3, "error_class": F.when(((F.col("status") != "SUCCESS") & ~every(7)) | every(11), "E"), "result_count": F.col("k") % 2, "request_fingerprint": F.when(every(13), "x").otherwise(F.sha2(number(), 256))}))


@query("""WITH b AS (SELECT o_orderkey AS k, o_custkey AS c, k % 5 AS depth FROM orders), s AS (SELECT c_custkey AS c, c_custkey % 5 AS depth, c_custkey % 3 <> 1 AS direct FROM customer WHERE c_custkey % 15 <> 0)
    SELECT DISTINCT 'binding_source_known' AS rule, c::VARCHAR AS key, 'unknown' AS detail FROM b WHERE c NOT IN (SELECT c FROM s) UNION ALL SELECT 'binding_claim_known', k::VARCHAR, 'unknown' FROM b WHERE k % 20 = 5 UNION ALL SELECT 'inference_claim_known', k::VARCHAR, 'unknown' FROM b WHERE k % 40 = 5
    UNION ALL SELECT 'claim_sources_are_bindings', k::VARCHAR, '' FROM b WHERE k % 20 <> 5 AND k % 10 = 0 UNION ALL SELECT 'supported_needs_full_text', k::VARCHAR, '' FROM b WHERE k % 20 <> 5 AND k % 3 = 0 AND c NOT IN (SELECT c FROM s WHERE depth = 4 AND direct)
    UNION ALL SELECT 'binding_deeper_than_access', k::VARCHAR, c::VARCHAR FROM b JOIN s USING (c) WHERE b.depth > s.depth""")
def claim_violations(spark, d):
    depths = ["NONE", "METADATA", "LANDING_PAGE", "ABSTRACT", "FULL_TEXT"]
    o, c = keyed(spark, d, "orders", "o_orderkey", "o_custkey"), keyed(spark, d, "customer", "c_custkey").where(~every(15))
    claims = o.where(~every(20, 5)).select(F.col("k").alias("claim_id"), F.lit("EFFECT").alias("kind"), F.when(every(3), "SUPPORTED").otherwise("PARTIAL").alias("status"), F.when(every(10), F.array().cast("array<bigint>")).otherwise(F.array(F.col("o_custkey").cast("long"))).cast("array<string>").alias("source_ids"))
    bindings = o.select(F.col("k").alias("claim_id"), F.col("o_custkey").cast("string").alias("source_id"), nth(depths, F.col("k")).alias("depth"))
    sources = c.select(number().alias("source_id"), nth(["PRIMARY_RESEARCH", "DISCOVERY_ONLY", "FORMAL_PUBLICATION"], F.col("k")).alias("source_role"), nth(depths, F.col("k")).alias("access_depth"))
    return rules.claim_rules(claims, bindings, sources, o.where(every(40, 5)).select(F.lit("i").alias("inference_id"), F.col("k").alias("claim_id")))


@query("""SELECT 'attempts_in_limit' AS rule, o_orderkey::VARCHAR AS key, '5' AS detail FROM orders WHERE o_orderkey % 6 = 5 UNION ALL SELECT 'resolved_has_receipt', o_orderkey::VARCHAR, 'RESOLVED' FROM orders WHERE o_orderkey % 6 = 3
    UNION ALL SELECT DISTINCT 'gap_receipt_known', o_custkey::VARCHAR, 'unknown' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 15 <> 0) UNION ALL SELECT 'relation_not_to_itself', 'workrel-' || substr(sha256('["' || s_suppkey || '","' || s_suppkey || '","NEW_VERSION"]'), 1, 24), '' FROM supplier WHERE s_suppkey % 10 = 0 AND s_suppkey % 7 <> 0
    UNION ALL SELECT 'relation_not_to_itself', 'x' || s_suppkey, '' FROM supplier WHERE s_suppkey % 70 = 0
    UNION ALL SELECT 'relation_id_stable', 'x' || s_suppkey, 'workrel-' || substr(sha256('["' || s_suppkey || '","' || CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey ELSE s_suppkey + 1 END || '","NEW_VERSION"]'), 1, 24) FROM supplier WHERE s_suppkey % 7 = 0""")
def gap_and_relation_violations(spark, d):
    o, c, s = keyed(spark, d, "orders", "o_orderkey", "o_custkey"), keyed(spark, d, "customer", "c_custkey").where(~every(15)), keyed(spark, d, "supplier", "s_suppkey")
    gaps = o.select(F.col("k").alias("gap_id"), (F.col("k") % 6).alias("attempt_count"), F.lit(4).alias("max_attempts"), F.when(every(3), "RESOLVED").otherwise("OPEN").alias("status"), F.when(every(6), "r").alias("resolution_receipt_id"), F.array(F.col("o_custkey").cast("string")).alias("receipt_ids"))
    ends = s.withColumns({"from_work_id": number(), "to_work_id": (F.col("k") + F.when(every(10), 0).otherwise(1)).cast("string"), "relation_type": F.lit("NEW_VERSION")})
    made = stable_id("workrel", F.col("from_work_id"), F.col("to_work_id"), F.col("relation_type"))
    return rules.gap_rules(gaps, c.select(number().alias("attempt_id"))).unionByName(rules.relation_rules(ends.withColumn("relation_id", F.when(every(7), F.concat(F.lit("x"), number())).otherwise(made))))


@query("""SELECT 'marker_unique' AS rule, page_id::VARCHAR AS key, '2' AS detail FROM pages WHERE page_id % 5 = 0 AND page_id % 3 <> 0 UNION ALL SELECT 'marker_known', page_id::VARCHAR, 'unknown' FROM pages WHERE page_id % 3 <> 0 AND page_id % 7 = 0 UNION ALL SELECT 'marker_missing', page_id::VARCHAR, 'unknown' FROM pages WHERE page_id % 3 = 0 AND page_id % 7 <> 0
    UNION ALL SELECT 'inventory_window', o_orderkey::VARCHAR, 'https://x/works?filter=from-pub-date:' || strftime(o_orderdate, '%Y-%m-%d') || ',until-pub-date:1996-12-31' FROM orders WHERE o_orderkey % 2 = 0 AND strftime(o_orderdate, '%Y-%m-%d') <> '1996-01-02'""")
def marker_violations(spark, d):
    """Pages that show their own id, twice or not at all; inventories whose window starts on an order's day."""
    p, o = keyed(spark, d, "pages", "page_id", "html"), keyed(spark, d, "orders", "o_orderkey", "o_orderdate")
    mark = F.concat(F.lit('<article data-work-id="'), number(), F.lit('">'))
    html = p.select(F.col("k").alias("report_id"), F.concat(F.when(every(3), "").otherwise(mark), "html", F.when(every(5) & ~every(3), mark).otherwise("")).alias("html"))
    dated = F.concat(F.lit("https://x/works?filter=from-pub-date:"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(",until-pub-date:1996-12-31"))
    urls = o.select(F.col("k").alias("source_access_id"), F.when(every(2), dated).otherwise("https://x/works").alias("url"))
    return rules.marker_rules(html, p.where(~every(7)).select(number().alias("work_id"))).unionByName(rules.inventory_url_rules(urls, ("1996-01-02", "1996-12-31")))


@query("""SELECT 'title_present' AS rule, c_custkey::VARCHAR AS key, '' AS detail FROM customer WHERE c_custkey % 12 = 0 UNION ALL SELECT 'last_seen_at_present', c_custkey::VARCHAR, '' FROM customer WHERE c_custkey % 9 = 0 UNION ALL SELECT 'seen_in_order', c_custkey::VARCHAR, '' FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 9 = 0""")
def state_violations(spark, d):
    w = keyed(spark, d, "customer", "c_custkey", "c_name").select(F.col("k").alias("work_id"), F.when(every(12), "").otherwise(F.col("c_name")).alias("title"), F.lit("2024-01-02").alias("first_seen_at"), F.when(every(9), F.lit(None)).when(every(5), "2024-01-01").otherwise("2024-01-02").alias("last_seen_at"))
    return rules.state_shape(w)


URLS = ["https://j.org/1", "http://127.0.0.1/x", "https://user@j.org/", "ftp://j.org/x", "https://localhost/x", "https://10.1.2.3/x", "https://j.org:8443/x", "https://192.168.0.1/x", "http://www.j.org/a?b"]


@query(f"SELECT page_id, {sql_nth(URLS, 'page_id')} AS url, page_id % 9 IN (0, 8) AS public FROM pages")
def public_urls(spark, d):
    rows = keyed(spark, d, "pages", "page_id").select(F.col("k").alias("page_id"), nth(URLS, F.col("k")).alias("url"))
    return rows.withColumn("public", is_public_url(F.col("url")))


@query("SELECT doc_id, doc_id % 4 = 0 AS ok FROM documents")
def translated_titles(spark, d):
    """Titles translated, left in English, without their number, or with a filler phrase."""
    n = F.col("doc_id").cast("string")
    out = F.element_at(F.array(F.concat(n, F.lit(" 名成人的試驗")), F.concat(F.lit("Trial of "), n, F.lit(" adults")), F.lit("成人的試驗"), F.concat(n, F.lit(" 名成人 Placeholder"))), (F.col("doc_id") % 4).cast("int") + 1)
    return docs(spark, d, "doc_id").select("doc_id", text.title_translation_ok(F.concat(F.lit("Trial of "), n, F.lit(" adults")), out, ("placeholder",)).alias("ok"))


@query("""SELECT doc_id, 'k' || doc_id || '|old|' || CASE WHEN doc_id % 2 = 0 THEN 'doi:10.1000/a' || doc_id || '|' ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN 'pmid:' || doc_id || '|' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN 'openalex:w' || doc_id || '|' ELSE '' END || 'title:' || sha1('the work no ' || doc_id) AS aliases FROM documents""")
def paper_aliases(spark, d):
    n = F.col("doc_id").cast("string")
    rows = docs(spark, d, "doc_id").withColumns({"title": F.concat(F.lit("The Work: no. "), n, F.lit("!")), "doi": F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://doi.org/10.1000/A"), n)), "pmid": F.when(F.col("doc_id") % 3 == 0, n).otherwise(""), "pmcid": F.lit(""), "openalex_id": F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("https://openalex.org/W"), n))})
    return rows.select("doc_id", joined(normalize.record_aliases(F.concat(F.lit("k"), n), F.array(F.lit("old")))).alias("aliases"))
