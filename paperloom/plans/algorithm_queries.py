"""Queries over operators whose answer depends on an order or a chain: probes with feedback, bridges in the order of titles.

Rows of the test tables carry the cases; remainders of keys decide which case a row is.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators import rank, resolve
from paperloom.plans.bindings import docs, query
from paperloom.session import table
from paperloom.sources import payloads


def _answer(url: str) -> int:
    """Stands for a request: every third url's length blocks, every third fails."""
    return (403, 500, 200)[len(url) % 3]


@query("""WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, [403, 500, 200][length(url) % 3 + 1] AS code FROM pages), q AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS k, coalesce(bool_or(code = 403) OVER (PARTITION BY host ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS shut FROM p)
    SELECT page_id, row_number() OVER (ORDER BY page_id)::INTEGER AS attempt, CASE WHEN code < 400 THEN 'SUCCESS' ELSE 'FAILED' END AS status, code::INTEGER AS http_status FROM q WHERE k <= 3 AND NOT shut ORDER BY page_id LIMIT 150""")
def probe_feedback(spark, d):
    """The pages that a budget of 150 requests, three a host, reaches if every third page blocks its host."""
    rows = table(spark, d, "pages").select("page_id", "url")
    return rank.probe(rows, _answer, 150, 3, url="url", order="page_id").select("page_id", "attempt", "status", "http_status")


#: Observations that a document stands for, by the remainder of its id by 4: (title, day, doi, pmid, pmcid, authors), # is the id.
BRIDGES = (
    (("early", 1, "10.1/#", "", "", "A"), ("early", 1, "", "p#", "", "A"), ("early", 2, "", "", "PMC#", "A")),  # of two that agree on a day, and one that doesn't, none is bridged
    (("early", 1, "10.1/#", "", "", "A"), ("early", 1, "10.2/#", "", "", "A"), ("early", 1, "", "p#", "", "A")),  # two DOIs contradict each other
    (("early", 1, "10.1/#", "", "", "A"), ("later", 1, "10.1/#", "", "", "A"), ("early", 1, "", "p#", "", "A"), ("later", 2, "", "p#", "", "A"), ("later", 1, "", "", "PMC#", "A")),  # the early title opens the later one
    (("early", 1, "10.1/#", "", "", "A"), ("early", 1, "", "p#", "", "A"), ("later", 1, "", "p#", "", "A"), ("later", 1, "10.2/#", "", "", "A"), ("later", 1, "", "", "", "")),  # the early title closes the later one
)


@query("""SELECT unnest(CASE doc_id % 4 WHEN 0 THEN ['doi:10.1/' || doc_id, 'pmid:p' || doc_id, 'pmcid:pmc' || doc_id] WHEN 1 THEN ['doi:10.1/' || doc_id, 'doi:10.2/' || doc_id, 'pmid:p' || doc_id] WHEN 2 THEN ['doi:10.1/' || doc_id] ELSE ['doi:10.1/' || doc_id, 'doi:10.2/' || doc_id, ''] END) AS work,
    unnest(CASE doc_id % 4 WHEN 2 THEN [5] WHEN 3 THEN [3, 1, 1] ELSE [1, 1, 1] END)::BIGINT AS n_observations, unnest(CASE doc_id % 4 WHEN 0 THEN ['', 'p' || doc_id, ''] WHEN 1 THEN ['', '', 'p' || doc_id] WHEN 2 THEN ['p' || doc_id] ELSE ['p' || doc_id, '', ''] END) AS pmid FROM documents""")
def works_bridged(spark, d):
    """Works from three to five observations a document, through every branch of the rule on titles."""
    one = lambda o: F.struct(*[F.lit(v).alias(k) for k, v in zip(("title", "day", "doi", "pmid", "pmcid", "author"), o, strict=True)])
    cases = F.element_at(F.array(*[F.array(*map(one, c)) for c in BRIDGES]), (F.col("doc_id") % 4).cast("int") + 1)
    rows = docs(spark, d, "doc_id").select("doc_id", F.explode(cases).alias("o"))
    named = lambda c: F.replace(F.col(f"o.{c}"), F.lit("#"), F.col("doc_id").cast("string"))
    rows = rows.select(
        F.concat(F.lit("The "), F.col("o.title"), F.lit(" report on the effects of number "), F.col("doc_id").cast("string")).alias("title"), F.lit("s").alias("stream"), F.lit("c").alias("category"), F.lit("publisher").alias("source"),
        F.concat(F.lit("2024-01-0"), F.col("o.day").cast("string")).alias("publication_date"), F.filter(F.array("o.author"), lambda a: a != "").alias("authors"), *[named(c).alias(c) for c in ("doi", "pmid", "pmcid")],
    )
    found = resolve.deduplicate(payloads.as_candidates(rows))
    work = F.when(F.concat("doi", "pmid", "pmcid") == "", "").otherwise(F.lower("work_id"))
    return found.select(work.alias("work"), "n_observations", "pmid")
