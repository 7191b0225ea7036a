"""Queries against their SQL on rows that the test tables don't have."""

import html
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from paperloom.functions import normalize, text
from paperloom.operators import contract, json_schema, resolve, rules
from paperloom.plans import algorithm_queries, bindings, contract_queries, payload_queries, rule_queries  # noqa: F401 - the others add their queries to the first's
from paperloom.schema import IDENTIFIERS
from paperloom.sources import payloads


def same_as_sql(spark, folder, query, **tables):
    """Whether a query and its SQL agree on tables of these rows."""
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    got = bindings.QUERIES[query](spark, str(folder))
    cols = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"SELECT {cols} FROM ({bindings.SQL[query]})").fetchall()
    clean = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)
    assert clean(got.collect()) == clean(want)


def test_dates_of_far_days(spark, tmp_path):
    ids = [0, 1, 96_063, 96_064, 96_066, 200_000, 200_001, 2_913_293, 2_913_294, 3_000_001]
    same_as_sql(spark, tmp_path, "dates", documents=spark.createDataFrame([(i,) for i in ids], "doc_id long"))


@pytest.mark.parametrize("title", ["A &amp;&amp;&amp", "x = &quot;1&quot; &amp;quot;", "a <b>c</b>", "  two \n\t lines\xa0here ", "&copy;   &#65;", ""])
def test_html_titles_decode_one_entity(spark, tmp_path, title):
    same_as_sql(spark, tmp_path, "html_titles", pages=spark.createDataFrame([(1, f"<html><title>{title}</title><title>no</title>"), (2, "none")], "page_id long, html string"))


def test_routing_score_reads_plain_text(spark, tmp_path):
    texts = ["unañ y más", "thé dér", "&lt;the&gt; &the;", "and\xa0of und and of", "and \n of", "uná", "licensed\x0bunder", "ﬁction nation", "THE DER", ""]
    same_as_sql(spark, tmp_path, "routing_score", documents=spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_entities_alone_go_to_python(spark):
    texts = ["a &amp; b", "&ampx &notit; &#65 &#x1F600; &#0; &;", "&&lt;p&gt;", "none", "", None, "end &", "&" + "a" * 40 + ";", "é&eacute\xa0&nbsp;😀&quot"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("u", text.unescape(F.col("t")))
    assert [r.u for r in rows.orderBy("i").collect()] == [None if t is None else html.unescape(t) for t in texts]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_decoded(regexp_extract_all(t#" in plan  # whole texts stay in the JVM


def test_pubmed_reads_single_paths_at_once(spark):
    one = "<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>A <i>b</i> &amp; c</ArticleTitle><Abstract><AbstractText Label='x>y'>One &lt;</AbstractText><AbstractText/><AbstractText>Two <b>bold</b> end</AbstractText></Abstract><Journal><Title>J</Title></Journal></Article></MedlineCitation></PubmedArticle>"
    kept = "<PubmedArticle><MedlineCitation><PMID>8</PMID><Article><ArticleTitle><![CDATA[<AbstractText>no</AbstractText> title]]></ArticleTitle></Article></MedlineCitation></PubmedArticle>"
    bare = "<PubmedArticle><MedlineCitation><PMID>9</PMID><Article><ArticleTitle/></Article></MedlineCitation></PubmedArticle>"
    rows = payloads.pubmed(spark.createDataFrame([("q", "s", "c", f"<Set>{one}{kept}{bare}</Set>")], "query_id string, stream string, category string, body string"))
    got = {r.pmid: (r.title, r.abstract, r.venue, r.publication_date) for r in rows.collect()}
    assert got == {"7": ("A b & c", "One < Two   end", "J", ""), "8": ("<AbstractText>no</AbstractText> title", "", "", "")}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("XPathStringEvaluator") + plan.count("xpath_string(") == 1


def test_schema_parses_a_document_once(spark):
    rows = json_schema.violations(spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}}'), (2, '{"a"')], "key int, body string"), {"type": "object", "required": ["c"], "properties": {"a": {"properties": {"b": {"items": {"type": "integer"}, "maxItems": 1}}}}})
    assert sorted((r.key, r.path, r.detail) for r in rows.collect()) == [("1", "$", "lacks c"), ("1", "$.a.b", "is out of bounds"), ("1", "$.a.b[1]", "is not integer"), ("2", "$", "is not JSON")]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_titles_travel_as_numbers_in_their_order(spark):
    long = lambda n: f"the long title number {n} " + "of many words " * 500
    none = F.array().cast("array<string>")
    rows = spark.createDataFrame([(1, long(2)), (2, long(2)), (3, long(10)), (4, long(10)), (5, long(3))], "component long, _title string")
    rows = rows.select("*", F.lit("2024-01-01").alias("publication_date"), F.lit("src").alias("source"), none.alias("authors"), F.lit("").alias("venue"), none.alias("observed_sources"), *[F.lit("").alias(c) for c in IDENTIFIERS])
    facts, _ = resolve._title_facts(rows)
    assert dict(facts.dtypes)["title"] == "bigint"
    assert sorted((r.title, r.part) for r in facts.where("k = 'part'").collect()) == [(0, 3), (0, 4), (1, 1), (1, 2)]
    assert sorted(map(tuple, resolve.bridged(rows).collect())) == [(1, 1), (2, 1), (3, 3), (4, 3)]
    assert sorted(map(tuple, resolve.bridged(rows, 0).collect())) == [(1, 1), (2, 1), (3, 3), (4, 3)]


@pytest.fixture
def joins_of_large_tables(spark, monkeypatch):
    """Small tables as large ones: dealt, and not broadcast."""
    monkeypatch.setattr(rules, "MANY", 100, raising=False)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def tasks_of(violations):
    """In how many tasks each rule finds its violations, and how many."""
    found = violations.select("rule", F.spark_partition_id().alias("p")).groupBy("rule", "p").count().collect()
    return {r: (len({x.p for x in found if x.rule == r}), sum(x["count"] for x in found if x.rule == r)) for r in {x.rule for x in found}}


def test_claims_in_order_are_not_put_together(spark, joins_of_large_tables):
    n = spark.range(4000).withColumn("claim_id", F.col("id").cast("string"))
    twice = F.explode(F.when(F.col("id") < 500, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    claims = n.select("claim_id", F.lit("EFFECT").alias("kind"), F.lit("SUPPORTED").alias("status"), F.array(F.lit("s0")).alias("source_ids"), twice.alias("copy")).drop("copy")
    bindings = n.select(F.col("id"), F.concat("claim_id", F.when(F.col("id") % 2 == 0, "").otherwise("x")).alias("claim_id"), F.concat(F.lit("s"), F.col("id") % 1000).alias("source_id"), F.lit("NONE").alias("depth"))
    sources = spark.createDataFrame([("s0", "PRIMARY_RESEARCH", "FULL_TEXT")], "source_id string, source_role string, access_depth string")
    got = tasks_of(rules.claim_rules(claims, bindings, sources, n.select(F.col("claim_id").alias("inference_id"), F.concat(F.lit("y"), "claim_id").alias("claim_id"))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts > 1
    wrong = len([i for i in range(4000) if i % 1000]) + len([i for i in range(500) if i % 1000])
    assert got["claim_id_unique"] == (parts, 500)
    assert got["binding_claim_known"] == (parts, 2000)
    assert got["inference_claim_known"] == (parts, 4000)
    assert got["claim_sources_are_bindings"] == (parts, wrong)
    assert got["supported_needs_full_text"] == (parts, wrong)


def test_citations_in_order_are_not_put_together(spark, joins_of_large_tables):
    n = spark.range(4000).withColumn("claim_id", F.col("id").cast("string"))
    claims = n.select("claim_id", F.lit("EFFECT").alias("claim_kind"), F.lit("FULLTEXT_EXTRACTED").alias("claim_origin"), F.lit("u").alias("source_url"), F.lit("p").alias("locator"), F.array("claim_id").alias("citation_binding_ids"))
    bindings = n.select(F.concat(F.lit("b"), "claim_id").alias("binding_id"), "claim_id", F.lit("v").alias("source_url"), F.lit("q").alias("locator"), F.lit("OTHER").alias("extraction_origin"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_of(contract.locator_rules(claims, bindings)) == dict.fromkeys(["citations_are_bindings", "url_is_bound", "locator_is_bound", "origin_is_bound"], (parts, 4000))


def observed(spark, *rows):
    """Observations, with what isn't said empty, numbered in their abstracts."""
    empty = {"title": "", "publication_date": "2026-08-01", "source": "s", "doi": "", "pmid": "", "authors": ["A"], "score": 0}
    said = [tuple({**empty, **r}.values()) + (f"#{i}",) for i, r in enumerate(rows)]
    schema = "title string, publication_date string, source string, doi string, pmid string, authors array<string>, score int, abstract string"
    return payloads.as_candidates(spark.createDataFrame(said, schema))


def test_ascii_titles_stay_in_the_jvm(spark):
    texts = ["An ASCII Title\n of\tMany words", "\x00 Odd: [x]", "", None, "Straße ﬁne", "İstanbul É", "plain then é", "é\nplain"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("u", text.folded(F.col("t")))
    assert [r.u for r in rows.orderBy("i").collect()] == [None if t is None else unicodedata.normalize("NFKD", t).casefold() for t in texts]
    assert "fold(CASE WHEN" in rows.select(normalize.title_key(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_works_are_folded_by_numbers(spark):
    rows = [{"title": f"The title of work number {i // 4} here", "doi": f"10.1/{i // 4}", "pmid": str(i // 4) if i % 4 == 2 else "", "score": (i * 7) % 5 // 2, "source": "pubmed" if i % 3 else "arxiv", "authors": [f"N{i % 5}", f"M{i % 2}"]} for i in range(80)]
    labelled = resolve.label(observed(spark, *rows, *rows[:8]))
    out = resolve.fold(labelled)
    assert "monotonically_increasing_id() AS _order" in out.select("pmid")._jdf.queryExecution().optimizedPlan().toString()  # no texts in every minimum
    one, two = (sorted(resolve.fold(labelled, crowd).drop("component").toJSON().collect()) for crowd in (resolve.CROWD, 0))
    assert len(one) == 20 and one == two


def test_only_shared_titles_have_facts(spark, monkeypatch):
    rows = [{"title": f"The title that observation {i:02} has alone", "doi": f"10.1/{i}"} for i in range(20)]
    rows += [{"title": "The title that two observations share", "doi": "10.2/1"}, {"title": "The title that two observations share", "pmid": "1"}]
    sizes, real = {}, resolve.spool

    def counted(df, tag):
        out = real(df, tag)
        sizes.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(resolve, "spool", counted)
    for small in (0, resolve.SMALL):
        sizes.clear()
        assert resolve.label(observed(spark, *rows), small=small).select("component").distinct().count() == 21
        assert sizes["facts"][0] == 10  # part, named, date, author and source, of each
        assert sizes["held"] == [2]  # after the last title, identifiers aren't brought up to date
