"""Queries that read provider payloads made of the test tables, with the SQL that says what they return.

Each document becomes one payload of a provider: JSON, Atom, RSS, XML or HTML,
with its whole text as the abstract, and records that must not come through.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.plans.bindings import docs, joined, query
from paperloom.plans.run import Config, discover
from paperloom.session import table
from paperloom.sources import inventory, payloads

SQL_DAY = "'2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')"
SQL_ABSTRACT = r"md5(trim(regexp_replace(translate(text, '<>&', '   '), '[\t\n\x0b\f\r\x{85}\p{Z}]+', ' ', 'g')))"


def n() -> Column:
    return F.col("doc_id")


def digits() -> Column:
    return n().cast("string")


def day() -> Column:
    return F.concat(F.lit("2024-01-"), F.lpad((n() % 28 + 1).cast("string"), 2, "0"))


def safe() -> Column:
    """Text as an element's content: without the three characters that are markup."""
    return F.translate("text", "<>&", "   ")


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def bodies(spark: SparkSession, d: str, body: Column, key: str = "query_id") -> DataFrame:
    """One payload a document; its id stays in the key."""
    rows = docs(spark, d, "doc_id", "text").select(digits().alias("doc"), body.alias("body"))
    return rows.select(F.col("doc").alias(key), F.lit("s").alias("stream"), F.lit("c").alias("category"), "body")


def happened() -> Column:
    return joined(F.transform("events", lambda e: F.concat_ws("@", e["event_type"], e["occurred_at"])))


def shown(rows: DataFrame, *more: Column | str) -> DataFrame:
    return rows.select(F.col("query_id").cast("long").alias("doc_id"), "title", "publication_date", joined("authors").alias("authors"), F.md5("abstract").alias("abstract_md5"), *more)


@query(f"""SELECT doc_id, 'Trial ' || doc_id || ' & rest' AS title, {SQL_DAY} AS publication_date, 'Lee A|Ek B' AS authors, {SQL_ABSTRACT} AS abstract_md5, '10.1000/a' || doc_id AS doi, CASE WHEN doc_id % 4 = 1 THEN doc_id::VARCHAR ELSE '' END AS pmid, 'J' AS venue,
    CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS open_access, doc_id % 9 = 4 AS is_preprint, 'https://europepmc.org/article/' || CASE WHEN doc_id % 9 = 4 THEN 'PPR/' ELSE 'MED/' END || doc_id AS landing_url,
    CASE WHEN doc_id % 9 = 4 THEN '' ELSE 'version_of_record_first_online@' || CASE WHEN doc_id % 2 = 0 THEN '2024-01-30' ELSE {SQL_DAY} END || CASE WHEN doc_id % 5 = 0 THEN '|first_formal_indexing@2024-01-31' ELSE '' END END AS happened FROM documents""")
def scan_europe_pmc(spark, d):
    one = F.struct(
        text("<i>Trial</i> ", digits(), " &amp; rest").alias("title"), F.when(n() % 9 == 4, "PPR").otherwise("MED").alias("source"), digits().alias("id"), text("https://doi.org/10.1000/A", digits(), ".").alias("doi"), F.when(n() % 4 == 1, digits()).alias("pmid"),
        day().alias("firstPublicationDate"), F.when(n() % 2 == 0, "2024-01-30").otherwise("").alias("electronicPublicationDate"), F.when(n() % 5 == 0, "2024-01-31").alias("firstIndexDate"), F.lit("Lee A, Ek B.").alias("authorString"),
        F.struct(F.struct(F.lit("J").alias("title")).alias("journal")).alias("journalInfo"), F.when(n() % 3 == 0, "Y").when(n() % 3 == 1, "N").alias("isOpenAccess"), safe().alias("abstractText"),
    )
    untitled = one.withField("title", F.lit(""))
    body = F.to_json(F.struct(F.struct(F.array(one, untitled).alias("result")).alias("resultList")))
    return shown(payloads.europe_pmc(bodies(spark, d, body)), "doi", "pmid", "venue", "open_access", "is_preprint", "landing_url", happened().alias("happened"))


@query(f"""SELECT doc_id, 'Work ' || doc_id AS title, {SQL_DAY} AS publication_date, 'A Lee' AS authors, md5(array_to_string(list_sort(list_distinct(w)), ' ')) AS abstract_md5, '10.1000/' || doc_id AS doi, CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR ELSE '' END AS pmid,
    CASE WHEN doc_id % 2 = 0 THEN 'https://j.org/' || doc_id ELSE 'https://openalex.org/W' || doc_id END AS landing_url, doc_id % 2 = 1 AS open_access, doc_id % 7 IN (5, 6) AS is_preprint, CASE WHEN doc_id % 7 IN (5, 6) THEN '' ELSE 'formal_version_verified@' || {SQL_DAY} END AS happened
    FROM (SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents)""")
def scan_openalex(spark, d):
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " "), lambda x: x != "")))
    spots = F.map_from_entries(F.transform(words, lambda w, i: F.struct(w, F.array(i))))
    one = F.struct(
        text("https://openalex.org/W", digits()).alias("id"), text("https://doi.org/10.1000/", digits()).alias("doi"), text("Work ", digits()).alias("display_name"), day().alias("publication_date"), F.when(n() % 7 == 5, "preprint").when(n() % 7 == 6, "posted-content").otherwise("article").alias("type"),
        F.array(*[F.struct(F.struct(F.lit(a).alias("display_name")).alias("author")) for a in ("A Lee", "")]).alias("authorships"), F.struct(F.when(n() % 2 == 0, text("https://j.org/", digits())).alias("landing_page_url")).alias("primary_location"),
        F.struct((n() % 2 == 1).alias("is_oa")).alias("open_access"), spots.alias("abstract_inverted_index"), F.struct(F.when(n() % 3 == 0, text("https://pubmed.ncbi.nlm.nih.gov/", digits(), "/")).alias("pmid")).alias("ids"),
    )
    body = F.to_json(F.struct(F.array(one, one.withField("display_name", F.lit(None).cast("string"))).alias("results")))
    return shown(payloads.openalex(bodies(spark, d, body)), "doi", "pmid", "landing_url", "open_access", "is_preprint", happened().alias("happened"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 28 + 1 BETWEEN 10 AND 20 THEN 'Wrapped ' ELSE 'Bare ' END || doc_id AS title, CASE WHEN doc_id % 28 + 1 BETWEEN 10 AND 20 THEN {SQL_DAY} ELSE '2024-01-15' END AS publication_date, CASE WHEN doc_id % 28 + 1 BETWEEN 10 AND 20 THEN 'A|B' ELSE 'C' END AS authors,
    {SQL_ABSTRACT} AS abstract_md5, 'https://openreview.net/forum?id=' || CASE WHEN doc_id % 28 + 1 BETWEEN 10 AND 20 THEN 'w' ELSE 'b' END || doc_id AS landing_url, TRUE AS is_preprint FROM documents""")
def scan_openreview(spark, d):
    """Three notes a query, at most one of which is kept: the first in the window."""
    at = F.lit(1704067200000) + (n() % 28) * 86_400_000
    value = lambda c: F.struct(c.alias("value"))
    wrapped = F.to_json(F.struct(value(text("Wrapped ", digits())).alias("title"), value(F.array(F.lit("A"), F.lit("B"))).alias("authors"), value(safe()).alias("abstract")))
    bare = F.to_json(F.struct(text("Bare ", digits()).alias("title"), F.array(F.lit("C")).alias("authors"), safe().alias("abstract")))
    note = lambda key, pdate, cdate, content: text('{"id": "', key, digits(), '"', pdate, ', "cdate": ', cdate.cast("string"), ', "content": ', content, "}")
    late = F.lit(1705276800000 + 40_000_000)
    body = text('{"notes": [', note("w", text(', "pdate": ', at.cast("string")), F.lit(0), wrapped), ", ", note("b", "", late, bare), ", ", note("b", "", late, bare), "]}")
    return shown(payloads.openreview(bodies(spark, d, body), "2024-01-10", "2024-01-20", 1), "landing_url", "is_preprint")


@query(f"""SELECT doc_id, 'Memory of ' || doc_id AS title, CASE WHEN doc_id % 5 = 0 THEN '' ELSE {SQL_DAY} END AS publication_date, 'C Day|D Night' AS authors, {SQL_ABSTRACT} AS abstract_md5, '2401.' || doc_id AS arxiv_id, CASE WHEN doc_id % 2 = 0 THEN '10.1000/x' || doc_id ELSE '' END AS doi, 'arXiv' AS venue, TRUE AS is_preprint, '' AS happened
    FROM documents WHERE doc_id % 5 = 0 OR doc_id % 28 + 1 BETWEEN 10 AND 20""")
def scan_arxiv(spark, d):
    entry = text("<entry><id>http://arxiv.org/abs/2401.", digits(), "v2</id>", F.when(n() % 5 == 0, "").otherwise(text("<published>", day(), "T01:00:00Z</published>")), "<title>Memory\n of ", digits(), "</title><summary>", safe(), "</summary><author><name>C Day</name></author><author><name>D Night</name></author>", F.when(n() % 2 == 0, text("<arxiv:doi>10.1000/X", digits(), "</arxiv:doi>")).otherwise(""), "</entry>")
    body = text('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">', entry, "<entry><id>http://arxiv.org/abs/0</id><published>2020-01-01T00:00:00Z</published><title>Old</title></entry></feed>")
    return shown(payloads.arxiv(bodies(spark, d, body), "2024-01-10", "2024-01-20"), "arxiv_id", "doi", "venue", "is_preprint", happened().alias("happened"))


@query(f"""SELECT doc_id, 'A trial of ' || doc_id AS title, CASE WHEN doc_id % 3 = 0 THEN {SQL_DAY} WHEN doc_id % 3 = 1 THEN '2024-02-01' ELSE '2023-01-01' END AS publication_date, 'Ann Lee|Bo Ek' AS authors, md5('We slept. ' || t) AS abstract_md5, doc_id::VARCHAR AS pmid, 'PMC' || doc_id AS pmcid, '10.1000/p' || doc_id AS doi,
    'https://pubmed.ncbi.nlm.nih.gov/' || doc_id || '/' AS landing_url, 'Journal Article|Review' AS types, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'version_of_record_first_online@' || {SQL_DAY} || '|first_formal_indexing@2024-01-31' WHEN doc_id % 3 = 0 THEN 'version_of_record_first_online@' || {SQL_DAY}
    WHEN doc_id % 2 = 0 THEN 'first_formal_indexing@2024-01-31' WHEN doc_id % 3 = 1 THEN 'formal_version_verified@2024-02-01' ELSE 'formal_version_verified@2023-01-01' END AS happened FROM (SELECT doc_id, trim(regexp_replace(translate(text, '<>&', '   '), '[\\t\\n\\x0b\\f\\r\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS t FROM documents)""")
def scan_pubmed(spark, d):
    """Dates as article date, issue with a month's name, or free text; indexing only for every other one."""
    ymd = lambda y, m, x: text("<Year>", y, "</Year><Month>", m, "</Month><Day>", x, "</Day>")
    online = F.when(n() % 3 == 0, text("<ArticleDate>", ymd("2024", "01", (n() % 28 + 1).cast("string")), "</ArticleDate>")).otherwise("")
    issue = F.when(n() % 3 == 1, "<Year>2024</Year><Month>Feb</Month>").otherwise("<MedlineDate>Winter 2023 to spring</MedlineDate>")
    flat = F.trim(F.regexp_replace(safe(), r"(?U)\s+", " "))
    body = text(
        "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>", digits(), "</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate>", issue, "</PubDate></JournalIssue></Journal><ArticleTitle>A trial\n of ", digits(), "</ArticleTitle><Abstract><AbstractText>We slept.</AbstractText><AbstractText>", flat, "</AbstractText></Abstract>",
        "<AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName></Author><Author><LastName>Ek</LastName><ForeName>Bo</ForeName></Author></AuthorList><PublicationTypeList><PublicationType>Journal Article</PublicationType><PublicationType>Review</PublicationType></PublicationTypeList>", online, "</Article></MedlineCitation><PubmedData><History>",
        F.when(n() % 2 == 0, text('<PubMedPubDate PubStatus="entrez">', ymd("2024", "1", "31"), "</PubMedPubDate>")).otherwise(""), '</History><ArticleIdList><ArticleId IdType="doi">10.1000/P', digits(), '</ArticleId><ArticleId IdType="pmc">PMC', digits(), "</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>",
    )
    return shown(payloads.pubmed(bodies(spark, d, body)), "pmid", "pmcid", "doi", "landing_url", joined("provider_publication_types").alias("types"), happened().alias("happened"))


def atom_and_rss(spark: SparkSession, d: str) -> DataFrame:
    """Feeds, Atom for even documents, with one item that has no title."""
    atom = text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Entry ', digits(), '</title><link rel="alternate" href="https://aclanthology.org/', F.when(n() % 6 == 0, "2023").otherwise("2024"), ".acl-long.", digits(), '/"/><updated>2020-01-01T00:00:00Z</updated>', F.when(n() % 4 == 0, text("<published>", day(), "T00:00:00Z</published>")).otherwise(""), "<summary>", safe(), "</summary><author><name>A B</name></author></entry><entry><title></title></entry></feed>")
    rss = text('<rss xmlns:prism="p" xmlns:dc="d"><channel><title>Feed</title><item><title>Item &amp;amp; ', digits(), "</title><link>https://www.sciencedirect.com/a/", digits(), "?dgcid=rss</link><description>", safe(), "</description><dc:creator>A B</dc:creator><pubDate>Sat, ", F.lpad((n() % 28 + 1).cast("string"), 2, "0"), " Jan 2024 01:00:00 GMT</pubDate><prism:doi>/doi/10.1000/J", digits(), "</prism:doi></item><item><title></title></item></channel></rss>")
    return bodies(spark, d, F.when(n() % 2 == 0, atom).otherwise(rss), "feed_id")


@query(f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Entry ' ELSE 'Item & ' END || doc_id AS title, CASE WHEN doc_id % 2 = 1 OR doc_id % 4 = 0 THEN {SQL_DAY} ELSE '' END AS publication_date, 'A B' AS authors, {SQL_ABSTRACT} AS abstract_md5, CASE WHEN doc_id % 2 = 1 THEN '10.1000/j' || doc_id ELSE '' END AS doi,
    CASE WHEN doc_id % 2 = 1 THEN 'https://www.sciencedirect.com/a/' || doc_id ELSE 'https://aclanthology.org/' || CASE WHEN doc_id % 6 = 0 THEN '2023' ELSE '2024' END || '.acl-long.' || doc_id || '/' END AS landing_url, 'YES' AS oa, CASE WHEN doc_id % 2 = 1 OR doc_id % 4 = 0 THEN 'version_of_record_first_online@' || {SQL_DAY} ELSE '' END AS happened FROM documents""")
def scan_feeds(spark, d):
    records = payloads.feed_records(atom_and_rss(spark, d)).withColumnRenamed("feed_id", "query_id")
    return shown(payloads.record_candidates(records, "jama", True), "doi", "landing_url", F.when(F.col("open_access") & (F.get("oa_evidence", F.lit(0))["evidence_type"] == "source_catalog_fully_oa"), "YES").otherwise("").alias("oa"), happened().alias("happened"))


@query(f"""SELECT doc_id, 'Entry ' || doc_id AS title, CASE WHEN doc_id % 4 = 0 AND doc_id % 6 <> 0 THEN {SQL_DAY} ELSE '' END AS publication_date, 'A B' AS authors, {SQL_ABSTRACT} AS abstract_md5, CASE WHEN doc_id % 6 = 0 THEN '2023' ELSE '2024' END || '.acl-long.' || doc_id AS anthology_id,
    CASE WHEN doc_id % 4 = 0 AND doc_id % 6 <> 0 THEN 'formal_proceedings_release@' || {SQL_DAY} ELSE '' END AS happened FROM documents WHERE doc_id % 2 = 0""")
def scan_proceedings(spark, d):
    """Proceedings feeds: a date that disagrees with the year in the work's id is none."""
    feeds = atom_and_rss(spark, d).where(F.col("feed_id").cast("long") % 2 == 0)
    return shown(payloads.proceedings_atom(feeds, keep=("feed_id",)).withColumnRenamed("feed_id", "query_id"), "anthology_id", happened().alias("happened"))


@query(f"""SELECT doc_id, 'Registry ' || doc_id AS title, CASE doc_id % 3 WHEN 0 THEN {SQL_DAY} WHEN 1 THEN '2024-02-01' ELSE '2023-01-01' END AS publication_date, 'A B' AS authors, {SQL_ABSTRACT} AS abstract_md5, '10.1000/r' || doc_id AS doi, 'V' AS venue,
    CASE doc_id % 3 WHEN 0 THEN 'version_of_record_first_online@' || {SQL_DAY} WHEN 1 THEN 'formal_version_verified@2024-02-01' ELSE 'formal_version_verified@2023-01-01' END AS happened FROM documents""")
def scan_registry(spark, d):
    return shown(payloads.record_candidates(payloads.crossref_pages(registry_pages(spark, d)).withColumn("query_id", F.col("page").cast("string")), "registry"), "doi", "venue", happened().alias("happened"))


def registry_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page a document, seven inventories: some are short of what they announce."""
    parts = lambda *p: F.struct(F.array(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in p])).alias("date-parts"))
    item = F.struct(
        text("https://doi.org/10.1000/R", digits()).alias("DOI"), F.array(text("Registry <b>", digits(), "</b>")).alias("title"), text("https://j.org/", digits()).alias("URL"), F.array(F.lit("V")).alias("container-title"), F.array(F.struct(F.lit("A").alias("given"), F.lit("B").alias("family"))).alias("author"), safe().alias("abstract"),
        F.when(n() % 3 == 0, parts(2024, 1, (n() % 28 + 1).cast("int"))).alias("published-online"), F.when(n() % 3 == 1, parts(2024, 2)).alias("published"), parts(2023).alias("issued"),
    )
    body = F.to_json(F.struct(F.struct((n() % 7 * 10).alias("total-results"), F.array(item).alias("items")).alias("message")))
    return docs(spark, d, "doc_id", "text").select((n() % 7).cast("string").alias("inventory_id"), n().alias("page"), body.alias("body"))


@query("SELECT (doc_id % 7)::VARCHAR AS inventory_id, max(doc_id % 7 * 10) AS expected, count(*) AS received, count(*) >= max(doc_id % 7 * 10) AND count(*) <= 29 AS complete FROM documents GROUP BY 1")
def registry_complete(spark, d):
    return payloads.crossref_completeness(registry_pages(spark, d), 29).select("inventory_id", "expected", "received", "complete")


@query(f"""SELECT doc_id, 'The long title of ' || doc_id AS title, CASE WHEN doc_id % 3 = 0 THEN '' ELSE {SQL_DAY} END AS publication_date, '10.1000/l' || doc_id AS doi, CASE WHEN doc_id % 5 = 0 THEN 'ACCEPTED_MANUSCRIPT' WHEN doc_id % 3 = 0 THEN 'NO_DATE' END AS fault FROM documents""")
def scan_listing(spark, d):
    """Listing pages: one article, twice, among links that are none and links of short titles."""
    link = text('<a class="t" href="/article/', digits(), '">The <em>long</em> title of ', digits(), "</a>")
    page = text('<a href="/nav">Home of all the journals</a>', link, F.when(n() % 5 == 0, " Accepted Manuscript ").otherwise(" "), F.when(n() % 3 == 0, "Issue date ").otherwise("Published online "), F.date_format(day().cast("date"), "d MMMM yyyy"), " doi 10.1000/L", digits(), " ", safe(), link, '<a href="/article/0">Two words</a>')
    pages = docs(spark, d, "doc_id", "text").select(n().alias("page_id"), page.alias("html"))
    return payloads.listing(pages, "/article/", "Published online", accepted="accepted manuscript").select(F.col("page_id").alias("doc_id"), "title", "publication_date", "doi", "fault")


@query("SELECT doc_id, 'Paper & ' || doc_id AS title, 'A B|C D' AS authors, '/v' || doc_id || '/x.html' AS landing_url FROM documents")
def scan_proceedings_page(spark, d):
    page = text('<h1>Volume</h1><div class="paper"><p class="title">Paper &amp; ', digits(), '</p><p class="details"><span class="authors">A B, C D</span></p><a href="/v', digits(), '/x.html">abs</a></div><p>', safe(), '</p><div class="paper"><p class="title"></p></div>')
    rows = payloads.proceedings_html(docs(spark, d, "doc_id", "text").select(n().alias("page_id"), page.alias("html")))
    return rows.select(F.col("page_id").alias("doc_id"), "title", joined("authors").alias("authors"), "landing_url")


@query("""SELECT doc_id, 'First ' || doc_id AS title, '10.1000/m' || doc_id AS doi, '' AS pmid FROM documents UNION ALL SELECT doc_id, 'Second ' || doc_id, '', (doc_id + 7)::VARCHAR FROM documents""")
def scan_reports(spark, d):
    """Old reports: two works with ids, then one without."""
    plain = F.translate("text", "#*:/\n\r", "      ")
    page = text("# Report\n", plain, "\n### 1. First ", digits(), "\nhttps://doi.org/10.1000/M", digits(), " \n", plain, "\n2. **Second ", digits(), "** x\nPMID: ", (n() + 7).cast("string"), "\n### 3. None here\n")
    return payloads.markdown_history(docs(spark, d, "doc_id", "text").select(n().alias("path"), page.alias("value"))).select(F.col("path").alias("doc_id"), "title", "doi", "pmid")


@query("SELECT source AS query_id, doc_id, CASE WHEN n > 0 THEN 'first' ELSE 'second' END AS provider FROM (SELECT source, doc_id, lang, count(*) FILTER (lang = 'de') OVER (PARTITION BY source) AS n FROM documents) WHERE CASE WHEN n > 0 THEN lang = 'de' ELSE lang = 'en' END")
def fallback(spark, d):
    rows = docs(spark, d, "doc_id", F.col("source").alias("query_id"), "lang")
    part = lambda lang, name: rows.where(F.col("lang") == lang).select("query_id", "doc_id", F.lit(name).alias("provider"))
    return payloads.with_fallback(part("de", "first"), part("en", "second"))


@query("SELECT doc_id, source FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'arxiv' WHEN doc_id % 5 = 1 THEN 'registry' WHEN doc_id % 5 = 2 THEN 'jama' WHEN doc_id % 5 = 3 THEN 'listing' ELSE 'acl_anthology' END AS source FROM documents)")
def run_sources(spark, d):
    """A discovery over a store in which each document is an answer of one kind of source."""
    atom = text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>https://aclanthology.org/2024.acl-long.', digits(), "/</id><published>2024-01-28T00:00:00Z</published><title>One of many entries</title><summary>", safe(), "</summary></entry></feed>")
    registry = F.to_json(F.struct(F.struct(F.array(F.struct(text("10.1000/", digits()).alias("DOI"), F.array(F.lit("A registered work")).alias("title"), safe().alias("abstract"))).alias("items")).alias("message")))
    page = text('<a href="/article/', digits(), '">The long title of one</a> Published online 28 January 2024 ', safe())
    kind, body = n() % 5, F.when(n() % 5 == 1, registry).when(n() % 5 == 3, page).otherwise(atom)
    name = F.when(kind == 0, "arxiv").when(kind == 1, "registry").when(kind == 2, "jama").when(kind == 3, "listing").otherwise("acl_anthology")
    store = docs(spark, d, "doc_id", "text").select(name.alias("source"), digits().alias("query_id"), body.alias("body"))
    queries = docs(spark, d, digits().alias("query_id")).withColumns({"stream": F.lit("s"), "category": F.lit("c")})
    config = Config(datetime(2024, 1, 27, tzinfo=UTC), datetime(2024, 1, 30, tzinfo=UTC), adapters={"jama": "rss_atom", "registry": "crossref", "listing": "publisher_listing"}, listings={"listing": {"href_contains": "/article/", "label": "Published online"}})
    return discover(store, queries, config).select(F.get("query_ids", F.lit(0)).cast("long").alias("doc_id"), "source")


@query("SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 3 = 0 THEN 'feed' WHEN s_suppkey % 2 = 0 THEN 'sharded_listing' ELSE 'listing' END AS adapter FROM supplier")
def source_dispatch(spark, d):
    k = F.col("s_suppkey")
    return inventory.dispatch(table(spark, d, "supplier").select(k.alias("source_id"), F.when(k % 3 == 0, "publisher_feed_v1").otherwise("publisher_listing_v1").alias("template"), F.when(k % 2 == 0, 4).otherwise(0).alias("n_shards")))


@query("""SELECT 'observation_unique' AS rule, o_orderkey::VARCHAR AS key FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT DISTINCT 'query_known', o_custkey::VARCHAR FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 20 <> 0)
    UNION ALL SELECT 'raw_at_least_unique', c_custkey::VARCHAR FROM customer WHERE c_custkey % 20 <> 0 AND c_nationkey < 5""")
def work_input(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").where("c_custkey % 20 <> 0")
    seen = o.unionByName(o.where("o_orderkey % 50 = 0")).select(F.col("o_orderkey").cast("string").alias("observation_id"), F.array(F.col("o_custkey").cast("string")).alias("query_ids"))
    return inventory.input_faults(seen, c.select(F.col("c_custkey").cast("string").alias("query_id"), F.col("c_nationkey").alias("raw_count"), F.lit(5).alias("unique_count")))
