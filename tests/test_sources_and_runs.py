"""Payload parsers, the offline source, sinks, a whole run, and streams."""

import json
import os
from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from paperloom.operators import gaps, rank, resolve
from paperloom.operators.state import StateConflict
from paperloom.plans import pages, report
from paperloom.plans.run import Config, discover, execute
from paperloom.schema import EVENT
from paperloom.storage import spool
from paperloom.sources import chains, inventory, offline, payloads
from paperloom.streaming import gap_stream, state_stream

TOKYO = ZoneInfo("Asia/Tokyo")
START, END = datetime(2026, 8, 6, 12, tzinfo=TOKYO), datetime(2026, 8, 9, 12, tzinfo=TOKYO)

EUROPE_PMC = {"resultList": {"result": [
    {"title": "A <i>randomized</i> controlled trial of sleep", "source": "MED", "id": "1", "doi": "10.1/A", "pmid": "1", "firstPublicationDate": "2026-08-08", "firstIndexDate": "2026-08-09", "authorString": "Lee A, Ek B.", "journalInfo": {"journal": {"title": "J"}}, "pubTypeList": {"pubType": ["Journal Article"]}, "isOpenAccess": "Y", "abstractText": "We slept."},
    {"title": "A preprint", "source": "PPR", "id": "2", "firstPublicationDate": "2026-08-08", "isOpenAccess": "N"},
    {"title": ""},
]}}
OPENALEX = {"results": [{"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/a", "display_name": "A randomized controlled trial of sleep", "publication_date": "2026-08-08", "type": "article", "authorships": [{"author": {"display_name": "A Lee"}}], "open_access": {"is_oa": False}, "abstract_inverted_index": {"slept": [1], "We": [0]}, "ids": {"pmid": "https://pubmed.ncbi.nlm.nih.gov/1"}}]}
ARXIV = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>http://arxiv.org/abs/2608.01v2</id><published>2026-08-08T01:00:00Z</published><title>Memory in
 a large language model</title><summary>Text</summary><author><name>C Day</name></author><arxiv:doi>10.1/z</arxiv:doi></entry>
<entry><id>http://arxiv.org/abs/2601.01</id><published>2026-01-01T01:00:00Z</published><title>Old</title></entry><entry><id>http://arxiv.org/abs/2601.02</id><title>Undated</title></entry></feed>"""
PUBMED = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>2026</Year><Month>Aug</Month></PubDate></JournalIssue></Journal>
<ArticleTitle>A randomized controlled trial of sleep.</ArticleTitle><Abstract><AbstractText>We</AbstractText><AbstractText>slept.</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName></Author></AuthorList>
<PublicationTypeList><PublicationType>Randomized Controlled Trial</PublicationType></PublicationTypeList><ArticleDate><Year>2026</Year><Month>08</Month><Day>08</Day></ArticleDate></Article></MedlineCitation>
<PubmedData><History><PubMedPubDate PubStatus="pubmed"><Year>2026</Year><Month>8</Month><Day>9</Day></PubMedPubDate></History><ArticleIdList><ArticleId IdType="doi">10.1/a</ArticleId><ArticleId IdType="pmc">PMC9</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
OPENREVIEW = {"notes": [{"id": "n1", "pdate": 1786150800000, "content": {"title": {"value": "Wrapped title"}, "authors": {"value": ["A"]}, "abstract": "bare"}}, {"id": "n2", "cdate": 1700000000000, "content": {"title": "Old"}}]}


def payload(spark, body, query="q1"):
    return spark.createDataFrame([(query, "s", "c", body if isinstance(body, str) else json.dumps(body))], "query_id string, stream string, category string, body string")


def test_json_providers(spark):
    a, b = payloads.europe_pmc(payload(spark, EUROPE_PMC)).orderBy(F.desc("title")).collect()[::-1]
    assert (b["title"], b["doi"], b["open_access"], b["authors"], [e["event_type"] for e in b["events"]]) == ("A randomized controlled trial of sleep", "10.1/a", True, ["Lee A", "Ek B"], ["version_of_record_first_online", "first_formal_indexing"]) or a["doi"] == "10.1/a"
    got = {r["title"]: r for r in payloads.europe_pmc(payload(spark, EUROPE_PMC)).collect()}
    assert len(got) == 2 and got["A preprint"]["events"] == [] and got["A preprint"]["is_preprint"] and got["A preprint"]["open_access"] is False
    (o,) = payloads.openalex(payload(spark, OPENALEX)).collect()
    assert (o["abstract"], o["pmid"], o["doi"], o["events"][0]["event_type"]) == ("We slept", "1", "10.1/a", "formal_version_verified")
    (r,) = payloads.openreview(payload(spark, OPENREVIEW), "2026-08-06", "2026-08-09").collect()
    assert (r["title"], r["authors"], r["abstract"], r["landing_url"]) == ("Wrapped title", ["A"], "bare", "https://openreview.net/forum?id=n1")
    assert payloads.openalex(payload(spark, {"results": []})).count() == 0


def test_xml_providers(spark):
    got = {r["title"]: r for r in payloads.arxiv(payload(spark, ARXIV), "2026-08-06", "2026-08-09").collect()}
    assert set(got) == {"Memory in a large language model", "Undated"}
    m = got["Memory in a large language model"]
    assert (m["arxiv_id"], m["doi"], m["authors"], m["events"], m["is_preprint"]) == ("2608.01", "10.1/z", ["C Day"], [], True)
    (p,) = payloads.pubmed(payload(spark, PUBMED)).collect()
    assert (p["pmid"], p["doi"], p["pmcid"], p["publication_date"], p["authors"], p["abstract"], p["provider_publication_types"]) == ("1", "10.1/a", "PMC9", "2026-08-08", ["Ann Lee"], "We slept.", ["Randomized Controlled Trial"])
    assert [(e["event_type"], e["occurred_at"]) for e in p["events"]] == [("version_of_record_first_online", "2026-08-08"), ("first_formal_indexing", "2026-08-09")]


RSS = """<rss xmlns:prism="prism" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>Feed</title>
<item><title>First &amp;amp; paper</title><link>https://www.sciencedirect.com/a?dgcid=rss</link><description>&lt;p&gt;Publication date: Available online 8 August 2026&lt;/p&gt;&lt;p&gt;Source: J, Volume 1&lt;/p&gt;&lt;p&gt;Author(s): A B, C D&lt;/p&gt;</description><dc:identifier>x</dc:identifier><prism:doi>/doi/10.1234/J</prism:doi></item>
<item><title></title><link>https://x.org/b</link><pubDate>Sat, 08 Aug 2026 01:00:00 GMT</pubDate></item></channel></rss>"""
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Entry one</title><link href="https://aclanthology.org/2026.acl-long.1/"/><updated>2026-08-08T00:00:00Z</updated></entry><entry><title>Entry two</title><link rel="alternate" href="https://aclanthology.org/2025.acl-long.2/"/><published>2026-08-08T00:00:00Z</published></entry><entry><title>Entry three</title><link href="https://aclanthology.org/2026.acl-long.3/"/><published>2026-08-08T00:00:00Z</published></entry></feed>'


def test_feeds(spark):
    feeds = spark.createDataFrame([("r", RSS), ("a", ATOM)], "feed_id string, body string")
    got = {(r["feed_id"], r["title"]): r for r in payloads.feed_records(feeds).collect()}
    one = got["r", "First & paper"]
    assert (one["landing_url"], one["publication_date"], one["doi"], one["authors"], one["venue"]) == ("https://www.sciencedirect.com/a", "2026-08-08", "10.1234/j", ["A B", "C D"], "J")
    assert got["r", ""]["usable"] is False and got["r", ""]["publication_date"] == "2026-08-08" and got["a", "Entry one"]["publication_date"] == ""
    acl = {r["title"]: [e["event_type"] for e in r["events"]] for r in payloads.proceedings_atom(feeds.where("feed_id = 'a'")).collect()}
    assert acl == {"Entry one": [], "Entry two": [], "Entry three": ["formal_proceedings_release"]}
    kinds = {r["title"]: r["events"][0]["event_type"] for r in payloads.record_candidates(payloads.feed_records(feeds).where("usable and publication_date <> ''"), "jama", True).collect()}
    assert kinds["First & paper"] == "version_of_record_first_online"


def test_registry_pages(spark):
    item = lambda d, **k: {"DOI": d, "title": ["T <b>x</b>"], "URL": "u", "container-title": ["V"], "author": [{"given": "A", "family": "B"}], **k}
    one = {"message": {"total-results": 3, "items": [item("10.1234/A", **{"published-online": {"date-parts": [[2026, 8]]}}), item("10.1234/B", issued={"date-parts": [[2026]]})]}}
    pages = spark.createDataFrame([("i", 1, json.dumps(one))], "inventory_id string, page int, body string")
    got = [(r["doi"], r["publication_date"], r["source_field"], r["authors"], r["title"]) for r in payloads.crossref_pages(pages).orderBy("doi").collect()]
    assert got == [("10.1234/a", "2026-08-01", "crossref:published-online", ["A B"], "T x"), ("10.1234/b", "2026-01-01", "crossref:issued", ["A B"], "T x")]
    assert payloads.crossref_completeness(pages).first()["complete"] is False
    events = {r["doi"]: r["events"][0]["event_type"] for r in payloads.record_candidates(payloads.crossref_pages(pages), "x").collect()}
    assert events == {"10.1234/a": "version_of_record_first_online", "10.1234/b": "formal_version_verified"}


def test_listings(spark):
    html = """<a href="/nav">Home</a><a class="t" href="/article/1">The first long title</a> <span>Published online 8 August 2026</span> doi 10.1234/x.
    <a href='/article/2'>The second long title</a> Accepted Manuscript Published online 7 August 2026 <a href="/article/3">The third long title</a> Issue date 2026 <a href="/article/1">The first long title</a><a href="/article/4">Two words</a>"""
    pages = spark.createDataFrame([("p", html)], "page_id string, html string")
    got = [(r["landing_url"], r["publication_date"], r["doi"], r["fault"]) for r in payloads.listing(pages, "/article/", "Published online", accepted="accepted manuscript").orderBy("landing_url").collect()]
    assert got == [("/article/1", "2026-08-08", "10.1234/x", None), ("/article/2", "2026-08-07", "", "ACCEPTED_MANUSCRIPT"), ("/article/3", "", "", "NO_DATE")]
    paged = spark.createDataFrame([(1, "2026-08-09"), (1, "2026-08-08"), (2, "2026-08-08"), (2, "2026-08-05"), (3, "2026-08-06")], "page int, publication_date string")
    assert [(r["page"], r["in_order"], r["stop"]) for r in payloads.listing_pages_needed(paged, "2026-08-06").orderBy("page").collect()] == [(1, True, False), (2, True, True), (3, False, False)]
    block = spark.createDataFrame([("p", '<div class="paper"><p class="title">A paper</p><span class="authors">A B, C D</span><a href="/v1/x.html">abs</a></div>')], "page_id string, html string")
    assert tuple(payloads.proceedings_html(block).first()) == ("p", "A paper", ["A B", "C D"], "/v1/x.html")
    old = spark.createDataFrame([("f.md", "# Report\n### 1. First title\ndoi.org/10.1234/a\ntext\n2. **Second title** x\nPMID: 77\n### No ids here\n")], "path string, value string")
    assert [(r["title"], r["doi"], r["pmid"]) for r in payloads.markdown_history(old).orderBy("i").collect()] == [("First title", "10.1234/a", ""), ("Second title", "", "77")]


def test_offline_source_and_a_whole_run(spark, tmp_path):
    for source, name, body in (("arxiv", "q1@2026-08-08.xml", ARXIV), ("pubmed", "q1@2026-08-08.xml", PUBMED), ("pubmed", "q2@2026-08-01.xml", PUBMED), ("openalex", "q1@2026-08-08.json", json.dumps(OPENALEX)), ("europe_pmc", "q1@2026-08-08.json", json.dumps(EUROPE_PMC)), ("openreview", "q1@2026-08-08.json", json.dumps(OPENREVIEW))):
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / name).write_text(body)
    offline.register(spark)
    df = spark.read.format("payloads").option("path", str(tmp_path)).load()
    assert df.count() == 6
    some = spark.read.format("payloads").options(path=str(tmp_path), source="pubmed", since="2026-08-05").load()
    assert [(r["query_id"], r["body"]) for r in some.collect()] == [("q1", PUBMED)]
    assert some.rdd.getNumPartitions() == 1
    same = offline.read_store(spark, str(tmp_path))
    assert sorted(map(tuple, same.select("source", "query_id", "fetched_on").collect())) == sorted(map(tuple, df.select("source", "query_id", "fetched_on").collect()))

    queries = spark.createDataFrame([("q1", "sport_science", "sport")], "query_id string, stream string, category string")
    config = Config(START, END, terms=["sleep", "memory"], minimum={"sport": 45}, categories=["sport"], policy=rank.Policy(1, 2))
    seen = discover(df, queries, config)
    assert seen.count() == 7
    prior = spark.createDataFrame([("doi:10.1/a", "old", "sport", "2026-08-01", "2026-08-01", 2, ["x"], "ABSTRACT", "NO")], "work_id string, title string, category string, first_seen_at string, last_seen_at string, seen_count long, streams array<string>, access_depth string, oa_status string")
    none = spark.createDataFrame([], "event_id string")
    probes = spark.createDataFrame([("doi:10.1/a", "https://pmc.ncbi.nlm.nih.gov/articles/PMC9/", "SUCCESS", 200)], "work_id string, url string, status string, http_status int")
    run = execute(seen, config, prior, none, probes)
    got = {r["work_id"]: r for r in run.ledger.collect()}
    trial = got["doi:10.1/a"]
    assert (trial["n_observations"], trial["observed_sources"], trial["document_type"], trial["event_status"], trial["event_class"], trial["access_depth"], trial["oa_status"]) == (3, ["europe_pmc", "openalex", "pubmed"], "journal_article", "QUALIFYING", "OTHER", "FULL_TEXT", "YES")
    assert trial["study_designs"] == ["randomized_controlled_trial"] and got["doi:10.1/z"]["event_status"] == "NO_QUALIFYING_EVENT"
    assert [r["work_id"] for r in run.featured.collect()] == ["doi:10.1/a"]
    counts = run.counts.first()
    assert (counts["deduplicated_candidates"], counts["raw_candidates"], counts["event_qualifying"]) == (5, 7, 1)
    kept = {r["work_id"]: r for r in run.works.collect()}["doi:10.1/a"]
    assert (kept["first_seen_at"], kept["seen_count"], kept["access_depth"]) == ("2026-08-01", 3, "FULL_TEXT")
    again = execute(seen, config, run.works, run.ledger.where("event_id is not null").select("event_id"), probes)
    assert {r["event_status"] for r in again.ledger.collect()} == {"ALREADY_NOTIFIED", "NO_QUALIFYING_EVENT"}
    page = report.html_report(run.ledger.withColumn("sources_piped", F.array_join("observed_sources", "|")), run.featured, "A & B").decode()
    assert 'data-work-id="doi:10.1/a"' in page and 'data-featured="true"' in page and page.count("<article") == 5 and "A &amp; B" in page
    assert page == report.html_report(run.ledger.withColumn("sources_piped", F.array_join("observed_sources", "|")), run.featured, "A & B").decode()


def test_observations_in_any_order_make_the_same_works(spark):
    rows = payloads.europe_pmc(payload(spark, EUROPE_PMC)).unionByName(payloads.openalex(payload(spark, OPENALEX))).unionByName(payloads.pubmed(payload(spark, PUBMED))).drop("query_id")
    one = sorted(resolve.deduplicate(rows).toJSON().collect())
    two = sorted(resolve.deduplicate(rows.orderBy(F.rand(3)).repartition(3)).toJSON().collect())
    assert one == two and len(one) == 2


def test_sinks(spark, tmp_path):
    sums = report.write_bundle(str(tmp_path / "b"), {"a.json": report.canonical({"b": 1, "a": 2}), "r.html": b"x"})
    assert sums["r.html"] == report.sha256(b"x") and json.loads((tmp_path / "b/a.json").read_text()) == {"a": 2, "b": 1}
    first = report.commit_state(str(tmp_path / "state.json"), {"n": 1}, None)
    second = report.commit_state(str(tmp_path / "state.json"), {"n": 2}, first)
    with pytest.raises(StateConflict):
        report.commit_state(str(tmp_path / "state.json"), {"n": 3}, first)
    assert report.sha256((tmp_path / "state.json").read_bytes()) == second
    with pytest.raises(ValueError):
        report.canonical({"x": float("nan")})
    df = spark.createDataFrame([("r1", 1)], "run_id string, n int")
    report.write_snapshot(df, str(tmp_path / "snap"))
    with pytest.raises(Exception, match="exists"):
        report.write_snapshot(df, str(tmp_path / "snap"))
    for _ in range(2):
        report.append_history(df, str(tmp_path / "history"))
    assert spark.read.json(str(tmp_path / "history")).count() == 2
    assert report.archive(df, df.withColumn("run_id", F.lit("r2"))).count() == 2
    with pytest.raises(StateConflict):
        report.archive(df, df)
    assert report.inventory(spark, str(tmp_path / "b")).count() == 2
    assert report.freeze(df, str(tmp_path / "f1")) == report.freeze(spark.read.parquet(str(tmp_path / "f1")), str(tmp_path / "f2"))
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.json").write_text('{"k":1}')
    (tmp_path / "docs/b.json").write_text('{"k":1,"k":2}')
    rows, marks = offline.read_state(spark, str(tmp_path / "docs"), "k int")
    assert rows.count() == 1 and sorted(r["valid"] for r in marks.collect()) == [False, True]
    rows = spark.createDataFrame([(1, "c", "anchor", 1, "T1", 90.0), (2, "c", "anchor", 2, "T2", 80.0)], "paper_id int, category string, section string, place int, title string, total_score double")
    text = report.markdown_report(rows.where("paper_id = 1"), rows)
    assert "1. **T1** (90.0)" in text and "- T2 (80.0)" in text and "- T1" not in text
    report.preflight(spark.createDataFrame([("a",)], "path string"), spark.createDataFrame([("a",)], "path string"))


def test_stream_of_works_equals_the_batch(spark, tmp_path):
    schema = "work_id string, title string, category string, first_seen_at string, last_seen_at string, seen_count long, streams array<string>, access_depth string, oa_status string"
    rows = [(f"w{i % 5}", f"t{i}", "c", str(i), str(i), 1, [f"s{i % 2}"], "ABSTRACT" if i == 3 else "METADATA", "YES" if i == 6 else "UNKNOWN") for i in range(10, 30)]
    for k in range(4):
        spark.createDataFrame(rows[k * 5 : k * 5 + 5], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = state_stream.read(spark, str(tmp_path / "in"), schema, 1)
    none = spark.createDataFrame([], schema)
    q = state_stream.upsert_into(stream, lambda n: str(tmp_path / f"state/{n}"), none, str(tmp_path / "cp"))
    q.awaitTermination(120)
    last = max(int(p.name) for p in (tmp_path / "state").iterdir())
    got = {r["work_id"]: (r["first_seen_at"], r["last_seen_at"], r["seen_count"], r["streams"]) for r in spark.read.parquet(str(tmp_path / f"state/{last}")).collect()}
    assert got == {f"w{k}": (str(10 + k), str(25 + k), 4, ["s0", "s1"]) for k in range(5)}


def test_gated_stream_keeps_each_event_once(spark, tmp_path):
    e = lambda at: ("embargo_lifted", at, "s", "f", "", "date", "c")
    spark.createDataFrame([("e1", [e("2026-08-08")]), ("e2", [e("2026-08-01")]), ("e1", [e("2026-08-08")])], f"event_id string, events array<{EVENT}>").write.parquet(str(tmp_path / "in"))
    stream = state_stream.gated(state_stream.read(spark, str(tmp_path / "in"), f"event_id string, events array<{EVENT}>"), START, END)
    q = stream.select("event_id").writeStream.format("memory").queryName("gated").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r["event_id"] for r in spark.table("gated").collect()] == ["e1"]


def gap_runs(n, seed):
    """Runs of (checks, access, attempts) rows over a few sources and works."""
    import random

    rng, out = random.Random(seed), []
    for run in range(n):
        checks, access, attempts = [], [], []
        for s in "abcd":
            if rng.random() < 0.8:
                checks.append((s, rng.choice(["FAILED", "FAILED", "NOT_ATTEMPTED", "SUCCESS", "NO_RESULTS"])))
            for k in range(rng.randrange(3)):
                attempts.append((f"r{run}-{s}{k}", s, "", rng.choice(["FOLLOWUP", "DISCOVERY"]), rng.choice(["FAILED", "SUCCESS", "NOT_ATTEMPTED", "NO_RESULTS"]), rng.choice(["", "q"]), f"2026-08-{run + 1:02}"))
        for w in "xyz":
            if rng.random() < 0.7:
                access.append((f"p-{w}", "publisher", w, rng.choice(["FAILED", "FAILED", "SUCCESS", "PARTIAL"])))
                attempts.append((f"r{run}-{w}", "publisher", f"p-{w}", rng.choice(["FOLLOWUP", "CONTENT_FETCH"]), access[-1][3], "", ""))
        checks.append(("e", "FAILED"))
        attempts.append((f"r{run}-e", "e", "", "FOLLOWUP", "FAILED", "", ""))
        if run < n - 1:
            checks.append(("f", "FAILED" if run < n - 2 else "SUCCESS"))
            attempts.append((f"r{run}-f", "f", "", "FOLLOWUP" if run in (1, n - 2) else "DISCOVERY", checks[-1][1], "", ""))
        access.append(("o", "openalex", "x", "FAILED"))
        out.append((checks, access, attempts))
    return out


def test_gaps_as_tables_and_as_a_stream(spark, tmp_path, request):
    runs = gap_runs(5, 3)
    day = lambda run: datetime(2026, 8, 1 + run, 12)
    at = lambda run: F.lit(f"{day(run)}").cast("timestamp")
    prior, told, want = spark.createDataFrame([], gaps.GAP), [], {}
    for run, (checks, access, attempts) in enumerate(runs):
        found = gaps.evidence(spark.createDataFrame(checks, "source_id string, status string"), spark.createDataFrame(access, "source_id string, provider string, work_id string, status string"), spark.createDataFrame(attempts, "attempt_id string, source_id string, source_access_id string, stage string, status string, query string, attempted_at string"))
        found = spool(found, "evidence")
        found.withColumns({"run_id": F.lit(f"r{run}"), "run_at": at(run)}).coalesce(1).write.parquet(str(tmp_path / f"in/run={run}"))
        told.append({r["gap_id"]: r for r in gaps.followups(found, prior, at(run)).collect()})
        before, prior = {r["gap_id"]: r for r in prior.collect()}, spool(gaps.after_run(found, prior, f"r{run}", at(run)), "gaps")
        for r in found.collect():  # table by table, as gap by gap
            x = r.asDict(recursive=True)
            new = gap_stream.moved_on(before[x["gap_id"]].asDict() if x["gap_id"] in before else None, x, f"r{run}", day(run))
            if new:
                want[x["gap_id"]] = new
    got = {r["gap_id"]: r.asDict() for r in prior.collect()}
    assert got == want and {r["status"] for r in got.values()} == {"OPEN", "RESOLVED", "UNRESOLVABLE"}
    assert {r["outcome"] for t in told for r in t.values()} == {"RESOLVED", "STILL_OPEN"} and all(r["attempt_id"] in [a[0] for a in runs[i][2] if a[3] == "FOLLOWUP"] for i, t in enumerate(told) for r in t.values())

    schema = f"{gaps.EVIDENCE}, run_id string, run_at timestamp"
    spark.createDataFrame([("z", "SOURCE_UNAVAILABLE", "SOURCE_SYSTEM", "z", False, False, [], "r99", datetime(2027, 6, 1))], schema).write.parquet(str(tmp_path / "last/run=99"))

    def go(path):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
        keep = lambda rows, n: rows.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={n}"))
        q = gap_stream.gap_stream(stream).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(300)
        return spark.read.parquet(str(tmp_path / "out")).collect()

    for run in range(len(runs)):  # one after the other, in the order of files' times
        for f in (tmp_path / f"in/run={run}").iterdir():
            os.utime(f, (1_000_000 + run * 1000, 1_000_000 + run * 1000))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.shuffle.partitions", partitions))
    rows = go(str(tmp_path / "in"))
    last = {}
    for r in rows:
        if r["kind"] == gap_stream.CHANGED:
            last[r["gap_id"]] = max(last.get(r["gap_id"], ("", None)), (r["run_id"], r.asDict()), key=lambda x: x[0])
    assert {k: {c: v[1][c] for c in gap_stream.FIELDS} for k, v in last.items()} == want
    assert all(r["cooldown_until"] is not None and r["status"] == "OPEN" for r in rows if r["kind"] == gap_stream.DUE)
    (tmp_path / "last/run=99").rename(tmp_path / "in/run=99")
    for f in (tmp_path / "in/run=99").iterdir():
        os.utime(f, (2_000_000, 2_000_000))
    more = go(str(tmp_path / "in"))
    assert {r["gap_id"] for r in more if r["kind"] == gap_stream.FORGOTTEN} == {k for k, r in want.items() if r["status"] != "OPEN"}
    assert {r["gap_id"] for r in rows + more if r["kind"] == gap_stream.DUE} >= {k for k, r in want.items() if r["status"] == "OPEN" and r["cooldown_until"]}


def test_inventories(spark):
    schema = "record_id string, doi string, landing_url string, title string, publication_date string, authors array<string>, venue string, summary string"
    feed = spark.createDataFrame([("f1", "10.1/a", "u1", "Sleep and memory", "2026-08-08", [], "", "x"), ("f2", "10.1/b", "u2", "Cooking at home", "2026-08-08", [], "", ""), ("f3", "10.1/c", "u3", "Sleep, long ago", "2020-01-01", [], "", "")], schema)
    registry = spark.createDataFrame([("r1", "10.1/a", "", "Other", "2026-08-07", ["A"], "V", ""), ("r2", "10.1/d", "u4", "More sleep", "2026-08-09", [], "", "")], schema)
    got = [(r["record_id"], r["venue"]) for r in inventory.feed_inventory(feed, registry, "2026-08-06", "2026-08-09", '"sleep"').collect()]
    assert got == [("r2", ""), ("f1", "V")]
    rows, done = inventory.sharded(feed.unionByName(feed), spark.createDataFrame([("s", "a", True), ("s", "b", False)], "source_id string, shard string, complete boolean"), 2)
    assert [r["record_id"] for r in rows.collect()] == ["f1", "f2"] and done.first()["complete"] is False
    conf = spark.createDataFrame([("a", "publisher_listing_v1", 2), ("b", "publisher_listing_v1", 0), ("c", "rss", 0)], "source_id string, template string, n_shards int")
    assert [r["adapter"] for r in inventory.dispatch(conf).orderBy("source_id").collect()] == ["sharded_listing", "listing", "feed"]
    obs = spark.createDataFrame([("o1", ["q1"]), ("o1", ["q9"])], "observation_id string, query_ids array<string>")
    q = spark.createDataFrame([("q1", 1, 2)], "query_id string, raw_count int, unique_count int")
    assert sorted(map(tuple, inventory.input_faults(obs, q).collect())) == [("observation_unique", "o1"), ("query_known", "q9"), ("raw_at_least_unique", "q1")]
    line = inventory.metadata_summary("{topic}: {kind} in {venue}, {date}", {"sleep": ("sleep", "rest")}, "other")
    one = feed.where("record_id = 'f1'").withColumn("document_type", F.lit("journal_article"))
    assert one.select(line.alias("s")).first()["s"] == "sleep: journal article in , 2026-08-08"


@pytest.mark.parametrize(("url", "fine"), [("https://example.org/x", True), ("http://8.8.8.8:80/", True), ("https://user@example.org/", False), ("https://example.org:8443/", False), ("http://localhost/", False), ("http://192.168.1.1/", False), ("http://172.20.0.1/", False), ("http://[::1]/", False), ("ftp://example.org", False), ("http://2130706433/", False), (None, False), ("http://printer.local/", False)])
def test_public_urls(spark, url, fine):
    assert spark.createDataFrame([(url,)], "u string").select(inventory.is_public_url(F.col("u")).alias("v")).first()["v"] is fine


def crossref_page(n, total, following):
    return json.dumps({"message": {"total-results": total, "next-cursor": following, "items": [{"DOI": f"10.1/{following}-{i}", "title": [f"Paper {i}"], "published-online": {"date-parts": [[2026, 8, 8]]}} for i in range(n)]}})


def test_cursor_chains_are_followed_to_their_end_or_fault(spark, tmp_path):
    stores = {
        "whole": {"*": (2, 5, "a/b"), "a/b": (2, 5, "c"), "c": (1, 5, "d"), "d": (9, 5, "")},  # d is never opened
        "stalled": {"*": (2, 9, "x"), "x": (2, 9, "*")},
        "same": {"*": (2, 9, "*")},
        "early": {"*": (2, 9, "x"), "x": (0, 9, "y")},
        "untold": {"*": (3, None, "x"), "x": (2, None, "y"), "y": (3, None, "z")},
        "endless": {"*": (3, 99, "1"), **{str(i): (3, 99, str(i + 1)) for i in range(1, 9)}},
        "gone": {"*": (2, 9, "lost")},
        "none": {"*": (0, 0, "")},
    }
    for name, pages in stores.items():
        (tmp_path / "crossref" / name).mkdir(parents=True)
        for cursor, page in pages.items():
            (tmp_path / "crossref" / name / f"{cursor.replace('/', '%2F').replace('*', '%2A')}.json").write_text(crossref_page(*page))
    (tmp_path / "crossref" / "broken").mkdir()
    (tmp_path / "crossref" / "broken" / "%2A.json").write_text('{"message": {"items": 3}}')
    offline.register(spark)
    read = spark.read.format("chains").options(path=str(tmp_path), maxPages="4", fullPage="3", pauseSeconds="0", attempts="2", inventoriesPerPartition="3")
    rows = read.load()
    assert rows.rdd.getNumPartitions() == 3
    got = {r["inventory_id"]: r for r in chains.inventory_receipts(rows).collect()}
    said = {k: (r["pages_requested"], r["pages_received"], r["attempts"], r["faults"], r["complete"]) for k, r in got.items()}
    assert said == {
        "whole": (3, 3, 3, [], True), "stalled": (2, 2, 2, ["STALLED"], False), "same": (1, 1, 1, ["STALLED"], False), "early": (2, 2, 2, ["ENDED_EARLY"], False), "untold": (2, 2, 2, [], True),
        "endless": (4, 4, 4, ["TOO_MANY_PAGES"], False), "gone": (2, 1, 3, ["REQUEST_FAILED: FileNotFoundError"], False), "none": (1, 1, 1, [], True), "broken": (1, 1, 1, ["INVALID_PAYLOAD"], False),
    }
    assert got["whole"]["n_bytes"] == sum(len(crossref_page(*stores["whole"][c])) for c in ("*", "a/b", "c"))
    parsed = payloads.crossref_pages(rows.where("body IS NOT NULL").select("inventory_id", "page", "body")).groupBy("inventory_id").count()
    assert {r["inventory_id"]: r["count"] for r in parsed.collect()}["whole"] == 5


def test_listings_stop_before_pages_older_than_the_window(spark, tmp_path):
    page = lambda *days: "".join(f"<article>Published online by X: {d} August 2026</article>" for d in days)
    stores = {
        "stops": [page(9, 8), page(8, 7, 5), "x" * 5000], "shuffled": [page(7, 9), page(7, 2)], "back": [page(9, 8), page(9, 2), page(2, 1)], "open": [page(9), page(8), page(8), page(8)], "empty": ["", page(3)], "short": [page(9)],
    }
    for name, pages in stores.items():
        (tmp_path / "press" / name).mkdir(parents=True)
        for i, text in enumerate(pages, 1):
            (tmp_path / "press" / name / f"{i}.html").write_text(text)
    offline.register(spark)
    rows = spark.read.format("chains").options(path=str(tmp_path), kind="numbered", start="2026-08-06", datePattern="by X: ([^<]+)<", maxPages="3", pauseSeconds="0").load()
    got = {r["inventory_id"]: (r["pages_requested"], r["faults"]) for r in chains.inventory_receipts(rows).collect()}
    assert got == {"stops": (2, []), "shuffled": (2, ["NOT_DESCENDING"]), "back": (3, ["NOT_MONOTONIC"]), "open": (3, ["WINDOW_NOT_CLOSED"]), "empty": (2, []), "short": (2, ["REQUEST_FAILED: FileNotFoundError"])}
    assert rows.where("inventory_id = 'stops'").agg(F.sum("n_bytes")).first()[0] == len(stores["stops"][0]) + len(stores["stops"][1])


def test_flaky_stores_make_rows_and_open_circuits(spark, tmp_path):
    log = str(tmp_path / "log")

    def flaky(path, most):
        """The first attempt at every file fails; what is named dead always does."""
        import os

        n = len(os.listdir(log)) if os.path.isdir(log) else 0
        os.makedirs(f"{log}/{n:05}-{os.path.basename(os.path.dirname(path))}-{os.path.basename(path)}")
        if "dead" in path or not sum(x.endswith(f"-{os.path.basename(os.path.dirname(path))}-{os.path.basename(path)}") for x in os.listdir(log)) > 1:
            raise ConnectionError(path)
        return offline.open_local(path, most)

    class Flaky(chains.ChainSource):
        opener = staticmethod(flaky)

        @classmethod
        def name(cls):
            return "flaky_chains"

    class FlakyPayloads(offline.PayloadSource):
        opener = staticmethod(flaky)

        @classmethod
        def name(cls):
            return "flaky_payloads"

    for source, name in (("a", "1"), ("b", "dead1"), ("b", "dead2"), ("b", "dead3"), ("c", "big")):
        (tmp_path / "store" / source / name).mkdir(parents=True)
        (tmp_path / "store" / source / name / "%2A.json").write_text(crossref_page(1, 1, "") + (" " * 3000 if name == "big" else ""))
    spark.dataSource.register(Flaky)
    read = lambda **o: spark.read.format("flaky_chains").options(path=str(tmp_path / "store"), pauseSeconds="0", maxBytes="2000", **o).load()
    receipts = spool(chains.inventory_receipts(read(mostFailures="2")), "receipts")
    got = {(r["source"], r["inventory_id"]): (r["attempts"], r["pages_received"], r["faults"]) for r in receipts.collect()}
    failed = ["REQUEST_FAILED: ConnectionError"]
    assert got == {("a", "1"): (2, 1, []), ("b", "dead1"): (3, 0, failed), ("b", "dead2"): (3, 0, failed), ("b", "dead3"): (0, 0, ["CIRCUIT_OPEN"]), ("c", "big"): (3, 0, ["REQUEST_FAILED: TooLarge"])}
    assert chains.open_circuits(receipts, 1) == '["b"]'
    again = read(skip=chains.open_circuits(receipts, 1))
    assert {r["source"] for r in again.where("fault = 'CIRCUIT_OPEN'").collect()} == {"b"} and again.where("source = 'a'").count() == 1

    (tmp_path / "flat" / "s").mkdir(parents=True)
    for i in range(9):
        (tmp_path / "flat" / "s" / f"{'dead' if i == 4 else 'q'}{i}@2026-08-0{i + 1}.json").write_text("é" * i)
    spark.dataSource.register(FlakyPayloads)
    flat = spark.read.format("flaky_payloads").options(path=str(tmp_path / "flat"), pauseSeconds="0", partitionBytes=str(3 << 16))
    rows = flat.load()
    assert rows.rdd.getNumPartitions() == 3
    got = {r["query_id"]: (r["body"], r["attempts"], r["fault"]) for r in rows.collect()}
    assert got == {f"q{i}": ("é" * i, 2, None) for i in range(9) if i != 4} | {"dead4": (None, 3, "ConnectionError")}
    with pytest.raises(Exception, match="ConnectionError"):
        flat.option("mode", "FAILFAST").load().count()


def test_pages_are_the_report_without_the_driver(spark, tmp_path):
    rows = [(f"w{i:02}", f"c<{i % 3}>" if i % 11 else None, i % 3 if i % 11 else 9, i // 3, f"T & \"{i}\" it's", None if i % 4 else "V", "PRIORITY") for i in range(45)]
    ledger = spark.createDataFrame(rows, "work_id string, category string, category_rank int, display_rank int, title string, venue string, triage_status string")
    best = ledger.where("display_rank % 5 = 2").select("work_id")
    whole = report.html_report(ledger.fillna({"category": ""}), best, "A & B")
    roots = set()
    for per_part in (4, 4, 500):
        path = str(tmp_path / f"pages{len(roots)}-{per_part}-{len(list(tmp_path.iterdir()))}")
        root = pages.write_pages(ledger.repartition(5), best, "A & B", path, per_part)
        roots.add((per_part, root))
        assert pages.broken_parts(spark, path).count() == 0
        assert pages.assemble(spark, path, "A & B", str(tmp_path / "one.html")) == len(whole) and (tmp_path / "one.html").read_bytes() == whole
        assert spark.read.parquet(f"{path}/manifest").where("n_cards > " + str(per_part)).count() == 0
    assert len(roots) == 2  # equal ledgers, equal roots
    for f in (tmp_path / path.split("/")[-1] / "parts").rglob("*.txt"):
        f.write_text(f.read_text().replace("w07", "w70"))
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    assert pages.broken_parts(spark, path).count() == 1
    assert pages.write_pages(ledger.limit(0), best, "x", str(tmp_path / "none")) is None
