"""Text, identifiers, urls, dates, ids and query dialects on single rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from paperloom.functions import dialects, ids
from paperloom.functions import normalize as N
from paperloom.functions import text as T


@pytest.fixture
def value(spark):
    def get(column, **cols):
        row = spark.range(1)
        for k, v in cols.items():
            row = row.withColumn(k, F.lit(v) if not isinstance(v, list | dict) else F.array(*map(F.lit, v)) if isinstance(v, list) else F.create_map(*[x for p in v.items() for x in (F.lit(p[0]), F.lit(p[1]) if not isinstance(p[1], list) else F.array(*map(F.lit, p[1])))]))
        return row.select(column.alias("v")).first()["v"]

    return get


@pytest.mark.parametrize(("term", "text", "hit"), [("ai", "paired", False), ("ai", "an AI system", True), ("large language model", "Large  language\nmodels", False), ("large language model*", "large language models", True), ("résumé", "my résumé", False), ("*", "x", False), ("", "x", False), ("r&d", "R&amp;D here", True)])
def test_terms_match_on_boundaries(value, term, text, hit):
    assert value(T.contains_term(T.fold_markup(F.col("t")), term), t=text) is hit


def test_query_matchers_differ_on_phrases(value):
    q = '"exact phrase" model training'
    assert value(T.matches_core_query(F.lower("t"), q), t="some training") is True
    assert value(T.matches_feed_query(F.lower("t"), q), t="some training") is False
    assert value(T.matches_feed_query(F.lower("t"), "*"), t="x") is True
    assert value(T.matches_core_query(F.lower("t"), "the of"), t="x") is True


def test_text_pieces(value):
    assert value(T.strip_markup(F.col("t")), t="<b>a</b>&amp;<i> b</i>\n c") == "a & b c"
    assert value(N.title_key(F.col("t")), t="Résumé: a-B!") == "re sume a b"
    assert value(T.truncate(F.col("t"), 20), t="one two three, four five six") == "one two three…"
    assert value(T.truncate(F.col("t"), 20), t="short  one") == "short one"
    assert value(T.excerpt(F.col("t")), t="Background is long. We aimed to test this. It worked well.") == "We aimed to test this. It worked well."
    assert value(T.excerpt(F.col("t")), t="") == ""
    assert value(T.redact(F.col("t"), ["s3cret"]), t="k=s3cret api_key=1&EMAIL=a@b c") == "k=[REDACTED] api_key=[REDACTED]&EMAIL=[REDACTED] c"
    assert value(T.title_translation_ok(F.lit("RCT of 12 adults"), F.col("t")), t="12 名成人的試驗") is True
    assert value(T.title_translation_ok(F.lit("RCT of 12 adults"), F.col("t")), t="成人的試驗") is False
    assert value(T.translation_faults(F.lit("RCT of 12"), F.lit(""), F.lit("12 試驗"), F.lit("13 人")), x=1) == ["TITLE_LOST_ABBREVIATION", "SUMMARY_NEW_NUMBER"]


@pytest.mark.parametrize(("raw", "core", "feed"), [("https://doi.org/10.1234/AbC.1 .", "10.1234/abc.1", "10.1234/abc.1"), ("doi: 10.5555/X", "10.5555/x", "10.5555/x"), ("10.12/short", "10.12/short", ""), (None, "", ""), ("see 10.4321/q;", "see 10.4321/q;", "10.4321/q")])
def test_dois(value, raw, core, feed):
    assert value(N.doi(F.col("t").cast("string")), t=raw) == core
    assert value(N.feed_doi(F.col("t").cast("string")), t=raw) == feed


@pytest.mark.parametrize(("raw", "want"), [("HTTP://Ex.ORG/a/?utm_source=x&b=2&a=1#f", "http://ex.org/a/?a=1&b=2"), ("https://ex.org/a/", "https://ex.org/a"), ("https://ex.org/", "https://ex.org/"), ("ftp://ex.org/a", ""), ("nonsense", ""), ("https://ex.org?gclid=1&x", "https://ex.org?x=")])
def test_canonical_urls(value, raw, want):
    assert value(N.canonical_url(F.col("t")), t=raw) == want


def test_urls_of_a_work(spark):
    row = {"title": "T", "source": "europe_pmc", "doi": "10.1/A b", "pmid": "7", "pmcid": "PMC1", "arxiv_id": "2401.1", "anthology_id": "", "openalex_id": "https://openalex.org/W1", "landing_url": "https://europepmc.org/x"}
    df = spark.createDataFrame([row])
    got = df.select(N.work_id().alias("w"), N.fulltext_urls().alias("f"), N.discovery_urls().alias("d"), N.publisher_url().alias("p"), N.identifiers().alias("i")).first()
    assert got["w"] == "doi:10.1/a b"
    assert got["f"] == ["https://pmc.ncbi.nlm.nih.gov/articles/PMC1/", "https://pmc.ncbi.nlm.nih.gov/articles/PMC1/pdf", "https://arxiv.org/pdf/2401.1"]
    assert got["d"][3:] == ["https://arxiv.org/abs/2401.1", "https://europepmc.org/articles/PMC1", "https://europepmc.org/x", "https://doi.org/10.1/a%20b", "https://pubmed.ncbi.nlm.nih.gov/7/", "https://openalex.org/W1"]
    assert got["p"] == "https://doi.org/10.1/a%20b" and got["i"]["pmid"] == "7" and "anthology_id" not in got["i"]
    bare = spark.createDataFrame([row | {"doi": "", "pmcid": ""}]).select(N.publisher_url().alias("p")).first()
    assert bare["p"] == ""


@pytest.mark.parametrize(("raw", "want"), [("2024-02-03", "2024-02-03"), ("2024-02-03T23:59:00-11:00", "2024-02-03"), ("Tue, 06 Feb 2024 10:00:00 GMT", "2024-02-06"), ("2024-02", ""), ("2024-13-01", ""), ("soon", ""), ("", "")])
def test_provider_dates(value, raw, want):
    assert value(N.provider_date(F.col("t")), t=raw) == want


def test_other_dates(value):
    assert value(N.epoch_date(F.col("t")), t="1706745600000") == "2024-02-01"
    assert value(N.epoch_date(F.col("t")), t="1706745600") == "2024-02-01"
    assert value(N.lenient_date(F.lit("2024"), F.lit("Feb"), F.lit("30")), x=1) == "2024-01-01"
    assert value(N.lenient_date(F.lit("2024"), F.lit("December"), F.lit("")), x=1) == "2024-12-01"
    assert value(N.lenient_date(F.lit(""), F.lit("1"), F.lit("1")), x=1) == ""
    assert value(N.guarded_date(F.lit("2024-05-01"), F.lit("https://aclanthology.org/2023.acl-long.1/")), x=1) == ""
    assert value(N.guarded_date(F.lit("2023-05-01"), F.lit("https://aclanthology.org/2023.acl-long.1/")), x=1) == "2023-05-01"
    assert value(N.date_after_label(F.lit("x Published online 5 March 2024 y"), "Published online"), x=1) == "2024-03-05"
    day, venue, authors = N.labelled_citation(F.lit("<p>Publication date: Available online 3 August 2024</p><p>Source: The Journal, Volume 9</p><p>Author(s): A B, C D</p>"))
    assert (value(day, x=1), value(venue, x=1), value(authors, x=1)) == ("2024-08-03", "The Journal", ["A B", "C D"])
    parts = F.array(F.array(F.lit(2024), F.lit(2)))
    assert value(N.parts_date([("published", parts)])[0], x=1) == "2024-02-01"
    assert value(N.parts_date([("a", F.array(F.array(F.lit(2024), F.lit(13)))), ("b", parts)])[1], x=1) == "b"
    assert value(N.parts_date([("a", F.array(F.array(F.lit(2024), F.lit(13))))], lenient=True)[0], x=1) == "2024-01-01"


def test_small_ids_and_links(value):
    assert value(N.arxiv_id(F.col("t")), t="http://arxiv.org/abs/2401.01234v2") == "2401.01234"
    assert value(N.terminal_id(F.col("t")), t="https://openalex.org/W12/") == "W12"
    assert value(N.feed_link(F.col("t")), t="https://www.sciencedirect.com/a?dgcid=rss&x=1") == "https://www.sciencedirect.com/a?x=1"
    assert value(N.feed_link(F.col("t")), t="https://www.sciencedirect.com/a?dgcid=rss") == "https://www.sciencedirect.com/a"
    assert value(N.with_page(F.col("t"), "p", F.lit(3)), t="https://x.org/l?p=1&q=2") == "https://x.org/l?q=2&p=3"
    assert value(N.container_identity(F.col("t"), r"/journals/([^/]+)/", "cup"), t="https://x.org/core/journals/Nutrition/article/1") == "cup:nutrition"
    assert value(N.ordered_unique_urls(F.col("t")), t=[" https://b.org ", "x", "https://a.org", "https://b.org"]) == ["https://b.org", "https://a.org"]
    assert value(N.inverted_abstract(F.col("t")), t={"b": [1], "a": [0, 2]}) == "a b a"


def test_stable_ids_are_hashes_of_lists(value):
    import hashlib

    want = "src-" + hashlib.sha256('["https://x.org/é"]'.encode()).hexdigest()[:24]
    assert value(ids.stable_id("src", F.lit("https://x.org/é")), x=1) == want
    assert value(ids.strict_json(F.col("t")).isNull(), t='{"a":1,"a":2}') is True
    assert value(ids.strict_json(F.col("t")).isNull(), t='{"a":NaN}') is True
    assert value(ids.canonical_json(F.col("t")), t='{"b":1,"a":[{"d":1,"c":2}]}') == '{"a":[{"c":2,"d":1}],"b":1}'


def test_dialects_push_the_window_down():
    a, b = date(2024, 1, 1), date(2024, 1, 3)
    assert dialects.europe_pmc('"Sports Med"[Journal] AND sleep[title/abstract] AND x[odd]', a, b) == '(JOURNAL:"Sports Med" AND TITLE_ABS:sleep AND x) AND (FIRST_PDATE:[2024-01-01 TO 2024-01-03] OR FIRST_IDATE:[2024-01-01 TO 2024-01-03] OR E_PDATE:[2024-01-01 TO 2024-01-03])'
    assert dialects.arxiv('"large language model" sycophancy', a, b) == '(all:"large language model" AND (all:"sycophancy")) AND submittedDate:[202401010000 TO 202401032359]'
    assert dialects.translate("pubmed", "q", a, b) == "q"
    assert dialects.openalex("q", a, b, 500)["per-page"] == "200"
