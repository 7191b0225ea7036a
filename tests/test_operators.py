"""Operators on small tables: classification, windows, resolution, ranking, state, coverage, rules and queues."""

import copy
import json
import random
from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.operators import access, classify, coverage, digests, events, facets, graph, json_schema, queue, rank, resolve, rules, score, state
from paperloom.operators.state import StateConflict
from paperloom.schema import CANDIDATE, EVENT, IDENTIFIERS, LOCATION, PAPER
from paperloom.sources.payloads import as_candidates

TOKYO = ZoneInfo("Asia/Tokyo")
START, END = datetime(2026, 8, 6, 12, tzinfo=TOKYO), datetime(2026, 8, 9, 12, tzinfo=TOKYO)


def candidates(spark, *rows):
    """Rows of some candidate columns as whole candidates."""
    fields = {f.name: f.dataType for f in spark.createDataFrame([], CANDIDATE).schema}
    names = sorted({k for r in rows for k in r})
    schema = ", ".join(f"{n} {fields[n].simpleString()}" if n in fields else f"{n} string" for n in names)
    return as_candidates(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema))


def event(kind, at, precision="date"):
    return (kind, at, "s", "f", "", precision, "c")


def papers(spark, *rows):
    base = {"title": "", "abstract": "", "journal_or_venue": "", "stream": "sport_science", "secondary_streams": [], "source": "s", "publication_date": "2026-08-08", "doi": "", "pmid": "", "pmcid": "", "openalex_id": "", "publication_types": [], "is_preprint": False, "open_access": None, "repository_versions": []}
    return spark.createDataFrame([tuple((base | r)[c.split()[0]] for c in PAPER.split(", ")) for r in rows], PAPER)


# --- classification


@pytest.mark.parametrize(("row", "kind", "designs", "basis"), [
    ({"title": "A randomized controlled trial", "source": "pubmed"}, "journal_article", ["randomized_controlled_trial"], "TITLE_EXPLICIT"),
    ({"title": "Rationale of a randomized controlled trial", "provider_publication_types": ["Randomized Controlled Trial"]}, "unknown", [], "UNKNOWN"),
    ({"title": "Study protocol for X", "is_preprint": True, "source": "arxiv"}, "preprint", ["protocol"], "TITLE_EXPLICIT"),
    ({"title": "X", "provider_publication_types": ["preprint", "Journal Article", "Review"]}, "journal_article", ["review"], "PROVIDER_METADATA"),
    ({"title": "Systematic review of mice", "provider_publication_types": ["Meta-Analysis"]}, "unknown", ["meta_analysis", "systematic_review"], "PROVIDER_METADATA_AND_TITLE"),
    ({"title": "Clinical practice guideline"}, "guideline", [], "UNKNOWN"),
    ({"title": "Paper", "source": "PMLR"}, "conference_paper", [], "UNKNOWN"),
])
def test_two_axis_classification(spark, row, kind, designs, basis):
    got = classify.classify(candidates(spark, row)).first()
    assert (got["document_type"], got["study_designs"], got["study_design_basis"]) == (kind, designs, basis)


def test_stable_types(spark):
    got = classify.classify(candidates(spark, {"title": "x", "provider_publication_types": ["review", " Review ", "", "ARTICLE", "article"]})).first()
    assert got["provider_publication_types"] == ["ARTICLE", "Review"]


@pytest.mark.parametrize(("row", "want"), [
    ({"title": "Re: something"}, ("Correspondence", "Letter/U", 12)),
    ({"title": "Protocol for a trial"}, ("Protocol", "Protocol/U", 25)),
    ({"title": "Effects in mice", "abstract": "a randomized controlled trial"}, ("Preclinical study", "Preclinical/U", 40)),
    ({"title": "A cohort study", "abstract": "participants were randomly assigned"}, ("Cohort study", "Cohort/B+", 70)),
    ({"title": "Training", "abstract": "participants were randomly assigned"}, ("Randomized controlled trial", "RCT/A", 88)),
    ({"title": "Nothing", "is_preprint": True}, ("Preprint", "Preprint/U", 35)),
])
def test_study_rules(spark, row, want):
    assert tuple(papers(spark, row).select(classify.study().alias("s")).first()["s"]) == want


def test_base_study_lowers_preprints(spark):
    got = papers(spark, {"title": "A systematic review", "is_preprint": True}, {"title": "A survey", "is_preprint": True}).select(classify.base_study().alias("s"))
    assert [tuple(r["s"]) for r in got.collect()] == [("Systematic review", "SR/U", 70), ("Survey", "Survey/U", 30)]


def test_directions_and_categories(spark):
    rows = papers(spark, {"title": "Retrieval in a large language model", "stream": "llm_l9_evaluation_measurement"}, {"title": "Trust in a chatbot", "stream": "clinical_medicine"}, {"title": "x", "stream": "human_h1_llm_relationship", "secondary_streams": ["llm_l3_retrieval_grounding"]}, {"title": "x", "stream": "sport_science", "secondary_streams": ["sport_nutrition"]})
    got = rows.select(classify.directions().alias("d"), classify.primary_direction().alias("p"), classify.category().alias("c"), classify.sample_size().alias("n")).collect()
    assert [(r["d"], r["p"], r["c"]) for r in got] == [(["L3", "L9"], "L9", "llm_research"), (["H1", "H2"], "H1", "human_ai"), (["L3", "H1"], "H1", "human_ai"), ([], None, "sport_nutrition_fitness")]


def test_paper_scores(spark):
    row = {"title": "Resistance training: a randomized controlled trial", "abstract": "sample of 1,200 athletes, n = 90; health", "stream": "sport_science"}
    got = score.paper_scores(papers(spark, row), ["training", "athletes"]).first()
    assert (got["study_design"], got["evidence_score"], got["relevance_score"], got["interest_score"], got["practical_score"]) == ("Randomized controlled trial", 88, 79, 65, 66)
    assert got["total_score"] == round(88 * 0.4 + 79 * 0.3 + 65 * 0.2 + 66 * 0.1, 1)
    rows = score.paper_scores(papers(spark, row, {"title": "Cooking"}), ["training"]).withColumn("exclusion_reason", classify.exclusion_reason()).select("exclusion_reason", rank.section().alias("s"), classify.caveat().alias("c"), classify.reason().alias("r"))
    good, bad = rows.collect()
    assert (good["exclusion_reason"], good["s"], good["c"]) == (None, "anchor", "RANDOMISATION_AND_ENDPOINTS") and bad["s"] is None and "gate" in bad["exclusion_reason"]
    assert good["r"][:2] == ["Randomized controlled trial", "STRONG_DESIGN"]


# --- windows


@pytest.mark.parametrize(("e", "hit"), [
    (event("version_of_record_first_online", "2026-08-06"), False),
    (event("version_of_record_first_online", "2026-08-07"), True),
    (event("version_of_record_first_online", "2026-08-09"), True),
    (event("version_of_record_first_online", "2026-08-10"), False),
    (event("embargo_lifted", "2026-08-06T12:00:00", "timestamp"), True),
    (event("embargo_lifted", "2026-08-06T11:59:59", "timestamp"), False),
    (event("embargo_lifted", "2026-08-09T03:00:00Z", "timestamp"), True),
    (event("embargo_lifted", "2026-08-09T03:00:01Z", "timestamp"), False),
    (event("something_else", "2026-08-08"), False),
    (event("embargo_lifted", "soon", "timestamp"), False),
])
def test_window_by_precision(spark, e, hit):
    row = spark.createDataFrame([(e,)], f"e {EVENT}")
    assert row.select(events.in_window(F.col("e"), START, END).alias("v")).first()["v"] is hit


def test_qualifying_event_and_class(spark):
    two = [event("formal_version_verified", "2026-08-08"), event("version_of_record_first_online", "2026-08-08"), event("embargo_lifted", "2026-08-07")]
    rows = candidates(spark,
        {"title": "a", "events": two, "source": "pubmed"},
        {"title": "b", "events": two, "is_preprint": True},
        {"title": "c", "events": [event("first_formal_indexing", "2026-08-08")], "publication_date": "2026-07-01"},
        {"title": "Erratum to d", "events": two},
    )
    got = events.annotate(score.triage(classify.classify(rows), {}), START, END).orderBy("title").collect()
    assert [(r["title"][:1], r["event_class"], r["qualifying_event"] and r["qualifying_event"]["event_type"], r["triage_status"]) for r in got] == [
        ("E", "CORRECTION_NOTICE", "version_of_record_first_online", "PRIORITY"),
        ("a", "NEW_PUBLICATION", "version_of_record_first_online", "PRIORITY"),
        ("b", "OTHER", None, "LOWER_PRIORITY"),
        ("c", "BACKFILL_INDEXING", "first_formal_indexing", "PRIORITY"),
    ]
    shown = got[1].asDict(recursive=True)
    best = spark.createDataFrame([([tuple(e.values()) for e in shown["events"]],)], f"x array<{EVENT}>").select(events.display_event(F.array().cast(f"array<{EVENT}>"), F.col("x")).alias("v")).first()["v"]
    assert best["event_type"] == "embargo_lifted"


# --- resolution


def work(n, **more):
    return {"title": f"A long informative title number {n}", "publication_date": "2026-08-08", "authors": ["Ann Lee"], "source": "openalex", "events": [event("version_of_record_first_online", "2026-08-08")], **more}


def test_same_doi_is_one_work_with_everything(spark):
    a = work(1, doi="10.1/X", score=80, provider_publication_types=["article"], query_ids=["q1"])
    b = work(1, doi="https://doi.org/10.1/x", pmid="5", score=70, source="pubmed", provider_publication_types=["Randomized Controlled Trial"], abstract="text", query_ids=["q2"])
    for rows in ((a, b), (b, a)):
        (got,) = resolve.deduplicate(candidates(spark, *rows)).collect()
        assert (got["work_id"], got["score"], got["pmid"], got["abstract"], got["observed_sources"], got["query_ids"], got["n_observations"]) == ("doi:10.1/x", 80, "5", "text", ["openalex", "pubmed"], ["q1", "q2"], 2)
        assert got["study_designs"] == ["randomized_controlled_trial"]


@pytest.mark.parametrize(("rows", "n"), [
    ([work(1, doi="10.1/x"), work(1, pmid="9")], 1),
    ([work(1, doi="10.1/x"), work(1, pmid="9", authors=["Bo Ek"])], 2),
    ([work(1, doi="10.1/x"), work(1, pmid="9", publication_date="2026-08-07")], 2),
    ([work(1, doi="10.1/x", title="Editorial"), work(1, pmid="9", title="Editorial")], 2),
    ([work(1, doi="10.1/x"), work(1, doi="10.1/y")], 2),
    ([work(1, doi="10.1/x", authors=[]), work(1, authors=[])], 1),
    ([work(1, doi="10.1/x", authors=[]), work(1, authors=[], source="publisher")], 2),
])
def test_title_bridge_needs_evidence(spark, rows, n):
    assert resolve.deduplicate(candidates(spark, *rows)).count() == n


def test_formal_beats_preprint(spark):
    pre = work(1, doi="10.1/x", title="A preprint of a long informative title", is_preprint=True, source="arxiv", landing_url="https://arxiv.org/abs/1", events=[])
    formal = work(1, doi="10.1/x", landing_url="https://j.org/1", provider_publication_types=["journal-article"])
    (got,) = resolve.deduplicate(candidates(spark, pre, formal)).collect()
    assert (got["title"], got["is_preprint"], got["document_type"], got["landing_url"]) == (formal["title"], False, "journal_article", "https://j.org/1")


def test_transitive_conflict_aborts(spark):
    with pytest.raises(resolve.IdentityConflict, match="doi"):
        resolve.deduplicate(candidates(spark, work(1, doi="10.1/x", pmid="1"), work(2, pmid="1", pmcid="PMC1"), work(3, pmcid="PMC1", doi="10.1/y")))


def test_bridges_that_contradict_each_other_are_left_out(spark):
    rows = [work(1, doi="10.1/x"), work(1, pmid="1"), work(2, pmid="1"), work(2, doi="10.1/y")]
    got = resolve.deduplicate(candidates(spark, *rows)).collect()
    assert sorted(r["work_id"] for r in got) == ["doi:10.1/x", "doi:10.1/y"]
    assert {r["work_id"]: r["pmid"] for r in got} == {"doi:10.1/x": "1", "doi:10.1/y": ""}


def bridged_in_one_loop(rows):
    """Groups of observations after titles, in their order, bridged what agrees: observations are dicts, groups sets of places."""
    ids = lambda r: {(k, r[k]) for k in ("doi", "pmid") if r.get(k)}
    up = list(range(len(rows)))
    root = lambda i: i if up[i] == i else root(up[i])
    for i, r in enumerate(rows):
        for j in range(i):
            if ids(r) & ids(rows[j]) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    for title in sorted({r["title"] for r in rows}):
        groups = {}
        for i, r in enumerate(rows):
            if r["title"] == title:
                groups.setdefault(root(i), []).append(r)
        held = {x for i, r in enumerate(rows) if root(i) in groups for x in ids(r)}
        if len(groups) < 2 or len({k for k, _ in held}) < len(held):
            continue
        common = lambda f: set.intersection(*[{v for r in g for v in f(r) if v} for g in groups.values()])
        bare = any(not any(ids(r) for r in g) for g in groups.values())
        if common(lambda r: [r["publication_date"]]) and (common(lambda r: r["authors"]) or common(lambda r: [r["venue"]]) or (bare and common(lambda r: [r["source"]]))):
            for i in groups:
                up[root(i)] = min(root(j) for j in groups)
    out = {}
    for i in range(len(rows)):
        out.setdefault(root(i), set()).add(i)
    return sorted(map(sorted, out.values()))


def test_an_earlier_bridge_opens_a_later_one(spark):
    a, b = "An early title of some length", "Before long another title of length"
    rows = [work(0, title=a, doi="10.1/x"), work(0, title=b, doi="10.1/x"), work(0, title=a, pmid="2"), work(0, title=b, pmid="2", publication_date="2026-08-09"), work(0, title=b, pmcid="PMC3")]
    for small in (0, resolve.SMALL):
        got = resolve.fold(resolve.label(candidates(spark, *rows), small=small)).collect()
        assert [(r["n_observations"], r["doi"], r["pmid"], r["pmcid"]) for r in got] == [(5, "10.1/x", "2", "PMC3")]


@pytest.mark.parametrize("seed", range(2))
def test_bridges_go_in_the_order_of_titles(spark, seed):
    rng = random.Random(seed)
    n = 60
    rows = [
        {"title": f"The shared title number {rng.randrange(14):02} of many", "publication_date": f"2026-08-0{rng.choice([1, 1, 2])}", "authors": rng.choice([["A"], ["B", "A"], []]), "venue": rng.choice(["", "V"]), "source": rng.choice(["s1", "s2"]),
         "doi": rng.choice(["", "", f"10.1/{rng.randrange(40)}"]), "pmid": rng.choice(["", "", str(rng.randrange(40))]), "abstract": f"#{i}"}
        for i in range(n)
    ]
    while True:  # observations without contradictions
        try:
            resolve.label(candidates(spark, *rows), bridge=False)
            break
        except resolve.IdentityConflict:
            for r in rows:
                if r["doi"] and r["pmid"]:
                    r["pmid"] = ""
    want = bridged_in_one_loop(rows)
    assert 5 < len(want) < n - 5
    for small in (0, 30, resolve.SMALL):  # by rounds alone, handed over halfway, in one task
        groups = {}
        for r in resolve.label(candidates(spark, *rows), small=small).collect():
            groups.setdefault(r["component"], []).append(int(r["abstract"][1:]))
        assert sorted(map(sorted, groups.values())) == want


HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_joins_on_identifiers_split_a_hub(spark, monkeypatch):
    """Most of 400,000 observations have one identifier: each of the four joins on identifiers is one that AQE splits."""
    n, i = 400_000, F.col("id")
    hub = lambda mark: F.when(i % 9 > 0, mark).otherwise(F.concat(F.lit(mark), i.cast("string")))
    plans = []
    real = graph.with_least

    def watched(table, key, least):
        out = real(table, key, least)
        df = out.agg(F.count(F.lit(1)))
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    class Enough(Exception):
        pass

    def enough(*_):
        raise Enough

    before = {k: spark.conf.get(k, None) for k in HOT}
    try:
        for k, v in HOT.items():
            spark.conf.set(k, v)
        for module in (resolve, state):
            monkeypatch.setattr(module, "with_least", watched)
            monkeypatch.setattr(module, "components", enough)
        rows = spark.range(n).select(i.alias("_id"), hub("10.1/").alias("doi"), *[F.lit("").alias(c) for c in IDENTIFIERS if c != "doi"])
        resolve.identifier_edges(resolve.spool(rows, "rows"))
        works = spark.range(n).select(i.cast("string").alias("work_id"), i.alias("last_seen_at"), F.create_map(F.lit("doi"), hub("10.1/")).alias("identifiers"))
        feed = spark.range(n).select(hub("10.1/").alias("doi"), F.lit("").alias("landing_url"), F.lit("x").alias("title"), F.lit("").alias("publication_date"), F.array().cast("array<string>").alias("authors"), F.lit("").alias("venue"))
        old = spark.range(n).select(hub("t").alias("title"), F.lit("").alias("doi"), *[F.lit("").alias(c) for c in ("pmid", "pmcid", "openalex_id")])
        for f in (lambda: state.work_groups(works), lambda: resolve.merge_feed_and_registry(feed, feed.limit(0)), lambda: resolve.deduplicate_papers(old)):
            with pytest.raises(Enough):
                f()
        assert [("skew=true" in p) for p in plans] == [True] * 4
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_feed_and_registry(spark):
    schema = "record_id string, doi string, landing_url string, title string, publication_date string, authors array<string>, venue string"
    feed = spark.createDataFrame([("f1", "10.1/a", "u1", "The title of the first paper", "2026-01-01", [], ""), ("f2", "", "u2", "The title of the second paper", "2026-01-02", ["A B"], ""), ("f3", "10.1/c", "", "Editorial", "2026-01-03", ["A"], "V")], schema)
    registry = spark.createDataFrame([("r1", "10.1/A", "", "other words", "2025-01-01", ["X"], "Venue"), ("r2", "10.1/b", "", "The Title of the second paper", "2026-01-02", ["A. B"], "V2"), ("r3", "10.1/d", "", "Editorial", "2026-01-03", ["A"], "V")], schema)
    got = {r["record_id"]: (r["doi"], r["title"], r["venue"], r["n_records"]) for r in resolve.merge_feed_and_registry(feed, registry).collect()}
    assert got == {"f1": ("10.1/a", "The title of the first paper", "Venue", 2), "f2": ("10.1/b", "The title of the second paper", "V2", 2), "f3": ("10.1/c", "Editorial", "V", 1), "r3": ("10.1/d", "Editorial", "V", 1)}


def test_papers_deduplicate_by_key_or_title(spark):
    rows = score.paper_scores(papers(spark, {"title": "One study", "doi": "10.1/a", "stream": "sport_science"}, {"title": "One  Study!", "pmid": "3", "stream": "fitness_health", "abstract": "randomized"}, {"title": "Other"}), ["x"])
    got = {r["title"]: r for r in resolve.deduplicate_papers(rows).collect()}
    assert len(got) == 2 and next(r for r in got.values() if r["doi"])["pmid"] == "3"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components_equal_union_find(spark, edges):
    up = list(range(13))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        up[q] = p
    got = graph.components(spark.range(13).select("id"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in got} == {x: root(x) for x in range(13)}


def test_components_of_paths_and_hubs(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 90)] + [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(5)] + [(7, 7), (5, 4), (5, 4)]
    rng.shuffle(edges)
    ids = list(range(3000))
    rng.shuffle(ids)
    edges = [(ids[a], ids[b]) for a, b in edges]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((root(a), root(b)))
            up[q] = p
    for small in (graph.SMALL, 40, 0):  # in one task, handed over to it halfway, and by rounds alone
        got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), small=small).collect()}
        assert got == {x: root(x) for x in list(up)}


def test_components_of_a_hub_and_its_join(spark):
    n = 300_000
    edges = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = graph.connected_components(edges, small=0)
    assert got.agg(F.count("*"), F.max("component")).first()[:] == (n, 0)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        star = graph.spool(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "hub")
        least = graph.spool(star.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = graph.with_least(star, "u", least)
        assert out.agg(F.count("*"), F.max("m")).first()[:] == (n - 1, 1)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- ranking


def test_featured_caps_and_totals(spark):
    rows = []
    for cat, n in (("a", 10), ("b", 15), ("c", 8)):
        for i in range(n):
            rows.append((f"{cat}{i:02}", cat, 100 - i, "PRIORITY" if i < 6 else "LOWER_PRIORITY", "NO_QUALIFYING_EVENT" if i == 3 else "QUALIFYING", "BACKFILL_INDEXING" if i == 4 else "OTHER"))
    df = spark.createDataFrame(rows, "work_id string, category string, routing_score int, triage_status string, event_status string, event_class string")
    pick = lambda **p: sorted(r["work_id"] for r in rank.featured(df, rank.Policy(**p)).collect())
    assert pick(target=5, hard_max=8, per_category={"c": (1, 2)}) == [*(f"a{i:02}" for i in (0, 1, 2, 5, 6)), *(f"b{i:02}" for i in (0, 1, 2, 5, 6)), "c00", "c01"]
    assert len(pick(target=2, hard_max=4, target_total=14, hard_max_total=18)) == 12
    assert len(pick(target=2, hard_max=8, target_total=14)) == 14
    assert pick(target=1, hard_max=4, hard_max_total=3) == ["a00", "b00", "c00"]
    with pytest.raises(ValueError):
        rank.Policy(target=9, hard_max=8)


def in_one_loop(rows, code_of, most, per_host):
    """What a loop over the candidates asks: (place, url, code) in the order of attempts."""
    counts, blocked, out = {}, set(), []
    for place, url in rows:
        host = url.split("/")[2] if url else ""
        if not url or len(out) >= most or host in blocked or (counts.get(host, 0) >= per_host and host != "doi.org"):
            continue
        counts[host] = counts.get(host, 0) + 1
        code = code_of(url)
        if code in rank.BLOCKS:
            blocked.add(host)
        out.append((place, url, code))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_probe_in_rounds_asks_what_one_loop_asks(spark, seed, tmp_path):
    import random

    draw = random.Random(seed)
    hosts = ["a.org", "b.org", "c.org", "doi.org", *(f"h{i}.org" for i in range(12))]
    rows = [(i, draw.choice(["", None]) if draw.random() < 0.1 else f"https://{draw.choice(hosts)}/{i}", "x") for i in range(150)]
    most, per_host, log = draw.choice([1, 7, 20, 500]), draw.choice([1, 2, 4]), str(tmp_path)

    def code_of(url):
        return (403, 200, 500, 302, 200)[sum(map(ord, url)) % 5]

    def fetch(url):
        import os

        os.makedirs(f"{log}/{url.replace('/', '_')}")  # fails if a url is asked twice
        return code_of(url)

    plan = spark.createDataFrame(rows, "rank int, publisher_url string, _at string").repartition(6)
    got = rank.probe(plan, fetch, most, per_host).collect()
    want = in_one_loop([r[:2] for r in rows], code_of, most, per_host)
    assert [(r["rank"], r["publisher_url"], r["http_status"]) for r in sorted(got, key=lambda r: r["attempt"])] == want
    assert sorted(r["attempt"] for r in got) == list(range(1, len(want) + 1)) and all((r["status"] == "SUCCESS") == (200 <= r["http_status"] < 400) for r in got)
    assert len(list(tmp_path.iterdir())) == len(want)  # no request that the loop wouldn't make
    assert rank.probe(plan.limit(0), fetch).count() == 0


def test_caps_hold_where_places_tie(spark):
    rows = [(1, "c", "x", i % 2 == 0 and "s" or None) for i in range(6)] + [(1, "c", "x", "s")] * 2
    df = spark.createDataFrame(rows, "place int, category string, direction string, section string")
    assert rank.capped_in_order(df, "category", {}, 2).count() == 2
    got = rank.capped_in_order(df, "category", {"section": {"s": 1, "*": 2}}, 9).collect()
    assert sorted(str(r["section"]) for r in got) == ["None", "None", "s"] and set(got[0].asDict()) == set(df.columns)


def test_diverse_and_sections(spark):
    rows = [(i, "llm_research", d, float(s), "2026", "anchor") for i, (d, s) in enumerate([("L1", 90), ("L1", 89), ("L1", 88), ("L2", 70), (None, 60), ("L3", 50)])]
    df = spark.createDataFrame(rows, "paper_id int, category string, direction string, total_score double, publication_date string, section string")
    assert [r["paper_id"] for r in rank.diverse(df, 5, 2).orderBy("place").collect()] == [0, 3, 5, 1, 4]
    taken = rank.capped_in_order(rank.diverse(df, 9, 9), "category", {"section": {"anchor": 4}, "direction": {"*": 1}}, 3)
    assert sorted(r["paper_id"] for r in taken.collect()) == [0, 3, 5]


# --- access


def test_access_is_what_was_probed(spark):
    rows = candidates(spark, {"title": "a", "pmcid": "PMC1"}, {"title": "b", "arxiv_id": "1.2"}, {"title": "c", "doi": "10.1/c", "open_access": False, "abstract": "x"}).withColumn("work_id", F.col("title"))
    probes = spark.createDataFrame([("a", "https://pmc.ncbi.nlm.nih.gov/articles/PMC1/", "SUCCESS", 200), ("b", "https://arxiv.org/abs/1.2", "SUCCESS", 200), ("c", "https://doi.org/10.1/c", "SUCCESS", 200)], "work_id string, url string, status string, http_status int")
    got = {r["work_id"]: r for r in access.fulltext(rows, probes).withColumn("depth", access.access_depth(F.lit("SUCCESS"))).collect()}
    assert [(got[k]["oa_status"], got[k]["access_status"], got[k]["fulltext_kind"], got[k]["fulltext_access_status"], got[k]["depth"]) for k in "abc"] == [("YES", "ACCESSIBLE", "REPOSITORY", "ACCESSIBLE", "FULL_TEXT"), ("YES", "NOT_CHECKED", "PDF", "NOT_CHECKED", "LANDING_PAGE"), ("NO", "NOT_CHECKED", "ABSTRACT_ONLY", "UNKNOWN", "ABSTRACT")]
    assert got["c"]["oa_evidence"][0]["value"] == "false" and got["a"]["oa_evidence"][0]["source"] == "PubMed Central"
    assert rules.access_rules(access.fulltext(rows, probes)).count() == 0


# --- state


def works(spark, *rows):
    base = {"work_id": "", "title": "t", "category": "c", "identifiers": {}, "first_seen_at": "1", "last_seen_at": "1", "seen_count": 1, "streams": [], "notes": [], "notified_event_ids": [], "oa_status": "UNKNOWN", "access_status": "NOT_CHECKED", "access_depth": "NONE", "fulltext_locations": []}
    schema = f"work_id string, title string, category string, identifiers map<string,string>, first_seen_at string, last_seen_at string, seen_count long, streams array<string>, notes array<string>, notified_event_ids array<string>, oa_status string, access_status string, access_depth string, fulltext_locations array<{LOCATION}>"
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], schema)


def test_state_merge_is_idempotent_and_has_no_order(spark):
    place = lambda s: ("u", "PDF", "REPOSITORY", s, "")
    a = works(spark, {"work_id": "title:1", "identifiers": {"pmid": "7"}, "first_seen_at": "2", "last_seen_at": "3", "seen_count": 4, "streams": ["B"], "access_status": "BLOCKED", "fulltext_locations": [place("BLOCKED")]}, {"work_id": "w2"})
    b = works(spark, {"work_id": "pmid:7", "title": "new", "identifiers": {"pmid": "7", "doi": "10.1/z"}, "first_seen_at": "1", "last_seen_at": "9", "streams": ["b", "a"], "oa_status": "YES", "access_depth": "ABSTRACT", "fulltext_locations": [place("NOT_CHECKED")]})
    dump = lambda df: sorted(df.withColumn("identifiers", F.to_json("identifiers")).toJSON().collect())
    one, two, same = (dump(state.merge_works(x, y)) for x, y in ((a, b), (b, a), (a, a)))
    assert one == two and len(one) == 2 and len(same) == 2
    got = {r["work_id"]: r for r in state.merge_works(a, b).collect()}["pmid:7"]
    assert (got["title"], got["first_seen_at"], got["last_seen_at"], got["seen_count"], got["streams"], got["oa_status"], got["access_status"], got["fulltext_locations"][0]["access_status"]) == ("new", "1", "9", 4, ["a", "B"], "YES", "BLOCKED", "BLOCKED")
    ids = state.id_map(state.merge_works(a, b))
    moved = state.remap(spark.createDataFrame([("e", "title:1"), ("f", "none")], "event_id string, work_id string"), ids).orderBy("event_id").collect()
    assert [r["work_id"] for r in moved] == ["pmid:7", "none"]
    with pytest.raises(StateConflict):
        state.merge_works(a, works(spark, {"work_id": "x", "identifiers": {"pmid": "7", "doi": "1"}}, {"work_id": "y", "identifiers": {"pmid": "7", "doi": "2"}}))


def test_events_notified_twice(spark):
    row = ("e", "w", "embargo_lifted", "1", "s", "u", "f", "date", "c")
    schema = "event_id string, work_id string, event_type string, occurred_at string, source string, source_url string, source_field string, precision string, confidence string, notified_at string"
    df = spark.createDataFrame([(*row, "1"), (*row, "2")], schema)
    assert [r["notified_at"] for r in state.merge_notified(df).collect()] == ["2"]
    with pytest.raises(StateConflict):
        state.merge_notified(df.unionByName(df.withColumn("source", F.lit("other"))))


def test_append_only_and_projection(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert [tuple(r) for r in state.append_new(a, b, "k").orderBy("k").collect()] == [(1, "x"), (2, "z")]
    assert state.append_only_violations(a, b).count() == 1
    x, y = (spark.createDataFrame([(k, v)], "source_id string, v string") for k, v in (("s1", "old"), ("s2", "new")))
    assert state.project_sources(x, y, x.unionByName(y)).count() == 2
    with pytest.raises(StateConflict):
        state.project_sources(x, y, x)
    assert spark.range(1).select(state.merge_provenance(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c")), F.lit("b")).alias("v")).first()["v"] == ["a", "c"]


def test_history_transitions_and_marks(spark):
    schema = "key string, position int, aliases array<string>, is_preprint boolean, open_access boolean, repository_versions array<string>, embargoed boolean, outcome string"
    old = spark.createDataFrame([("k1", 1, ["doi:a"], True, False, [], False, "r"), ("k2", 2, ["doi:b"], False, False, [], True, "r"), ("k3", 3, ["doi:c"], False, True, [], False, "r")], schema)
    new = spark.createDataFrame([(1, ["doi:a"], False, False, []), (2, ["doi:b"], False, True, []), (3, ["doi:c"], False, True, []), (4, ["doi:d"], False, True, []), (5, ["doi:c", "doi:b"], False, True, ["acceptedVersion"])], "paper_id int, aliases array<string>, is_preprint boolean, open_access boolean, repository_versions array<string>")
    got = {r["paper_id"]: (r["key"], r["outcome"], r["transition"]) for r in state.match_history(new, old).collect()}
    assert got == {1: ("k1", "new_version_event", "preprint_to_peer_reviewed_upgrade"), 2: ("k2", "new_version_event", "embargo_lifted"), 3: ("k3", "history_duplicate", None), 4: ("doi:d", "new_work", None), 5: ("k3", "new_version_event", "author_accepted_manuscript_first_available")}
    marked = state.mark_selection(old, new.where("paper_id = 1"), new.where("paper_id <= 2"))
    assert {r["key"]: r["outcome"] for r in marked.collect()} == {"k1": "featured", "k2": "candidate", "k3": "r"}


# --- coverage and rules


def test_expanded_groups_and_registry_rules(spark):
    streams = spark.createDataFrame([("s", ["g2", "g1"])], "stream string, groups array<string>")
    groups = spark.createDataFrame([("g1", ["a", "b"]), ("g2", ["c", "a"])], "group string, sources array<string>")
    assert coverage.expand_groups(streams, groups).first()["sources"] == ["c", "a", "b"]
    w = spark.createDataFrame([("w1", ["https://a.org/1/"]), ("w2", ["https://arxiv.org/pdf/1"])], "work_id string, urls array<string>")
    seen = spark.createDataFrame([("https://a.org/1", "SUCCESS", "2"), ("https://A.org/1", "FAILED", "1")], "url string, status string, accessed_at string")
    registry = coverage.source_registry(w, seen)
    obs = registry.select("source_id", F.lit("t").alias("observed_at"), F.lit("OK").alias("outcome"), F.lit("FULL_TEXT").alias("access_depth"))
    assert {r["work_id"]: (r["source_role"], r["last_status"]) for r in registry.collect()} == {"w1": ("FORMAL_PUBLICATION", "SUCCESS"), "w2": ("PRIMARY_RESEARCH", None)}
    assert rules.registry_rules(registry, obs, w).count() == 0
    broken = registry.withColumn("url", F.concat("url", F.lit("/?utm_x=1"))).withColumn("work_id", F.lit("w9"))
    found = {r["rule"] for r in rules.registry_rules(broken, obs.withColumn("source_id", F.lit("none")), w).collect()}
    assert found == {"source_url_canonical", "source_id_stable", "source_work_known", "observation_source_known"}
    ev = coverage.evidence_sources(registry, obs, w.withColumns({"title": F.lit("t"), "oa_status": F.lit("YES")}))
    assert ev.count() == 2 and ev.first()["outcome"] == "OK"
    with pytest.raises(StateConflict):
        coverage.source_registry(w.unionByName(w.withColumn("work_id", F.lit("other"))), seen).count()


def test_claim_gap_and_relation_rules(spark):
    claims = spark.createDataFrame([("c1", "EFFECT", "SUPPORTED", ["s1"]), ("c2", "CONTEXT", "SUPPORTED", ["s2"]), ("c3", "CONTEXT", "PARTIAL", [])], "claim_id string, kind string, status string, source_ids array<string>")
    bindings = spark.createDataFrame([("c1", "s1", "FULL_TEXT"), ("c2", "s2", "FULL_TEXT"), ("c9", "s9", "METADATA")], "claim_id string, source_id string, depth string")
    sources = spark.createDataFrame([("s1", "PRIMARY_RESEARCH", "FULL_TEXT"), ("s2", "FORMAL_PUBLICATION", "ABSTRACT")], "source_id string, source_role string, access_depth string")
    none = spark.createDataFrame([], "inference_id string, claim_id string")
    got = sorted((r["rule"], r["key"]) for r in rules.claim_rules(claims, bindings, sources, none).collect())
    assert got == [("binding_claim_known", "c9"), ("binding_deeper_than_access", "c2"), ("binding_source_known", "s9"), ("supported_needs_full_text", "c2")]
    gaps = spark.createDataFrame([("g1", 4, 3, "OPEN", None, ["r1"]), ("g2", 1, 3, "RESOLVED", None, [])], "gap_id string, attempt_count int, max_attempts int, status string, resolution_receipt_id string, receipt_ids array<string>")
    receipts = spark.createDataFrame([("r2",)], "attempt_id string")
    assert sorted(r["rule"] for r in rules.gap_rules(gaps, receipts).collect()) == ["attempts_in_limit", "gap_receipt_known", "resolved_has_receipt"]
    rel = spark.createDataFrame([("x", "a", "a", "NEW_VERSION")], "relation_id string, from_work_id string, to_work_id string, relation_type string")
    assert sorted(r["rule"] for r in rules.relation_rules(rel).collect()) == ["relation_id_stable", "relation_not_to_itself"]
    html = spark.createDataFrame([("r", '<article data-work-id="a"><article data-work-id="b"><article data-work-id="a">')], "report_id string, html string")
    ids = spark.createDataFrame([("a",), ("c",)], "work_id string")
    assert sorted((r["rule"], r["key"]) for r in rules.marker_rules(html, ids).collect()) == [("marker_known", "b"), ("marker_missing", "c"), ("marker_unique", "a")]
    urls = spark.createDataFrame([("a", "https://x/works?filter=from-pub-date:2026-08-06,until-pub-date:2026-08-09"), ("b", "https://x/works?filter=from-pub-date:2026-08-01,until-pub-date:2026-08-09")], "source_access_id string, url string")
    assert [r["key"] for r in rules.inventory_url_rules(urls, ("2026-08-06", "2026-08-09")).collect()] == ["b"]


def test_documents_against_a_schema():
    schema = {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {"id": {"type": "string", "pattern": "^w", "minLength": 2}, "n": {"anyOf": [{"type": "null"}, {"$ref": "#/defs/count"}]}, "xs": {"type": "array", "uniqueItems": True, "items": {"enum": [1, 2]}}}, "defs": {"count": {"type": "integer", "minimum": 0}}}
    assert rules.document_faults({"id": "w1", "n": 3, "xs": [1, 2]}, schema) == []
    assert rules.document_faults({"id": "v", "n": -1, "xs": [1, 1, 3], "z": 0}, schema) == ["$.id: does not match the pattern", "$.id: is out of bounds", "$.n: fits none of anyOf", "$.xs[2]: is none of the values", "$.xs: repeats an item", "$: has z"]
    assert rules.document_faults([], schema) == ["$: is not object"]
    assert rules.master_faults({"sources": {"a": {}}, "source_groups": {"g": ["a", "b"]}, "streams": {"s": {"source_groups": ["h"]}}, "profiles": {"p": {"streams": ["t"]}}}) == ["group g names unknown source b", "stream s names unknown group h", "profile p names unknown stream t"]
    assert rules.resolved_limits({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}}) == {"a": {"b": 9, "c": 2}, "d": 3}


# --- queues and facets


def test_queue_round_trip(spark):
    items = spark.createDataFrame([(i, f"c{i}", f"Trial of {i} adults", "x" * (7000 if i == 3 else 10)) for i in range(30)], "position int, item_id string, title string, excerpt string").withColumn("chars", queue.source_chars())
    packed = queue.pack(items, 8, 7300)
    assert [r["batch"] for r in packed.orderBy("position").collect()] == [1] * 8 + [2] * 8 + [3] * 8 + [4] * 6
    assert [r["batch"] for r in queue.pack(items, 8, 7020).orderBy("position").collect()][:5] == [1, 1, 1, 2, 3]
    batch = queue.batch_of(packed, 1)
    answer = [(f"c{i}", i + 1, f"{i} 名成人", "摘要") for i in range(8)]
    schema = "item_id string, place int, title_out string, summary_out string"
    assert queue.response_faults(batch, spark.createDataFrame(answer, schema)).count() == 0
    bad = [answer[1], answer[0], *answer[2:6], ("c6", 7, "名", ""), ("zz", 8, "1 名", "x")]
    faults = sorted(tuple(r) for r in queue.response_faults(batch, spark.createDataFrame([(a, i + 1, t, s) for i, (a, _, t, s) in enumerate(bad)], schema)).collect())
    assert faults == [("c0", "OUT_OF_ORDER"), ("c1", "OUT_OF_ORDER"), ("c6", "SUMMARY_EMPTY"), ("c6", "TITLE_LOST_NUMBER"), ("c7", "MISSING"), ("zz", "UNKNOWN")]
    done = spark.createDataFrame(answer, schema)
    point = queue.merge_checkpoint(done.limit(0), done, packed)
    assert point.count() == 8 and queue.partial_batches(point, packed).count() == 0
    with pytest.raises(StateConflict):
        queue.merge_checkpoint(point, done.withColumn("title_out", F.lit("other")), packed)
    with pytest.raises(StateConflict):
        queue.final_response(point, packed)
    assert queue.plan_violations(packed, packed).count() == 0 and queue.batch_ids(packed, "sha").count() == 4


def test_adaptive_calls_halve_what_fails(spark):
    items = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id int, title string").coalesce(1)

    def call(texts):
        if "t7" in texts:
            raise ValueError
        return [t.upper() for t in texts]

    got = {r["id"]: r["answer"] for r in queue.map_adaptively(items, call, "id int, title string, answer string", 8).collect()}
    assert got == {i: None if i == 7 else f"T{i}" for i in range(10)}


def test_facets(spark):
    rows = candidates(spark, {"title": "Sleep study", "venue": "J", "observed_sources": ["pubmed"], "category": "a"}, {"title": "Other", "observed_sources": ["pubmedx"], "category": "b"}).withColumn("study_designs", F.array(F.lit("review")))
    seen = facets.with_facets(rows)
    assert facets.facet_filter(seen, search="SLEEP", source="pubmed", study="review", category="a").count() == 1
    assert facets.facet_filter(seen, source="pubmed").count() == 1
    assert {r["category"]: r["visible"] for r in facets.facet_counts(seen).collect()} == {"a": 1, "b": 1}


@pytest.mark.parametrize("by", [None, "q"])
def test_packing_goes_on_from_block_to_block(spark, by):
    import random

    draw = random.Random(7)
    rows = [(f"q{draw.randrange(3)}", i, draw.choice([1, 5, 40, 90, 250])) for i in range(400)]
    want, state = {}, {}
    for name, i, c in rows:
        batch, n, size = state.get(name if by else "", (0, 6, 0))
        state[name if by else ""] = (batch, n + 1, size + c) if n < 6 and size + c <= 200 else (batch + 1, 1, c)
        want[i] = state[name if by else ""][0]
    items = spark.createDataFrame(rows, "q string, position int, chars int").repartition(5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for parts in (1, 3, 120):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert {r["position"]: r["batch"] for r in queue.pack(items, 6, 200, by).collect()} == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert queue.pack(items.limit(0), 6, 200, by).count() == 0


def test_feed_titles_meet_by_author_or_venue_whatever_the_number(spark):
    row = lambda i, doi, author, venue, day="2026-08-08": (doi, f"https://x.org/{i}", "The long study of sleep", day, [author], venue)
    schema = "doi string, landing_url string, title string, publication_date string, authors array<string>, venue string"
    feed = [row(0, "10.1/a", "A", ""), row(1, "10.1/b", "A", ""), row(2, "10.1/a", "A", ""), row(3, "", "Z", "", "2026-08-09")]
    registry = [row(4, "", "B", "J"), row(5, "", "C", "J"), row(6, "", "C", ""), row(7, "", "D", "")]
    counts = sorted(r["n_records"] for r in resolve.merge_feed_and_registry(spark.createDataFrame(feed, schema), spark.createDataFrame(registry, schema)).collect())
    assert counts == [1, 1, 1, 2, 3]  # a twice; b; 3 of another day; 7; 4 to 6 by venue and author


def test_a_record_without_doi_joins_the_smallest_it_agrees_with(spark):
    schema = "record_id string, doi string, landing_url string, title string, publication_date string, authors array<string>, venue string"
    row = lambda i, doi, authors, url="": (i, doi, url, "The long study of sleep", "2026-08-08", authors, "")
    feed = spark.createDataFrame([row("f", "", ["A", "B"]), row("g", "", ["C"], "u9")], schema)
    registry = spark.createDataFrame([row("r1", "10.1/b", ["A"]), row("r2", "10.1/a", ["B"]), row("r3", "10.1/c", ["C"], "u9"), row("r4", "10.1/0", ["C"])], schema)
    got = {r["doi"]: (r["record_id"], r["n_records"]) for r in resolve.merge_feed_and_registry(feed, registry).collect()}
    assert got == {"10.1/a": ("f", 2), "10.1/b": ("r1", 1), "10.1/c": ("g", 2), "10.1/0": ("r4", 1)}


@pytest.mark.parametrize("by", [None, "q"])
def test_packing_keeps_row_for_row(spark, by):
    rows = [("a", 1, 5, "x"), ("a", 1, 5, "x"), ("a", 1, 9, "y"), (None, 2, 5, "x"), (None, None, 7, "z"), ("b", None, None, None), ("b", 3, 250, "w")]
    items = spark.createDataFrame(rows, "q string, position int, chars int, _block string").repartition(3)
    got = queue.pack(items, 2, 200, by).collect()
    assert sorted(map(str, ([r[c] for c in items.columns] for r in got))) == sorted(map(str, map(list, rows)))
    sizes = {}
    for r in got:
        sizes.setdefault((r["q"] if by else 0, r["batch"]), []).append((r["position"], r["chars"] or 0))
    assert all(len(x) <= 2 and (len(x) == 1 or sum(c for _, c in x) <= 200) for x in sizes.values())
    for q in {k[0] for k in sizes}:
        numbers = sorted(b for p, b in sizes if p == q)
        assert numbers == list(range(1, len(numbers) + 1))
        places = [p if p is not None else -1 for b in numbers for p, _ in sorted(sizes[q, b], key=lambda x: -1 if x[0] is None else x[0])]
        assert places == sorted(places)


SCHEMA = {
    "$schema": "x", "type": "object", "required": ["id", "works"], "additionalProperties": False, "minProperties": 2,
    "properties": {
        "id": {"$ref": "#/$defs/id"}, "n": {"type": ["integer", "null"], "minimum": 0, "maximum": 10}, "score": {"type": "number"}, "kind": {"const": "state"}, "mode": {"enum": ["a", 1, None, True]},
        "works": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"type": "object", "required": ["id"], "properties": {"id": {"$ref": "#/$defs/id"}, "tags": {"type": "array", "items": {"type": "string", "minLength": 1, "maxLength": 3}, "maxItems": 2}}, "additionalProperties": {"type": "string"}}},
        "either": {"oneOf": [{"type": "string"}, {"type": "object", "required": ["x"]}, {"type": "object", "required": ["y"]}]}, "some": {"anyOf": [{"type": "integer"}, {"pattern": "^z"}]}, "no": {"not": {"type": "string"}}, "all": {"allOf": [{"type": "string"}, {"minLength": 2}]},
    },
    "$defs": {"id": {"type": "string", "pattern": "^w[0-9]+$"}},
}


def test_schema_of_a_table_of_documents_says_what_that_of_one_says(spark):
    rng = random.Random(4)
    good = {"id": "w1", "n": 3, "score": 1.5, "kind": "state", "mode": "a", "works": [{"id": "w2", "tags": ["a", "b"], "note": "x"}, {"id": "w3"}], "either": {"x": 1}, "some": 3, "no": 1, "all": "ab"}
    values = [None, True, False, 0, 1, 11, -1, 1.5, "", "a", "w7", "zz", "long text", [], ["a"], ["", "abcd", 3], {}, {"x": 1}, {"y": 2}, {"x": 1, "y": 2}, [{"id": "w1"}, {"id": "w1"}], [{"id": 3, "other": 4}]]

    def mutated(x):
        x = copy.deepcopy(x)
        for _ in range(rng.randrange(4)):
            at = rng.choice([x, *(w for w in x.get("works") or [] if isinstance(w, dict))] if isinstance(x.get("works"), list) else [x])
            k = rng.choice([*at, "extra", "tags"])
            if rng.random() < 0.25:
                at.pop(k, None)
            else:
                at[k] = rng.choice(values)
        return x

    docs = [good, *(mutated(good) for _ in range(250)), [], "x", None, 3]
    rows = [(i, json.dumps(d), "e") for i, d in enumerate(docs)] + [(9000, "{", "e"), (9001, None, "e"), (9002, '{"id": "w1", "id": "w2"}', "e")]
    got = {}
    for r in json_schema.violations(spark.createDataFrame(rows, "id int, doc string, x string"), SCHEMA, "id", "doc").collect():
        got.setdefault(int(r["key"]), []).append(f"{r['path']}: {r['detail']}")
    want = {i: sorted(f) for i, d in enumerate(docs) if (f := rules.document_faults(d, SCHEMA))} | {i: ["$: is not JSON"] for i in (9000, 9001, 9002)}
    assert {k: sorted(v) for k, v in got.items()} == want and len(want) > 100
    with pytest.raises(ValueError, match="holds itself"):
        json_schema.compiled(F.lit(None), F.lit("$"), {"$ref": "#"}, {"properties": {"x": {"$ref": "#"}}} | {"": {"$ref": "#"}})
    with pytest.raises(ValueError, match="aren't known"):
        json_schema.compiled(F.lit(None), F.lit("$"), {"contains": {}}, {})


def test_digest_trees_name_the_first_item_that_differs(spark):
    n = 3000
    items = spark.range(n).select(F.col("id").alias("place"), F.concat(F.lit("item "), F.col("id").cast("string")).alias("text"))
    a = digests.spool(digests.tree(items, "place", "text", fanout=7), "a")
    assert a.agg(F.max("level")).first()[0] == 5 and a.where("level = 5").count() == 1 and a.count() == n + sum(-(-n // 7**k) for k in range(1, 6))
    same = digests.tree(items.repartition(5), "place", "text", fanout=7)
    assert digests.root(same) == digests.root(a) and digests.first_difference(a, same, 7) is None
    for at in (0, 6, 7, 1234, n - 1):
        other = digests.tree(items.withColumn("text", F.when(F.col("place").isin(at, n - 1), "x").otherwise(F.col("text"))), "place", "text", fanout=7)
        assert digests.root(other) != digests.root(a) and digests.first_difference(a, other, 7) == at
    assert digests.first_difference(a, digests.tree(items.where("place < 40"), "place", "text", fanout=7), 7) == 40
    none = digests.tree(items.limit(0), "place", "text", fanout=7)
    assert digests.root(none) is None and digests.first_difference(none, none, 7) is None and digests.first_difference(none, a, 7) == 0
    for bad in (items.unionByName(items.limit(1)), items.withColumn("place", F.when(F.col("place") > 3, F.col("place")))):
        with pytest.raises(StateConflict):
            digests.tree(bad, "place", "text")


def test_checkpoints_belong_to_their_plan(spark):
    plan = spark.createDataFrame([(f"i{k}", k * 10, k // 3) for k in range(12)], "item_id string, position int, batch int")
    point = lambda ids: spark.createDataFrame([(x, k) for k, x in enumerate(ids)], "item_id string, place int")
    own = digests.root(digests.tree(digests.numbered(plan, "position"), "place", "item_id", F.col("batch").cast("string")))
    of = lambda ids, bound=own: sorted(map(tuple, digests.checkpoint_faults(plan, point(ids), bound).collect()))
    assert of(["i0", "i1", "i2", "i6", "i7", "i8"]) == [] and of([]) == []
    assert of(["i0", "i2", "i1"]) == [("item_in_order", "i1", "2/1"), ("item_in_order", "i2", "1/2")]
    assert of(["i0", "i1", "i2", "i9", "z"]) == [("batch_whole", "3", "1/3"), ("item_known", "z", "not in the plan")]
    assert of(["i0", "i0", "i1", "i2"]) == [("item_once", "i0", "2")]
    assert of([], "other") == [("plan_bound", "root", own)]


def test_ids_are_followed_through_generations(spark):
    pairs = [(f"a{i}", f"a{i + 1}") for i in range(10)] + [(f"h{i}", "a3") for i in range(50)] + [("x", "y"), ("s", "s"), ("x", "y")]
    df = spark.createDataFrame(pairs, "old_id string, work_id string")
    got = {r["old_id"]: r["work_id"] for r in state.resolved_ids(df).collect()}
    assert got == {f"a{i}": "a10" for i in range(10)} | {f"h{i}": "a10" for i in range(50)} | {"x": "y"}
    assert state.resolved_ids(df.limit(0)).count() == 0
    for more in ([("a10", "a4")], [("p", "q"), ("q", "r"), ("r", "p")], [("u", "v"), ("v", "u")], [("x", "z")]):
        with pytest.raises(StateConflict):
            state.resolved_ids(df.union(spark.createDataFrame(more, df.schema)))


def test_append_takes_the_first_row_of_a_key(spark):
    t = spark.createDataFrame([(1, "a", None)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "z", 1), (2, "b", 2), (1, "x", 3), (2, "z", 1), (3, None, None)], t.schema)
    assert sorted(map(tuple, state.append_new(t, new, "k").collect()), key=str) == [(1, "a", None), (2, "b", 2), (3, None, None)]
