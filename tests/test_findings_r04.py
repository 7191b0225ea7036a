"""Near copies at the size of a large corpus, and a query against its SQL on rows that the test tables don't have."""

import pytest

from paperloom.llm import jaccard_join

from .test_findings_r03 import same_as_sql


@pytest.mark.parametrize(("percent", "docs"), [(80, 5e5), (80, 3e6), (80, 1.6e7), (85, 1.6e7)])
def test_entries_of_a_set_dont_grow_with_the_corpus(percent, docs):
    for largest in (48, 292, 715, 4270, 10427):
        assert jaccard_join.allocate(largest, percent, docs) == jaccard_join.allocate(largest, percent, 1e4)


def test_finer_entries_are_of_shared_segments(spark, monkeypatch):
    # A passage in all documents, words of their own around it, and a near copy of each fifth.
    passage = " ".join(f"p{i}" for i in range(90))
    texts = [f"{passage} " + " ".join(f"d{d}w{i}" for i in range(40)) for d in range(40)]
    texts += [t.rsplit(" ", 2)[0] for t in texts[::5]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes, real = {}, jaccard_join.spool

    def counted(df, tag):
        out = real(df, tag)
        sizes.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "spool", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(rows, 4, 85, cell=4, depth=1, turns=0).collect()}
    assert got == {i: i if i < 40 else (i - 40) * 5 for i in range(48)}
    ix = jaccard_join.Index(4, 85, len(texts), None, 1)
    every = sum(len(ix.entries(ix.shingles(t))) for t in texts)
    assert sizes["many"][0] > len(texts)  # a document is in several crowded entries, and has most finer segments alone or with its copy
    assert 0 < sizes["finer-members"][0] < sizes["many"][0] * every / len(texts) / 2


@pytest.mark.parametrize("query", ["scan_pubmed", "scan_arxiv", "scan_feeds"])
def test_scans_of_odd_texts(spark, tmp_path, query):
    texts = ["", "  ", "&<>", "\n", "a xmlns=\"x\" b", "xmlns:q=\"x\"", "a \"b\"", "two  words"]
    same_as_sql(spark, tmp_path, query, documents=spark.createDataFrame([(i, t) for i, t in enumerate(texts * 7)], "doc_id long, text string"))
