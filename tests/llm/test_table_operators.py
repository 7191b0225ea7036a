"""URL reputation, mixing, nearest neighbours, components and the pipeline, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("paperloom.llm")
import corpus_pipeline  # noqa: E402
from paperloom.llm import ann, mixing, queries, url_reputation, zstd_quality  # noqa: E402

SF = "/root/testdata/sf0.001"


# --- url reputation


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return host.translate({i: i + 32 for i in range(65, 91)}), path


def brute_rule(host, path):
    fits = [(len(r), r, v) for r, v in url_reputation.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://A.Example.ORG/es/1?q", "http://example.org/en/12", "http://badexample.org/es/", "http://org/", "http://org", "http://x.org?a/b", "http://x.com/fr/a#b", "ftp://y.com/de/", "http://y.com/de", "http://a://b/c", "http://u@h.co.uk:80/p", "http://10.0.0.1/x", "HTTP://Ü.com/fr/é", "http://h/\nx"]


def test_urls_are_judged_as_brute_force(spark):
    rows = [(i, u, "h", "x", 1) for i, u in enumerate(URLS)] + [(0, None, "h", "x", 1), (None, "http://z.org/", "h", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n long")
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    got = url_reputation.judge(pages, url_reputation.outcomes_of(labels)).collect()
    assert len(got) == len(rows)
    for r in got:
        url = "http://z.org/" if r["page_id"] is None else URLS[r["page_id"]]
        host, path = brute_url(url)
        rule, verdict = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow")
    assert url_reputation.judge(pages.where("false"), url_reputation.outcomes_of(labels)).count() == 0
    assert url_reputation.judge(pages, url_reputation.outcomes_of(labels.where("false"))).count() == len(rows)


def test_reputation_shrinks_to_the_domain(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.{'bad' if i % 2 else 'good'}.net" for i in range(40)]
    pages, labels = [], []
    for i in range(4000):
        h = rng.choice(hosts)
        pages.append((i, f"http://{h}/{i}"))
        labels.append((i, int(rng.random() >= (0.85 if ".bad." in h else 0.05)), 0))
    pages += [(9000, "http://new.bad.net/"), (9001, "http://new.good.net/"), (9002, "http://other.info/")]
    got = url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"), url_reputation.outcomes_of(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert all((r["verdict"] == "block") == (".bad." in r["host"]) for r in got.collect())


# --- mixing


def brute_plan(rows, entropy, repeats, budget=None, seed=mixing.SEED):
    import hashlib

    n = lambda t: len([w for w in (t or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w])
    tot = {}
    for _, s, t in rows:
        tot[s] = tot.get(s, 0) + n(t)
    live = {s: t for s, t in tot.items() if t}
    all_ = sum(live.values())
    p = {s: t / all_ for s, t in live.items()}

    def entropy_of(a):
        z = sum(x**a for x in p.values())
        return math.log(z) - a * sum(x**a * math.log(x) for x in p.values()) / z

    def halve(ok_low, lo, hi):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if ok_low(mid) else (lo, mid)
        return lo

    a = 1.0
    if len(p) > 1:
        a = 1.0 if entropy_of(1.0) >= entropy * math.log(len(p)) else halve(lambda x: entropy_of(x) >= entropy * math.log(len(p)), 0.0, 1.0)
        if (max(p.values()) / min(p.values())) ** (1 - a) > repeats:
            a = halve(lambda x: (max(p.values()) / min(p.values())) ** (1 - x) > repeats, a, 1.0)
    z = sum(x**a for x in p.values())
    copies = {}
    for s in tot:
        b = budget if budget is not None else all_ * max(p.values()) ** (1 - a) * z if p else 0
        copies[s] = p[s] ** a / z * b / tot[s] + 1e-9 if s in p else 1.0
    out = []
    for s in tot:
        own = [(d, n(t)) for d, x, t in rows if x == s]
        key = lambda d, e: hashlib.md5("|".join([seed, str(e), "" if d is None else str(d)]).encode()).hexdigest()
        whole = math.floor(copies[s])
        out += [(d, s, e) for e in range(whole) for d, _ in own]
        left = math.floor((copies[s] - whole) * tot[s])
        for d, k in sorted(own, key=lambda x: (key(x[0], whole), x[1])) if left else []:
            left -= k
            if left < 0:
                break
            out.append((d, s, whole))
    return a, sorted(out, key=str)


@pytest.mark.parametrize(("entropy", "repeats", "budget"), [(0.97, 4.0, None), (0.99, 1.5, None), (0.9, 10.0, 700), (1.0, 100.0, None)])
def test_mixing_is_brute_force(spark, entropy, repeats, budget):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 2 else f"s{i % 6}" if i % 6 else None, " ".join("w" for _ in range(rng.randrange(0, 9)))) for i in range(300)]
    rows += [(700, "empty", None), (701, "empty", ""), (None, "hot", "a b"), rows[5]]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, text string, s string, t long")
    alpha, want = brute_plan(rows, entropy, repeats, budget)
    got = mixing.plan(table, entropy, repeats, budget)
    assert sorted(((r["doc_id"], r["source"], r["block"]) for r in got.collect()), key=str) == want
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "s string, p double")
    assert abs(mixing.exponent(shares, 0.97, 50.0) - next(a for a in [brute_plan([(0, "a", "w " * 70), (1, "b", "w " * 20), (2, "c", "w " * 10)], 0.97, 50.0)[0]])) < 1e-5
    assert mixing.plan(table.where("false")).count() == 0


# --- nearest neighbours


def test_mixing_refuses_budgets_without_end(spark):
    rows = spark.createDataFrame([(1, "a b c", "s"), (2, "d e", "t")], "doc_id long, text string, source string")
    assert mixing.plan(rows, budget_tokens=50, most_blocks=20).count() > 2
    with pytest.raises(ValueError, match="repeats a source"):
        mixing.plan(rows, budget_tokens=10**12)


def test_neighbours_have_recall_and_order(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 24)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[700:760] = x[7]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(5000, None, 0), (5020, [0.0] * 24, 0), (5040, [float("nan")] + [1.0] * 23, 0), (5060, [None] + [1.0] * 23, 0), (5080, [1.0, 2.0], 0), (5001, [3.0, 4.0], 0), (5100, [], 0), (5120, [float("inf")] * 24, 0), (None, [1.0] * 24, 0)]
    table = spark.createDataFrame([(i, v, k, "x", 1) for i, v, k in rows + odd], "vec_id long, embedding array<float>, label int, part string, query_id long")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, 20, block=600).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 1500, 20), 5080}
    assert sorted(got.pop(5080)) == [(1, 5001, 11.0)]
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(v != q for _, v, _ in found)
        s = (x.astype(float) * x[q].astype(float)).sum(1)
        assert np.allclose([c for _, _, c in found], s[[v for _, v, _ in found]], rtol=1e-12)
        assert [(-c, v) for _, v, c in found] == sorted((-c, v) for _, v, c in found)
        best = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        hits += len({v for _, v, _ in found} & set(best))
    assert hits >= 0.9 * 20 * len(got)
    assert ann.nearest(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(table.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_on_the_test_table(spark):
    import numpy as np

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in queries.op10_collision_ann(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        hits += len(got[q] & set(ids[np.lexsort((ids, -np.where(ids == q, -np.inf, s)))[:20]].tolist()))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_neighbours_of_repeated_ids_and_of_vectors_of_any_size(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 8))
    # Every third id stands for several rows; a query is a row, its candidates all others.
    ids = [i // 3 * 3 if i < 90 else i for i in range(400)]
    for factor in (1.0, 1e200, 1e-200, 1e-160):
        y = x * factor
        table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, y, strict=True)], "vec_id long, embedding array<double>")
        got = [tuple(r) for r in ann.nearest(table, F.col("vec_id") % 20 == 0, 10, block=150, confidence=0.999999).collect()]
        with np.errstate(over="ignore", invalid="ignore"):
            want = []
            for row in np.flatnonzero(np.array(ids) % 20 == 0):
                s = (y * y[row]).sum(1)
                rest = [i for i in range(400) if i != row]
                best = sorted(rest, key=lambda i: (-s[i] if not np.isnan(s[i]) else np.inf, ids[i]))[:10]
                want += [(ids[row], k + 1, ids[i], s[i]) for k, i in enumerate(best)]
        assert len(got) == len(want) and sorted({r[:2] for r in got}) == sorted({r[:2] for r in want})
        hits = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len({(q, v) for q, _, v, _ in want})
        assert hits >= (0.98 if factor == 1.0 else 0.9 if factor == 1e-160 else 0), (factor, hits)
        assert all(sorted(k for q, k, _, _ in got if q == i) == sorted(k for q, k, _, _ in want if q == i) for i in set(ids))


def test_neighbours_of_mixed_lengths(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 12)) * np.exp2(rng.integers(-30, 30, (600, 1)))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & set([i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:5])) for q in range(0, 600, 20))
    assert hits >= 0.9 * 5 * 30


def test_structured_vectors_verify_few():
    import numpy as np

    rng = np.random.default_rng(9)
    sizes = []
    for n in (2000, 16000):
        centres = rng.standard_normal((n // 50, 32))
        x = np.repeat(centres, 50, 0) + 0.02 * rng.standard_normal((n, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        index = ann.Index(np.arange(n), np.arange(n), x, 20)
        sizes.append(sum(len(band.candidates(x[i], 20)) for i in range(0, n, n // 20) for _, _, band in index.bands) / 20 / n)
    assert sizes[1] < 0.5 * sizes[0]  # a smaller share of more vectors


# --- the pipeline


def test_pipeline_is_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    model = zstd_quality.learn(docs, labels)
    rows = sorted(docs.collect())

    from tests.llm.test_text_operators import brute_classes, brute_decontaminate, brute_lines, brute_quality

    kept = [r for r, s in zip(rows, brute_quality([r["text"] for r in rows], model), strict=True) if s >= 0.7]
    whole = {r["doc_id"]: r["text"] for r in kept}
    text = {d: whole[d] if gone else t for d, t, _, gone in brute_lines([tuple(r) for r in kept])}
    classes = brute_classes([(r["doc_id"], text[r["doc_id"]]) for r in kept], 5, 80)
    kept = [r for r in kept if classes[r["doc_id"]][1] == r["doc_id"]]
    bench = [tuple(r) for r in items.select("item_id", "text").collect()]
    kept = [r for r in kept if not brute_decontaminate(text[r["doc_id"]], bench)[4]]
    _, want = brute_plan([(r["doc_id"], r["source"], text[r["doc_id"]]) for r in kept], mixing.ENTROPY, mixing.REPEATS)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(((r["doc_id"], r["source"], r["block"]) for r in got), key=str) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "benchmark", "mix"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_pipeline_stages_take_empty_tables_null_and_repeated_ids(spark, tmp_path):
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(6)]
    rows = [(None, words[0], "en", "s", 1), (None, words[1], "en", "s", 1), (1, words[2], "en", None, 1), (1, words[3], None, "s", 1), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, words[2] + " more", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, table, schema in (("labels", [(1, 1, 0)], "doc_id long, quality int, toxic int"), ("benchmark", [(1, words[1])], "item_id long, text string")):
        spark.createDataFrame(table, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.where("false"), str(tmp_path))
        assert none.count() == 0
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == none.columns and got.count() >= {"quality": 7, "lines": 7, "near_copies": 5, "benchmark": 6, "mix": 7}[name]


def test_benchmark_stage_judges_row_by_row(spark, tmp_path):
    item = " ".join(f"word{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item, "en", "s", 1), (None, "clean one", "en", "s", 1), (5, item, "en", "s", 1), (5, "clean two", "en", "s", 1), (6, None, "en", "s", 0), (7, item, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.benchmark(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[1], rows[3], rows[4]]))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    import os

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    clean = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)
    names = ", ".join(f'"{c}"' for c in cols)
    want = con.execute(f"SELECT {names} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert clean(got.select(*cols).collect()) == clean(want)
