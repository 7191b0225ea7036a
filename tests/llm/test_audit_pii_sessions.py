"""Personal data, filter audit and sessions, against brute force and their SQL."""

import random
import re
from datetime import datetime, timedelta
from itertools import permutations

import pytest

pytest.importorskip("paperloom.llm")
import duckdb  # noqa: E402

from paperloom.llm import filter_audit, pii, queries, sessions  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_pii", "op12_filter_audit", "op13_gap_sessions"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "clicks"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    clean = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert clean(got.select(*cols).collect()) == clean(want)


# --- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    def ok(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "phone":
            return 9 <= len(d) <= 15
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 13 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
        return True

    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


TEXTS = [
    None, "", "a@b.com_x@y.org", "@b.com@y.org", "a@b.com@y.org x@y", "x@-.-", "é.a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255", "ip 10.0.0.1", "4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (988) 555-2485 +12 +1  5", "+1+12345678901",
    "4111111111111111" * 3, "Ü 4111111111111111", "card 4111-1111-1111-1111 order",
]


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("a1@.+ -()4_%é\n") for _ in range(rng.randrange(80))) for _ in range(400)] + ["".join(rng.choice("0123456789 -.+") for _ in range(60)) for _ in range(200)]
    for t in texts:
        assert [(k, a, z) for k, a, z, _ in pii.spans_of(t) if k in pii.BASE] == brute_base(t), t
    docs = spark.createDataFrame([(i % 50 or None, t, "x", []) for i, t in enumerate(texts)], "doc_id long, text string, spans string, score array<int>")
    got = sorted((r["doc_id"] or 0, [(s["kind"], s["start"], s["end"], s["score"]) for s in r["spans"]]) for r in pii.scan(docs).collect())
    assert got == sorted((i % 50, pii.spans_of(t)) for i, t in enumerate(texts))
    assert pii.scan(docs.where("false")).count() == 0


def test_account_numbers_need_their_sum_and_local_numbers_a_word():
    of = lambda t: [(k, t[a:z], s) for k, a, z, s in pii.spans_of(t) if k in ("iban", "local")]
    assert of("pay GB82 WEST 1234 5698 7654 32 NOW") == [("iban", "GB82 WEST 1234 5698 7654 32", 90)]
    assert of("IBAN: DE89370400440532013000.") == [("iban", "DE89370400440532013000", 100)]
    assert of("DE89370400440532013001 xDE89370400440532013000 DE893704004405320130001") == []
    assert of("call (212) 555-0199 now") == [("local", "(212) 555-0199", 70)]
    assert of("part 212-555-0199 of the order; call") == [] and of("212-555-0199") == []
    assert [s for *_, s in pii.spans_of("my card 4111111111111111")] == [100] and [s for *_, s in pii.spans_of("order 4111111111111111")] == [50]


def test_long_texts_take_one_pass():
    import time

    start = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "A1" * 150_000, "GB82" * 75_000, "call 212-555-0199, a@b.co " * 12_000):
        pii.spans_of(t)
    assert time.time() - start < 60


# --- filter audit


def brute_audit(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    seen = []
    for d, text, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        fails["E"] = any(x is not None and d is not None and x < d and (y or "") == t for x, y, _ in docs)
        seen.append((part or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    rows = []
    for part in {p for p, *_ in seen}:
        own = [x[1:] for x in seen if x[0] == part]
        runs, shapley = {}, dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for i, f in enumerate(order):
                gone, stay = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                runs[order, i + 1] = (len(stay), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone))
                left = stay
        rows += [(part, o, s, *v, shapley[o[s - 1]]) for (o, s), v in runs.items()]
    return sorted(rows)


def test_audit_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    long_ = " ".join(f"w{i}" for i in range(220))
    pool = [None, "", "A B", long_, long_ + " $", long_.upper(), "x " * 300, "x " * 300 + "#", long_ + "\x0bé x", "\U0001f600 A", "X" * 50]
    docs = [(rng.choice([None, *range(40)]), rng.choice(pool), rng.choice([None, "", "s", "t", "Ü"])) for _ in range(150)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    d = spark.createDataFrame([(*x, 1, "m") for x in docs], "doc_id long, text string, source string, good int, mask string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute_audit(docs, labels)
    assert sorted(map(tuple, filter_audit.audit(d, lab).collect())) == want
    monkeypatch.setattr(filter_audit, "PARTS_HELD", 2)  # tasks that hold few parts at a time
    assert sorted(map(tuple, filter_audit.audit(d.repartition(1), lab).collect())) == want
    assert filter_audit.audit(d.where("false"), lab).count() == 0
    got = filter_audit.audit(d, lab.where("false")).collect()
    assert len(got) == len(want) and not any(r["good_lost"] or r["toxic_lost"] for r in got)


# --- sessions

DAY = datetime(2024, 3, 1)


def brute_sessions(clicks):
    us = lambda t: (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    taken = {}
    for i, ts, arrived, client, kind, value in clicks:
        if None not in (i, ts, client):
            low = lambda x: (x is not None, x)
            x = (us(ts), client, (arrived is not None, us(arrived) if arrived else 0), low(kind), low(value))
            if i not in taken or x < taken[i]:
                taken[i] = x
    by_client = {}
    for i, (t, client, (has, arrived), (_, kind), (_, value)) in taken.items():
        late = has and arrived - t > 3_600_000_000
        by_client.setdefault(client, []).append((t, i, late, kind == "purchase" and value is not None and value >= 60, 0 if value is None else int((100 * value + 0.5) // 1)))
    out = []
    for client, all_ in by_client.items():
        runs, reasons = [], []
        for x in sorted(y for y in all_ if not y[2]):
            last = runs[-1] if runs else None
            why = "first" if not last else "end" if last[-1][3] else "gap" if x[0] - last[-1][0] >= 300_000_000 else "length" if x[0] - last[0][0] > 7_200_000_000 else None
            if why:
                runs.append([x])
                reasons.append(why)
            else:
                last.append(x)
        for k, run in enumerate(runs):
            upto = runs[k + 1][0][0] if k + 1 < len(runs) else float("inf")
            closed = reasons[k + 1] if k + 1 < len(runs) else "end" if run[-1][3] else "none"
            out.append((client, run[0][1], run[0][0], run[-1][0], len(run), sum(y[2] and run[0][0] <= y[0] < upto for y in all_), sum(y[4] for y in run), closed, [y[1] for y in run]))
    return sorted(out)


def clicks_of(seed, n, clients, step, finals=0.05, late=0.1):
    rng, out = random.Random(seed), []
    for c in range(clients):
        t = DAY
        for _ in range(n // clients):
            t += timedelta(microseconds=rng.choice(step))
            arrived = None if rng.random() < 0.05 else t + timedelta(minutes=rng.choice([0, 60, 61]) if rng.random() < late else 1)
            out.append((rng.randrange(10**6), t, arrived, rng.choice([c, c, c, None]) if rng.random() < 0.05 else c, "purchase" if rng.random() < finals else "view", rng.choice([None, 59.995, 60.0, 1.005, -2.5])))
    out += rng.sample(out, n // 20) + [(x[0], None, *x[2:]) for x in out[:3]] + [(None, *out[0][1:]), (out[1][0], out[1][1] + timedelta(days=1), *out[1][2:])]
    rng.shuffle(out)
    return out


SHAPE = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double"
MIN = 60_000_000


@pytest.mark.parametrize(
    ("seed", "clients", "step", "finals", "rows"),
    [
        (1, 9, [0, 1, MIN, 4 * MIN, 5 * MIN - 1, 5 * MIN, 90 * MIN], 0.1, 1 << 18),
        (2, 3, [0, 1, MIN, 4 * MIN, 5 * MIN, 300 * MIN], 0.05, 11),  # many ranges, some sessions over two
        (3, 1, [MIN, 2 * MIN, 4 * MIN, 5 * MIN - 1], 0.0, 20),  # one island over all ranges, split by length alone
        (4, 2, [0, 0, 1], 0.0, 15),  # sessions over many ranges, many ties
    ],
)
def test_sessions_equal_brute_force(spark, seed, clients, step, finals, rows):
    clicks = clicks_of(seed, 240, clients, step, finals, 0.3)
    df = spark.createDataFrame([(*x, 5, "q") for x in clicks], SHAPE + ", us int, pid string")
    got = sorted(tuple(r) for r in sessions.sessionise(df, rows).collect())
    assert got == brute_sessions(clicks)


def test_sessions_of_late_clicks_only_empty_tables_and_odd_values(spark):
    t = DAY
    late = [(1, t, t + timedelta(hours=2), 1, "view", 1.0), (2, t + timedelta(minutes=1), t + timedelta(hours=3), 1, "view", 1.0)]
    assert sessions.sessionise(spark.createDataFrame(late, SHAPE), 1).count() == 0
    assert sessions.sessionise(spark.createDataFrame([], SHAPE)).count() == 0
    odd = spark.createDataFrame([(1, t, t, 1, "purchase", float("nan")), (2, t, t, 1, "purchase", float("inf")), (3, t, t, 1, None, 1e300)], SHAPE)
    got = sessions.sessionise(odd).orderBy("session_id").collect()
    assert [(r["session_id"], r["value_cents"], r["closed_by"]) for r in got] == [(1, 0, "end"), (2, 0, "end"), (3, 4 * 10**18, "none")]


def test_times_do_not_depend_on_the_zone_of_the_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([(1, 1)], "a int, b int").selectExpr("TIMESTAMP_NTZ'2024-03-31 02:30:00.000001' AS x")
        assert df.select(sessions.micros(df, "x")).first()[0] == 1_711_852_200_000_001
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
