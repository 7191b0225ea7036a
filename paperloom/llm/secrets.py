"""Secret scans: three fixed patterns, and a battery of randomness tests for what they miss.

Offsets come without a marker in the text: splitting by a pattern and extracting
it give pieces and matches that alternate, so running sums of their lengths are
the offsets, in code points.

Every run of 20 or more token characters that mixes letters and digits gets an
encoding (hex, base32, base36, base62 or base64) and three tests of uniform
randomness: chi-squared over the encoding's alphabet, runs above and below its
middle, and serial correlation, combined into one p-value by the Cauchy rule.
A token is reported if it looks random and, for tokens of its encoding and
length class, the share of structured text among those that look so random is
at most ``fdr``: long tokens pass on weaker p-values than short ones, whose tests can
tell less.  DataFrame functions only.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spool

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so this is AKIA[A-Z0-9]+ of 20 or more
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

#: The alphabets of the encodings, in their order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
FDR, BINS, HALF = 0.1, 20, 0.5

#: Matches of a text that are folded in one list; more are folded in parts, as a list is copied for each match added to it.
PART = 128

SPAN = "struct<start:int,kind:int,end:int>"


def _matches(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0, with_token: bool = False) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has ``least`` characters or more."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    size = F.regexp_extract_all(text, F.lit(pattern), group) if group else hits
    steps = F.arrays_zip(pieces.alias("p"), hits.alias("h"), size.alias("s"))
    steps = F.filter(steps, lambda x: x["h"].isNotNull())
    shape = f"array<{SPAN}>" if not with_token else "array<struct<start:int,kind:int,end:int,token:string>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["h"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), *([x["h"].alias("token")] if with_token else []))
        return F.struct(end.alias("at"), F.when(F.length(x["s"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def fold(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.struct(start.alias("at"), F.array().cast(shape).alias("out")), step, lambda acc: acc["out"])

    def in_parts(parts: Column) -> Column:
        sizes = F.transform(parts, lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x["p"]) + F.length(x["h"])))
        starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(parts, F.slice(starts, 1, F.size(parts)), fold))

    def whole(xs: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / PART).cast("int")), lambda i: F.slice(xs, i * PART + 1, F.lit(PART)))
        return F.when(F.size(xs) <= PART, fold(xs, F.lit(0))).otherwise(F.element_at(F.transform(F.array(parts), in_parts), 1))

    return F.element_at(F.transform(F.array(steps), whole), 1)


def _where(condition: Column, spans: Column, shape: str = SPAN) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(f"array<{shape}>"))


def _upper_tail(z: Column) -> Column:
    """P(normal > z), within 2e-4."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _encoded(token: Column) -> Column:
    """(encoding or null, text in the encoding's alphabet): null for tokens that are all letters or all digits."""
    bare = F.rtrim(token, F.lit("="))
    mixed = bare.rlike("[0-9]") & bare.rlike("[A-Za-z]")
    name = F.when(~mixed, F.lit(None)).when(bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(bare.rlike("^[A-Z2-7]+$"), "base32").when(bare.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), "base36").when(bare.rlike("^[A-Za-z0-9]+$"), "base62").otherwise("base64")
    return F.struct(name.alias("name"), F.when(name.isin("hex", "base36"), F.lower(bare)).otherwise(F.translate(bare, "-_", "+/")).alias("text"))


def _with_p_value(x: Column) -> Column:
    """Span, encoding, length and the combined p-value of the three tests, from a span with its encoded text."""
    alphabet = F.lit(None).cast("string")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(x["enc"]["name"] == name, F.lit(letters)).otherwise(alphabet)
    coded = F.transform(F.array(F.struct(x["enc"]["text"].alias("t"), alphabet.alias("a"))), lambda e: F.struct(e["t"].alias("t"), e["a"].alias("a"), F.length(e["t"]).cast("double").alias("n"), F.length(e["a"]).cast("double").alias("k"), F.transform(F.split(e["t"], ""), lambda c: F.instr(e["a"], c).cast("double")).alias("c")))

    def sums(e: Column) -> Column:
        n, c = e["n"], e["c"]
        squares = F.aggregate(F.split(e["a"], ""), F.lit(0.0), lambda acc, ch: acc + F.pow(n - F.length(F.replace(e["t"], ch, F.lit(""))), F.lit(2.0)))
        mean = F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v) / n
        high = F.aggregate(c, F.lit(0.0), lambda acc, v: acc + F.when(v > e["k"] / 2, 1.0).otherwise(0.0))
        pairs = F.arrays_zip(F.slice(c, 1, F.size(c) - 1).alias("u"), F.slice(c, 2, F.size(c) - 1).alias("v"))
        turns = F.aggregate(pairs, F.lit(1.0), lambda acc, p: acc + F.when((p["u"] > e["k"] / 2) != (p["v"] > e["k"] / 2), 1.0).otherwise(0.0))
        return F.struct(n.alias("n"), e["k"].alias("k"), squares.alias("squares"), mean.alias("mean"), high.alias("high"), turns.alias("turns"), c.alias("c"), pairs.alias("pairs"))

    def serial(e: Column) -> Column:
        m = e["mean"]
        top = F.aggregate(e["pairs"], F.lit(0.0), lambda acc, p: acc + (p["u"] - m) * (p["v"] - m))
        base = F.aggregate(e["c"], F.lit(0.0), lambda acc, v: acc + (v - m) * (v - m))
        return F.struct(*[e[f].alias(f) for f in ("n", "k", "squares", "high", "turns")], F.when(base > 0, top / base).otherwise(1.0).alias("r"))

    def p_value(e: Column) -> Column:
        n, k = e["n"], e["k"]
        chi = (k / n * e["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        both = 2 * e["high"] * (n - e["high"])
        runs = F.when(both > 0, (e["turns"] - both / n - 1) / F.sqrt(F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9)))).otherwise(9.0)
        lag = (e["r"] + 1 / n) * F.sqrt(n)
        each = [_upper_tail(chi), 2 * _upper_tail(F.abs(runs)), 2 * _upper_tail(F.abs(lag))]
        safe = [F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), p)) for p in each]
        return 0.5 - F.atan(sum((F.tan((0.5 - p) * math.pi) for p in safe[1:]), F.tan((0.5 - safe[0]) * math.pi)) / 3) / math.pi

    p = F.transform(F.transform(F.transform(coded, sums), serial), p_value)
    return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["enc"]["name"].alias("enc"), F.floor(F.log2(F.length(x["enc"]["text"]).cast("double")) * 2).cast("int").alias("size"), F.xxhash64(x["enc"]["text"]).alias("key"), F.element_at(p, 1).alias("p"))


def thresholds(bins: list[tuple[str, int, int, int]], fdr: float = FDR) -> dict[tuple[str, int], float]:
    """Least p-value that counts as random for each (encoding, length class), from (encoding, class, bin, tokens) rows.

    Of a class's tokens, those in the upper half of p-values tell how many are
    random: p-values of random tokens are uniform.  The rest among the tokens with a
    p-value of at least t are false; t is the least for which they are few enough.
    """
    found: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0] * BINS)
    for enc, size, b, n in bins:
        found[enc, size][min(b, BINS - 1)] += n
    out = {}
    for key, counts in found.items():
        random = min(1.0, sum(counts[int(BINS * HALF) :]) / (1 - HALF) / sum(counts)) * sum(counts)
        for i in range(int(BINS * HALF) + 1):
            above = sum(counts[i:])
            if above and max(0.0, above - random * (1 - i / BINS)) / above <= fdr:
                out[key] = max(i / BINS, 0.01)
                break
    return out


def scan(docs: DataFrame, fdr: float = FDR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans, both arrays of (start, kind, end) by start, kind, end.

    ``kind`` is an index into KINDS; end is exclusive.  ``base`` has the fixed
    patterns' spans; ``spans`` has those and the random tokens that touch none of
    them.  Null and empty texts have none; repeated rows get equal results, and
    equal tokens count once for the false-discovery control.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    long_run = t.rlike(TOKEN)  # every access and hex match lies in such a run
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.concat(
            _where(t.rlike(ASSIGN), _matches(t, ASSIGN, 0, 6, 2)),
            _where(long_run, _matches(t, ACCESS, 1)),
            _where(long_run, _matches(t, HEX, 2)),
        ).alias("base"),
        _where(long_run, _matches(t, TOKEN, 3, with_token=True), "struct<start:int,kind:int,end:int,token:string>").alias("tokens"),
    )
    coded = F.filter(F.transform("tokens", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), _encoded(x["token"]).alias("enc"))), lambda x: x["enc"]["name"].isNotNull())
    rows = spool(rows.select("doc_id", "base", F.transform(coded, _with_p_value).alias("tokens")), "tokens")
    distinct = rows.where(F.size("tokens") > 0).select(F.explode("tokens").alias("x")).groupBy("x.enc", "x.size", "x.key").agg(F.first("x.p").alias("p"))
    bins = distinct.groupBy("enc", "size", F.floor(F.col("p") * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 5 x 60 x 20 rows

    least = thresholds([tuple(r) for r in bins], fdr)

    def passes(x: Column) -> Column:
        limit = F.lit(2.0)
        for (enc, size), p in least.items():
            limit = F.when((x["enc"] == enc) & (x["size"] == size), p).otherwise(limit)
        return (x["p"] >= limit) & ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    more = F.transform(F.filter("tokens", passes), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return rows.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", more)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
