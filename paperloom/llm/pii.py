"""Personal data: patterns propose spans, checks confirm them, words nearby raise or lower the score.

Patterns are scanned once over whole texts.  Card numbers have to pass Luhn's
check, account numbers (IBAN) their country's length and mod 97, addresses their
range, phone numbers their count of digits.  A kind starts at the score that its
check earns; words in the 40 characters on either side that speak for or
against it move the score.  Kinds in BASE are reported whatever their score, the
others from THRESHOLD on and where they touch no other span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, spool

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "local")

#: Scores in hundredths: at the start by kind, what a word for or against it moves, what the kinds beyond BASE need.
START = {"email": 90, "ip": 60, "card": 80, "phone": 70, "iban": 90, "local": 40}
MOVES, THRESHOLD, NEAR = 30, 50, 40

#: Words that speak for a kind, and words that speak against any.
FOR = {
    "email": "email|e-mail|mail|contact|write",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|whatsapp",
    "iban": "iban|account|bank|transfer",
    "local": "phone|tel|telephone|call|mobile|cell|fax|whatsapp",
}
AGAINST = "isbn|issn|version|order|invoice|sku|example|test"

#: Characters of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

#: Patterns, in forms that take one pass over runs of any length: what they match is what the plain forms match from the left.
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
LOCAL = re.compile(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}")
DIGITS = re.compile(r"[^0-9]+")
WORD_FOR = {k: re.compile(rf"(?<![a-z])(?:{v})(?![a-z])") for k, v in FOR.items()}
WORD_AGAINST = re.compile(rf"(?<![a-z])(?:{AGAINST})(?![a-z])")
TO_LOWER = {c: c + 32 for c in range(65, 91)}

FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:int>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the leftmost non-overlapping addresses: from each @ with a domain, back over what may stand before it."""
    free = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        from_ = max(free, text.rfind("@", free, at) + 1)
        start = from_ + len(text[from_:at].rstrip(LOCAL_PART))
        if start < at:
            free = m.end()
            yield start, free


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod_97(number: str) -> bool:
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def alone(text: str, start: int, end: int) -> bool:
    """Whether no ASCII letter or digit stands right before or after."""
    beside = text[max(0, start - 1) : start] + text[end : end + 1]
    return not any(c.isascii() and c.isalnum() for c in beside)


def iban_end(text: str, start: int, end: int) -> int:
    """Where the account number that a match may hold ends; 0 if it holds none."""
    size, at = IBAN_LENGTHS.get(text[start : start + 2], 0), start
    number = ""
    while len(number) < size and at < end:
        number += text[at].strip()
        at += 1
    return at if size and len(number) == size and alone(text, start, at) and mod_97(number) else 0


def score(kind: str, text: str, start: int, end: int) -> int:
    near = f"{text[max(0, start - NEAR) : start]}\n{text[end : end + NEAR]}".translate(TO_LOWER)
    moved = bool(WORD_FOR[kind].search(near)) - bool(WORD_AGAINST.search(near))
    return max(0, min(100, START[kind] + MOVES * moved))


def spans_of(text: str | None) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, score) by kind, then start; code points, end exclusive."""
    if not text:
        return []
    found = []
    if "@" in text:
        found += [("email", *x) for x in emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) < 256 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := DIGITS.sub("", m.group())) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.sub("", m.group())) <= 15]
    more = [("iban", m.start(), end) for m in IBAN.finditer(text) if (end := iban_end(text, *m.span()))]
    more += [("local", *m.span()) for m in LOCAL.finditer(text) if alone(text, *m.span())]
    out = [(*x, score(x[0], text, *x[1:])) for x in found]
    if more:
        taken = bytearray(len(text))
        for _, a, z in found:
            taken[a:z] = b"\1" * (z - a)
        for kind, a, z in more:
            if (s := score(kind, text, a, z)) >= THRESHOLD and taken.find(1, a, z) < 0:
                taken[a:z] = b"\1" * (z - a)
                out.append((kind, a, z, s))
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and its spans (kind, start, end, score in hundredths) by kind as in KINDS, then start.

    Null and empty texts have none.  Rows that repeat an id, or have none, are
    scanned one by one.  The scan runs when this is called; its result is a
    table.  Extra columns don't matter.
    """

    def scanned(batches):
        import pyarrow as pa

        shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())]))
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans_of(x.as_py())] for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, shape)], ["doc_id", "spans"])

    with small_batches(docs.sparkSession):
        return spool(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scanned, FOUND), "personal")


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
