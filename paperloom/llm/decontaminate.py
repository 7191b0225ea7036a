"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike: A-Z lower-cased, ASCII that is no
letter or digit turned to spaces, words parted by single spaces.  That is done
on UTF-8 bytes by a translation that keeps every byte in its place, so a word's
place in the original is known without a second pass.  Every window of 13 item
words (the whole item, if shorter) is a pattern; each text is scanned once.

The automaton is built on the driver and sent to each worker.  Its size is
checked: items beyond ``block_bytes`` of patterns are dealt into several
automata, each of which scans all rows, and the spans of a row are brought
together after by the row's number.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, spool

#: An automaton takes about 37 bytes of memory for each byte of its patterns, so 300 MB a worker at most.
WINDOW, BLOCK_BYTES = 13, 8 << 20

#: Bytes of words stay (A-Z as a-z), all others become spaces.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

KEYS = ("item_id", "word", "words", "start", "end")
SPAN = "array<struct<item_id:long,word:long,words:long,start:long,end:long>>"
FOUND = f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans {SPAN}"


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


def patterns_of(items: list[tuple[int, str | None]], window: int) -> dict[str, tuple[int, set[int]]]:
    """Pattern (a space at both ends, bytes as Latin-1) -> words in it, items that have it."""
    out: dict[str, tuple[int, set[int]]] = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i : i + window]
            out.setdefault(f" {b' '.join(part).decode('latin-1')} ", (len(part), set()))[1].add(item)
    return out


def automaton_of(patterns: dict[str, tuple[int, set[int]]]):
    import ahocorasick

    tree = ahocorasick.Automaton()
    for key, (n, items) in patterns.items():
        tree.add_word(key, (n, tuple(sorted(items))))
    tree.make_automaton()
    return tree


def automaton_in_worker(sent):
    """The automaton of a broadcast: a worker process builds it once for all its tasks, and keeps no more than one."""
    import sys

    kept = sys.__dict__.setdefault("_paperloom_automaton", {})
    key = hashlib.blake2b(sent.value).digest()
    if key not in kept:
        kept.clear()
        kept[key] = automaton_of(pickle.loads(sent.value))
    return kept[key]


def scan(text: str | None, tree) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """Words of the text, and an (item, first word, words, start, end) per occurrence; start and end are code points of the original."""
    import numpy as np

    if not text:
        return 0, []
    raw = text.encode()
    flat = raw.translate(TO_WORDS)
    words = flat.split()
    if not len(tree) or not words:
        return len(words), []
    found = list(tree.iter(f" {b' '.join(words).decode('latin-1')} "))
    if not found:
        return len(words), []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1)  # the space after each word, in the normalised text
    last = np.searchsorted(ends, [end for end, _ in found])
    isword = np.frombuffer(b" " + flat + b" ", np.uint8) != 32
    edges = np.flatnonzero(isword[1:] != isword[:-1])
    if len(raw) != len(text):  # bytes -> code points
        edges = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])[edges]
    starts, stops = edges[::2], edges[1::2]
    return len(words), [(item, int(k) - n + 1, n, int(starts[k - n + 1]), int(stops[k])) for (_, (n, items)), k in zip(found, last, strict=True) for item in items]


def _blocks(items: list[tuple[int, str | None]], window: int, block_bytes: int) -> Iterator[dict]:
    part, size = [], 0
    for item in items:
        cost = len((item[1] or "").encode()) * window
        if part and size + cost > block_bytes:
            yield patterns_of(part, window)
            part, size = [], 0
        part.append(item)
        size += cost
    yield patterns_of(part, window)


def covered(spans: list[dict]) -> int:
    """Words inside any of the spans."""
    n, upto = 0, -1
    for a, b in sorted((s["word"], s["word"] + s["words"]) for s in spans):
        n += max(0, b - max(a, upto))
        upto = max(upto, b)
    return n


def summed(ids: list, sizes: list[int], spans: list[list[dict]], share: int):
    """The Arrow batch of FOUND."""
    import pyarrow as pa

    hit = [covered(x) for x in spans]
    items = [sorted({str(s["item_id"]) for s in x}) for x in spans]
    sums = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    bad = [h > 0 and share * h >= n for h, n in zip(hit, sizes, strict=True)]
    shape = pa.list_(pa.struct([(n, pa.int64()) for n in KEYS]))
    cols = [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (sizes, hit, map(len, items))), pa.array(sums, pa.string()), pa.array(bad, pa.bool_()), pa.array(spans, shape)]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])


def verdicts(docs: DataFrame, items: DataFrame, share: int = 20, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` has every occurrence of an item's window with its place in words
    and in code points of the original.  A document is contaminated if at least
    one in ``share`` of its words lies in a span.  Items stream to the driver,
    which holds ``block_bytes`` of patterns at a time.  Null or empty texts have
    no words; items without words or without an id match nothing.  Rows that
    repeat an id, or have none, are scanned one by one; with several blocks of
    items, rows are numbered in a table first.  The scan runs when this is called;
    its result is a table.  Extra columns don't matter.
    """
    spark = docs.sparkSession
    rows = ((r[0], r[1]) for r in items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), F.col(item_text)).toLocalIterator())
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = _blocks(rows, window, block_bytes)
    first, second = next(blocks), next(blocks, None)

    def scanned(batches, sent):
        tree = automaton_in_worker(sent)
        for b in batches:
            got = [scan(x.as_py(), tree) for x in b.column(1)]
            yield summed(b.column(0).to_pylist(), [n for n, _ in got], [[dict(zip(KEYS, s, strict=True)) for s in spans] for _, spans in got], share)

    def scan_with(rows, patterns, tag, of):
        """The table of a scan; its automaton's broadcast goes when it is written."""
        sent = spark.sparkContext.broadcast(pickle.dumps(patterns, 5))
        out = spool(of(rows.mapInArrow(lambda batches: scanned(batches, sent), FOUND)), tag)
        sent.destroy()
        return out

    if second is None:
        with small_batches(spark):
            return scan_with(narrow, first, "verdicts", lambda found: found)
    with small_batches(spark):
        numbered = spool(narrow.withColumn("row", F.monotonically_increasing_id()), "numbered")  # a table, so that every scan sees the same numbers
        out = None
        for i, patterns in enumerate(chain((first, second), blocks)):
            some = lambda found, i=i: found.select(F.col("doc_id").alias("row"), "n_words", "spans").where(F.lit(i == 0) | (F.size("spans") > 0))
            part = scan_with(numbered.select(F.col("row").alias("doc_id"), "text"), patterns, "block", some)
            out = part if out is None else out.union(part)
        whole = out.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"))
        whole = numbered.select("row", "doc_id").join(whole, "row").select("doc_id", "n_words", "spans")

        def again(batches):
            for b in batches:
                yield summed(*(b.column(c).to_pylist() for c in ("doc_id", "n_words", "spans")), share)

        return spool(whole.mapInArrow(again, FOUND), "verdicts")
