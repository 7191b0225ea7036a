"""Substring dedup by hashing lines, paragraphs and passages.

A text is a row of words (A-Z lower-cased, parted by blanks or line ends).  Its
units are its paragraphs (what blank lines part; a text without blank lines is
one) of any length, its lines of ``line_words`` words or more, and every passage of
``min_words`` words in a row, wherever lines begin and end.  Units that have the
same words are copies of each other, be they lines or paragraphs.  Shorter lines are no units, as
they are headings, names and list items, which recur without being copies; a
paragraph of ``min_words`` words or more is covered by its passages.  Their digests are grouped over the whole
corpus; the occurrence that ranks first stays, all others are removed, within a
document, too.  Rank is by document, then by place; a passage that overlaps its
own earliest copy (a loop) stays.

Lines are grouped as they are.  Passages are too many for that, so they are
found in two steps, exactly up to collisions of 64-bit hashes:

Anchors.  Of all runs of half a passage, those are taken whose hash is the least
in any passage.  Passages that are equal have an anchor in common, so one none of
whose anchors occurs twice repeats nowhere.

Passages.  Every one around an anchor that occurs twice is hashed and grouped.

Whole copies of a longer text are found by one digest first; only the earliest
goes on.  What is removed is given in code points of the original text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, small_batches, spool
from .hashing import WordHasher

MIN_WORDS, LINE_WORDS, BATCH_WINDOWS = 50, 20, 1 << 15


def words_of(text: str | None) -> list[bytes]:
    """Words of the text, lower-cased."""
    return text.encode().lower().split() if text else []


def rows_of(hashes, k: int, hasher: WordHasher):
    """One hash for every ``k`` words in a row; none if there are fewer."""
    import numpy as np

    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    hasher.grow(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * hasher.power[:n])])
    return hasher.mix((sums[k:] - sums[:-k]) * hasher.inverse[: n - k + 1] + np.uint64(k))


def anchors(rows, width: int):
    """Places of the least (the first of equal ones) of every ``width`` hashes in a row."""
    import numpy as np

    if len(rows) < width:
        return np.empty(0, np.int64)
    at = np.lib.stride_tricks.sliding_window_view(rows, width).argmin(1)
    return np.unique(at + np.arange(len(at)))


def spots(raw: bytes):
    """First and last (exclusive) code points of the words."""
    import numpy as np

    blank = np.isin(np.frombuffer(b" " + raw + b" ", np.uint8), (32, 9, 10, 11, 12, 13))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    edges = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])[edges]
    return edges[::2], edges[1::2]


def _half(min_words: int) -> tuple[int, int]:
    """Words of an anchor, and how many such rows of words a passage has."""
    k = (min_words + 1) // 2
    return k, min_words - k + 1


def ranked(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str, bool]:
    """The rows with a rank of their own, its column, and whether it is the id, as it is where every row has one that no other has.

    Else rows rank by id, those without one last, then by a hash of the text;
    rows alike in both are interchangeable.
    """
    rank, mine = fresh(docs, "rank"), F.col(doc_id).cast("long")
    odd = docs.groupBy(mine.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
    if not odd.limit(1).count():
        return docs.withColumn(rank, mine), rank, True
    numbered = spool(docs.withColumn(rank, F.monotonically_increasing_id()), "numbered")
    narrow = numbered.select(F.col(rank).alias("row"), mine.alias("id"), F.xxhash64(text).alias("h")).orderBy(F.asc_nulls_last("id"), "h", "row")
    order = spool(narrow.select("row", F.monotonically_increasing_id().alias("place")), "order")
    return spool(numbered.join(order, F.col(rank) == F.col("row")).drop(rank, "row").withColumnRenamed("place", rank), "ranked"), rank, False


def blocks(sizes: list[int], line_words: int, min_words: int) -> list[tuple[int, int]]:
    """(first word, words) of the units among a text's lines, given their words: long lines, and paragraphs that passages don't cover, each once."""
    out, word, start = [], 0, 0
    for i, n in enumerate(sizes):
        if n >= line_words:
            out.append((word, n))
        word += n
        if n == 0 or i == len(sizes) - 1:
            if 0 < word - start < min_words and (start, word - start) not in out[-1:]:
                out.append((start, word - start))
            start = word
    return out


def unit_table(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """rank, n_words, a and b (128 bits of all words), first and last (code points), digests and places of the anchors, lines and paragraphs (digest, word, n, start, end), for every row of (rank, text)."""
    k, width = _half(min_words)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        h = WordHasher()
        of = pa.struct([("digest", pa.int64()), ("word", pa.int32()), ("n", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        for b in batches:
            out = {c: [] for c in ("n_words", "a", "b", "first", "last", "digests", "places", "lines")}
            for t in b.column(1):
                t = t.as_py() or ""
                raw = t.encode()
                x = h.words(raw.lower().split())
                rows = rows_of(x, k, h)
                at = anchors(rows, width)
                lines = []
                if len(x):
                    start, stop = None, None
                    for word, n in blocks([len(line.split()) for line in raw.split(b"\n")], line_words, min_words):
                        if start is None:
                            start, stop = spots(raw)
                        lines.append({"digest": int(h.mix(np.array([h.row(x[word : word + n])]) + np.uint64(n)).view(np.int64)[0]), "word": word, "n": n, "start": int(start[word]), "end": int(stop[word + n - 1])})
                out["n_words"].append(len(x))
                out["a"].append(int(np.int64(h.row(x).view(np.int64))) if len(x) else 0)
                out["b"].append(int(np.int64(h.row(h.mix(x)).view(np.int64))) if len(x) else 0)
                bare = t.strip(" \t\n\r\x0b\x0c")
                first = t.index(bare) if bare else 0
                out["first"].append(first)
                out["last"].append(first + len(bare))
                out["digests"].append(rows[at].view("int64"))
                out["places"].append(at.astype("int32"))
                out["lines"].append(lines)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(of))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True))], ["rank", *out])

    return docs.mapInArrow(run, "rank long, n_words int, a long, b long, first int, last int, digests array<long>, places array<int>, lines array<struct<digest:long,word:int,n:int,start:int,end:int>>")


def window_table(docs: DataFrame, asked: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """digest, rank, word, start, end of each passage around the anchors asked for, as (rank, place); start and end are code points."""
    k, _ = _half(min_words)
    texts = docs.join(asked.groupBy("rank").agg(F.collect_list("place").alias("places")), "rank")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        h, out, size = WordHasher(), [], 0
        names = ["digest", "rank", "word", "start", "end"]
        for b in batches:
            for d, t, places in zip(b.column("rank").to_pylist(), b.column("text"), b.column("places"), strict=True):
                raw = t.as_py().encode()
                rows = rows_of(h.words(raw.lower().split()), min_words, h)
                places = np.asarray(places.values)
                marks = np.zeros(len(rows) + 1, np.int64)
                np.add.at(marks, np.maximum(places - (min_words - k), 0), 1)
                np.add.at(marks, np.minimum(places + 1, len(rows)), -1)
                at = np.flatnonzero(np.cumsum(marks[:-1]))
                first, last = spots(raw)
                for i in range(0, len(at), BATCH_WINDOWS):
                    w = at[i : i + BATCH_WINDOWS]
                    out.append(pa.RecordBatch.from_arrays([pa.array(rows[w].view(np.int64)), pa.array(np.full(len(w), d, np.int64)), *(pa.array(x.astype(np.int32)) for x in (w, first[w], last[w + min_words - 1]))], names))
                    size += len(w)
                    if size >= BATCH_WINDOWS:
                        yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                        out, size = [], 0
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return texts.select("rank", "text", "places").mapInArrow(run, "digest long, rank long, word int, start int, end int")


def _later(units: DataFrame, apart: Column, tag: str) -> DataFrame:
    """The occurrences that go, and ``kept``, the rank of the earliest: units have digest, rank, word; ``apart`` says whether one in the earliest's own document goes."""
    # A table of its own: an aggregate in the join would keep AQE from splitting a frequent digest.
    first = units.groupBy("digest").agg(F.min(F.struct("rank", "word")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = spool(first.select("digest", F.col("f.rank").alias("kept"), F.col("f.word").alias("at")), tag)
    return units.join(first, "digest").where((F.col("kept") < F.col("rank")) | apart)


def spans_by_rank(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """rank, start, end, n_words, kept of every run of words to remove, for rows of (rank, text)."""
    with small_batches(docs.sparkSession):
        table = spool(unit_table(docs, min_words, line_words), "units")
        whole = spool(table.where(f"n_words >= {min_words}").groupBy("n_words", "a", "b").agg(F.min("rank").alias("kept"), F.max("rank").alias("z")).where("kept < z").drop("z"), "whole")
        copies = spool(table.where(f"n_words >= {min_words}").join(whole, ["n_words", "a", "b"]).where("rank <> kept").select("rank", "n_words", "first", "last", "kept"), "copies")
        table = table.join(copies.select("rank"), "rank", "left_anti")
        if copies.limit(1).count():
            table = spool(table.select("rank", "digests", "places", "lines"), "once")
        anchor = table.select("rank", F.explode(F.arrays_zip("digests", "places")).alias("x")).select("rank", F.col("x.digests").alias("digest"), F.col("x.places").alias("place"))
        shared = spool(anchor.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "shared")
        windows = spool(window_table(docs, anchor.join(shared, "digest").select("rank", "place"), min_words), "windows")
    discard(shared)
    passages = _later(windows, F.col("at") + min_words <= F.col("word"), "first")
    lines = table.select("rank", F.explode("lines").alias("x")).select("rank", "x.*")
    lines = _later(spool(lines, "lines"), F.col("at") < F.col("word"), "first-lines")
    gone = passages.select("rank", "word", F.lit(min_words).alias("n"), "start", "end", "kept").union(lines.select("rank", "word", "n", "start", "end", "kept"))

    by_doc = Window.partitionBy("rank").orderBy("word", F.desc("n"))
    upto = F.max(F.col("word") + F.col("n")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = gone.withColumn("new", F.when(F.col("word") <= upto, 0).otherwise(1)).withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    found = runs.groupBy("rank", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max(F.col("word") + F.col("n")) - F.min("word")).alias("n_words"), F.min("word").alias("word"), F.min(F.struct("word", "kept"))["kept"].alias("kept"))
    found = spool(found.drop("run"), "runs")
    discard(windows)
    # A whole copy is removed from its first word on, as its earliest copy may be, too.
    start = found.where("word = 0").select(F.col("rank").alias("of"), F.col("kept").alias("before"))
    whole = copies.join(start, F.col("kept") == F.col("of"), "left").select("rank", F.col("first").alias("start"), F.col("last").alias("end"), "n_words", F.coalesce("before", "kept").alias("kept"))
    return found.select("rank", "start", "end", "n_words", "kept").union(whole)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, end, n_words, kept_doc_id of every run of words that is removed: as long as can be, none touches another.

    ``kept_doc_id`` is the document that keeps the earliest copy of the unit the
    run begins with, and may be the document itself.  Equal texts of any length are
    copies: all but the earliest go whole.  Documents rank by id; rows
    that repeat an id are documents of their own and rank by a hash of the text,
    rows without an id rank last (their ``doc_id`` is null).  Null and empty
    texts have no units.  Extra columns don't matter.
    """
    rows, rank, by_id = ranked(docs, doc_id, text)
    found = spans_by_rank(rows.select(F.col(rank).alias("rank"), F.col(text).alias("text")), min_words, line_words)
    out = lambda d, kept: found.select(d, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("n_words").cast("long").alias("n_words"), kept)
    if by_id:
        return out(F.col("rank").alias("doc_id"), F.col("kept").alias("kept_doc_id"))
    ids = rows.select(F.col(rank).alias("r"), F.col(doc_id).cast("long").alias("id"))
    found = found.join(ids, F.col("rank") == F.col("r")).withColumnRenamed("id", "doc_id").drop("r")
    found = found.join(ids, F.col("kept") == F.col("r")).withColumnRenamed("id", "kept_doc_id").drop("r")
    return out("doc_id", "kept_doc_id")


def cut_out(text: str | None, spans: list[tuple[int, int]] | None) -> str | None:
    """The text without the spans, none of which touches another; null stays null."""
    if text is None or not spans:
        return text
    starts, ends = zip(*sorted(spans), strict=True)
    return "".join(text[a:b] for a, b in zip((0, *ends), (*starts, len(text)), strict=True))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with what repeats cut out of its text, and ``removed``, the spans in the original.

    If ``docs`` has a column of that name, the new one takes an underscore more.
    """
    rows, rank, _ = ranked(docs, doc_id, text)
    found = spans_by_rank(rows.select(F.col(rank).alias("rank"), F.col(text).alias("text")), min_words, line_words)
    removed, of = fresh(rows, "removed"), fresh(rows, "span_rank")
    spans = found.groupBy(F.col("rank").alias(of)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(removed))
    joined = rows.join(spans, F.col(rank) == F.col(of), "left")
    cut = F.udf(cut_out, "string", useArrow=True)
    joined = joined.withColumn(text, cut(F.col(text), F.col(removed)))
    return joined.withColumn(removed, F.coalesce(F.col(removed), F.array())).select(*docs.columns, removed)
