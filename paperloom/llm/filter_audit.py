"""Filter interaction audit: what each filter removes at each place of each order, by part.

Every document has five bits, one for each filter it fails.  A table of 32 rows
(bits) by 120 columns (orders) names the step at which an order removes a
document with these bits, so a batch is judged by one look-up, and counts by
part, order and step are one ``bincount`` for each label.  Tasks send sums, never
rows; sums of tasks are added by part and place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, spool

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)

#: Least words, least share of distinct words and greatest share of capitals in percent, symbols that no document may hold.
WORDS, DISTINCT, CAPITALS, SYMBOLS = 200, 50, 2, r"[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"

#: Parts whose sums one task holds at a time: 60 MB.
PARTS_HELD = 4096

#: Places of a part's array of sums: removed, good_lost, toxic_lost by order and step; failures by filter; failures of one filter only; documents.
CELLS = len(ORDERS) * STEPS
SIZE = 3 * CELLS + 2 * STEPS + 1

REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failed_alone(text: Column) -> Column:
    """Bits of the filters that look at one text: A is 1, B 2, C 4, D 8."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    n, capitals = F.size(words), F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = (n < WORDS, 100 * F.size(F.array_distinct(words)) < DISTINCT * n, 100 * capitals.cast("long") > CAPITALS * F.length(text), text.rlike(SYMBOLS))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def first_failures():
    """(bits, order) -> step that removes, from 0; STEPS if none does."""
    import numpy as np

    bits = np.arange(1 << STEPS)[:, None, None]
    at = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])[None]
    fails = (bits >> at) & 1
    return np.where(fails.any(2), fails.argmax(2), STEPS)


def _summed(batches: Iterator) -> Iterator:
    """Per part, sums over a task's documents."""
    import numpy as np
    import pyarrow as pa

    table, orders, wide = first_failures(), np.arange(len(ORDERS)), STEPS + 1
    masks = np.arange(1 << STEPS)
    fails = ((masks[:, None] >> np.arange(STEPS)) & 1).astype(np.int64)
    alone = (masks[:, None] == (1 << np.arange(STEPS))).astype(np.int64)
    held: dict[str, int] = {}
    sums = np.zeros((0, SIZE), np.int64)

    def out():
        flat = pa.array(sums[: len(held)].ravel(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * SIZE, pa.int32()), flat)], ["part", "sums"])

    for b in batches:
        coded = b.column("part").dictionary_encode()
        if held and len(held) + len(coded.dictionary) > PARTS_HELD:
            yield out()
            held, sums = {}, np.zeros((0, SIZE), np.int64)
        place = np.array([held.setdefault(p, len(held)) for p in coded.dictionary.to_pylist()], np.int64)
        if len(held) > len(sums):
            sums = np.concatenate([sums, np.zeros((2 * len(held) - len(sums), SIZE), np.int64)])
        if not len(coded):
            continue
        part, mask = place[coded.indices.to_numpy()], b.column("mask").to_numpy()
        n = len(held)
        key = (part[:, None] * len(ORDERS) + orders) * wide + table[mask]
        for k, rows in enumerate((slice(None), b.column("good").to_numpy(zero_copy_only=False), b.column("toxic").to_numpy(zero_copy_only=False))):
            cells = np.bincount(key[rows].ravel(), minlength=n * len(ORDERS) * wide).reshape(n, len(ORDERS), wide)
            sums[:n, k * CELLS : (k + 1) * CELLS] += cells[:, :, :STEPS].reshape(n, CELLS)
        by_mask = np.bincount(part * len(masks) + mask, minlength=n * len(masks)).reshape(n, len(masks))
        sums[:n, 3 * CELLS :] += np.concatenate([by_mask @ fails, by_mask @ alone, by_mask.sum(1, keepdims=True)], 1)
    if held:
        yield out()


def _report(batches: Iterator) -> Iterator:
    """The rows of each part from its sums."""
    import numpy as np
    import pyarrow as pa

    letter = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        lists = b.column("sums").flatten()
        at, value = lists.field("pos").to_numpy(), lists.field("n").to_numpy()
        part = np.repeat(np.arange(n), np.diff(b.column("sums").offsets.to_numpy()))
        sums = np.zeros((n, SIZE), np.int64)
        sums[part, at] = value
        removed, good, toxic = sums[:, : 3 * CELLS].reshape(n, 3, len(ORDERS), STEPS).transpose(1, 0, 2, 3)
        fails, alone, total = sums[:, 3 * CELLS : 3 * CELLS + STEPS], sums[:, 3 * CELLS + STEPS : -1], sums[:, -1]
        shapley = np.stack([removed[:, letter == f].sum(1) for f in range(STEPS)], 1)
        cols = (total[:, None, None] - removed.cumsum(2), removed, fails[:, letter] - removed, alone[:, letter], good, toxic, shapley[:, letter])
        part = np.repeat(np.arange(n), CELLS)
        names = [pa.array(b.column("part")).take(pa.array(part)), pa.array(np.tile(np.repeat(ORDERS, STEPS), n), pa.string()), pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), n * len(ORDERS)))]
        yield pa.RecordBatch.from_arrays([*names, *(pa.array(c.ravel(), pa.int64()) for c in cols)], [c.split()[0] for c in REPORT.split(", ")])


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per row of ``docs``: part, mask (bits of the filters it fails), good, toxic.

    Equal texts are known by 128-bit digests.  The smallest id of each is a table,
    as is what labels say of each id, so that a join on a text that is everywhere, or
    on an id, is one that Spark can split.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = spool(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), failed_alone(t).alias("mask"), F.unhex(F.md5(t)).alias("key")), "masks")
    first = spool(rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first")
    says = spool(labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")), "labels")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    found = rows.join(first, "key", "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).join(says, "doc_id", "left")
    return found.select("part", "mask", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, filter order and step: REPORT's columns; zeros included.

    Null texts are empty, a null part is the empty string.  A row without id copies
    nothing and is copied by nothing; rows that repeat an id count each, and
    rows of one id and text are no copies of each other.  An id with several labels
    has all of them; labels without id say nothing.  No documents, no rows.
    """
    sums = judged(docs, labels, doc_id, text, part).mapInArrow(_summed, "part string, sums array<long>")
    cells = sums.select("part", F.posexplode("sums").alias("pos", "n")).where("n <> 0").groupBy("part", "pos").agg(F.sum("n").alias("n"))
    whole = cells.groupBy("part").agg(F.collect_list(F.struct("pos", "n")).alias("sums"))  # SIZE numbers at most
    return whole.mapInArrow(_report, REPORT)
