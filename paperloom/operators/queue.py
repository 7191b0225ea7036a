"""Work queues: requests packed into batches, responses checked and merged into a checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.ids import canonical_list
from paperloom.functions.text import translation_faults
from paperloom.operators.state import require_empty
from paperloom.schema import fresh, text_of
from paperloom.storage import spool

MAX_ITEMS, MAX_CHARS = 24, 16_000


def source_chars() -> Column:
    return F.greatest(F.length(text_of(F.col("title"))) + F.length(text_of(F.col("excerpt"))), F.lit(1))


def _next_start(chars: list[int], max_items: int, max_chars: int) -> list[int]:
    """For each item, where the batch after the one that it starts begins."""
    out, end, size = [0] * len(chars), 0, 0
    for i, c in enumerate(chars):
        if end <= i:
            end, size = i + 1, c
        while end < len(chars) and end - i < max_items and size + chars[end] <= max_chars:
            size += chars[end]
            end += 1
        out[i] = end
        size -= c
    return out


def _block_summary(chars: list[int], max_items: int, max_chars: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """(head, batches, items, size): the first items' characters, and for each of them as the first start in the block
    how many batches start in it and what the last of them holds at its end."""
    n, after = len(chars), _next_start(chars, max_items, max_chars)
    count, last = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        count[i], last[i] = (1, i) if after[i] >= n else (1 + count[after[i]], last[after[i]])
    first = range(min(n, max_items))
    return chars[:max_items], [count[i] for i in first], [n - last[i] for i in first], [sum(chars[last[i] :]) for i in first]


def _entries(blocks: list[dict], max_items: int, max_chars: int) -> list[tuple[int, int]]:
    """(first start, batches before) of each block of a queue, in order; the first start is the block's length where none is in it."""
    out, batch, items, size = [], 0, max_items, 0  # before the first block, a full batch: the first item starts one
    for b in blocks:
        at = 0
        while at < len(b["head"]) and items < max_items and size + b["head"][at] <= max_chars:
            items, size, at = items + 1, size + b["head"][at], at + 1
        out.append((at, batch))
        if at < len(b["head"]):
            batch, items, size = batch + b["batches"][at], b["items"][at], b["size"][at]
    return out


def pack(items: DataFrame, max_items: int = MAX_ITEMS, max_chars: int = MAX_CHARS, by: str | None = None, order: str = "position", chars: str = "chars") -> DataFrame:
    """Items in order with batch (from 1) (W8): a new one when it would have more items or characters than allowed.

    Greedy packing is a sequence.  Each queue (``by``; without, all items are one) is dealt by ranges of ``order`` to
    blocks.  A block says, for each of its first ``max_items`` items, how packing that starts there ends; these few numbers
    a block are folded in order, and then all blocks are packed side by side, each row as it is, so that rows out are
    rows in.  No task holds more than a block.  A null place comes first, a null queue is a queue; equal places go by a hash
    of the row.  A null number of characters counts as none.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    q = by or fresh(items, "_queue")
    rows = items if by else items.withColumn(q, F.lit(1))
    block, size, tie = (fresh(rows, c) for c in ("_block", "_chars", "_tie"))
    rows = rows.withColumn(size, F.coalesce(F.col(chars).cast("long"), F.lit(0))).withColumn(tie, F.xxhash64(F.to_json(F.struct(*items.columns))))
    rows = spool(rows.repartitionByRange(q, order, tie).withColumn(block, F.spark_partition_id()), "queue")
    kinds = dict(rows.dtypes)
    numbers = pa.list_(pa.int64())

    def in_order(t):
        nulls_first = pc.sort_indices(t.select([order, tie]), sort_keys=[(order, "ascending"), (tie, "ascending")], null_placement="at_start")
        return t.take(nulls_first)

    def summary(t):
        made = _block_summary(in_order(t).column(size).to_pylist(), max_items, max_chars)
        return pa.Table.from_arrays([t.column(q).slice(0, 1), t.column(block).slice(0, 1), *[pa.array([m], numbers) for m in made]], [q, block, "head", "batches", "items", "size"])

    def entries(t):
        t = t.sort_by(block)
        made = _entries(t.select(["head", "batches", "items", "size"]).to_pylist(), max_items, max_chars)
        return pa.Table.from_arrays([t.column(q), t.column(block), pa.array([a for a, _ in made], pa.int64()), pa.array([b for _, b in made], pa.int64())], [q, block, "at", "before"])

    def packed(t, start):
        if not t.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in t.schema] + [pa.array([], pa.int32())], [*t.column_names, "batch"]).drop_columns([block, size, tie])
        t = in_order(t)
        at, batch = start.column("at")[0].as_py(), start.column("before")[0].as_py()
        after, number = _next_start(t.column(size).to_pylist(), max_items, max_chars), []
        while len(number) < t.num_rows:
            stop = at if not number and at else after[len(number)]
            batch += 0 if not number and at else 1
            number += [batch] * (stop - len(number))
        return t.drop_columns([block, size, tie]).append_column("batch", pa.array(number, pa.int32()))

    lists = "head array<bigint>, batches array<bigint>, items array<bigint>, size array<bigint>"
    blocks = rows.select(q, block, order, size, tie).groupBy(q, block).applyInArrow(summary, f"`{q}` {kinds[q]}, {block} int, {lists}")
    starts = blocks.groupBy(q).applyInArrow(entries, f"`{q}` {kinds[q]}, {block} int, at bigint, before bigint")
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in rows.columns if c not in (block, size, tie)) + ", batch int"
    out = rows.groupBy(q, block).cogroup(starts.groupBy(q, block)).applyInArrow(packed, shape)
    return out if by else out.drop(q)


def batch_ids(packed: DataFrame, request_sha: str) -> DataFrame:
    """(batch, batch_id, item_ids, chars): a batch is named by the request, its number and its items."""
    lists = packed.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "item_id"))), lambda s: s["item_id"]).alias("item_ids"), F.sum("chars").alias("chars"))
    return lists.withColumn("batch_id", F.sha2(F.concat_ws("|", F.lit(request_sha), F.col("batch").cast("string"), F.to_json("item_ids")), 256))


def batch_of(packed: DataFrame, batch: int) -> DataFrame:
    """The items of a batch, in order."""
    return packed.where(F.col("batch") == batch).orderBy("position")


def request_sha(items: DataFrame) -> DataFrame:
    """(position, item_sha): what a response is bound to."""
    return items.select("position", F.sha2(canonical_list(F.col("item_id"), F.col("title"), F.col("excerpt")), 256).alias("item_sha"))


def plan_violations(packed: DataFrame, stated: DataFrame) -> DataFrame:
    """Items whose batch isn't what packing gives."""
    again = packed.select("item_id", "batch")
    return again.exceptAll(stated.select("item_id", "batch")).unionAll(stated.select("item_id", "batch").exceptAll(again))


def response_faults(plan: DataFrame, response: DataFrame) -> DataFrame:
    """(item_id, fault) of a batch's response (U3, U4, F12): missing, repeated, foreign or misplaced items, and broken rules.

    ``plan`` has (item_id, position, title, excerpt) of the batch, ``response`` (item_id, place, title_out, summary_out).
    """
    want = plan.withColumn("_place", F.row_number().over(Window.orderBy("position")))  # a batch is at most MAX_ITEMS rows
    r = response.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"), F.min("place").alias("place"), F.first("title_out").alias("title_out"), F.first("summary_out").alias("summary_out"))
    both = want.join(r, "item_id", "full_outer")
    one = lambda c, code: F.when(c, F.lit(code))
    there = F.col("_place").isNotNull() & F.col("_n").isNotNull()
    faults = F.array_compact(F.array(one(F.col("_n").isNull(), "MISSING"), one(F.col("_place").isNull(), "UNKNOWN"), one(F.col("_n") > 1, "REPEATED"), one(there & (F.col("_place") != F.col("place")), "OUT_OF_ORDER")))
    more = F.when(there, translation_faults(F.col("title"), F.col("excerpt"), F.col("title_out"), F.col("summary_out"))).otherwise(F.array().cast("array<string>"))
    return both.select("item_id", F.explode(F.concat(faults, more)).alias("fault"))


def merge_checkpoint(checkpoint: DataFrame, response: DataFrame, plan: DataFrame) -> DataFrame:
    """The checkpoint with a batch's items, in request order (U5); raises if one is there already with another result."""
    c, r = checkpoint.alias("c"), response.alias("r")
    both = c.join(r, F.col("c.item_id") == F.col("r.item_id"), "full_outer")
    odd = both.where("c.item_id is not null and r.item_id is not null and not (c.title_out <=> r.title_out and c.summary_out <=> r.summary_out)")
    require_empty(odd.select("c.item_id"), "items answered differently before")
    out = both.select(F.coalesce("c.item_id", "r.item_id").alias("item_id"), F.coalesce("c.title_out", "r.title_out").alias("title_out"), F.coalesce("c.summary_out", "r.summary_out").alias("summary_out"))
    return out.join(plan.select("item_id", "position"), "item_id").orderBy("position")


def partial_batches(checkpoint: DataFrame, packed: DataFrame) -> DataFrame:
    """(batch, done, planned) of batches that are begun but not complete."""
    done = packed.join(checkpoint.select("item_id").distinct(), "item_id", "left_semi").groupBy("batch").agg(F.count(F.lit(1)).alias("done"))
    return packed.groupBy("batch").agg(F.count(F.lit(1)).alias("planned")).join(done, "batch").where("done < planned")


def final_response(checkpoint: DataFrame, packed: DataFrame) -> DataFrame:
    """All items in request order (K17); raises if any is missing."""
    require_empty(packed.select("item_id").exceptAll(checkpoint.select("item_id")), "items without an answer")
    return checkpoint.join(packed.select("item_id", "position"), "item_id").orderBy("position").select("position", "item_id", "title_out", "summary_out")


def map_adaptively(items: DataFrame, call, schema: str, size: int = 24, text: str = "title") -> DataFrame:
    """Each item's answer from a function of a list of texts.

    A call that fails is tried again on both halves, down to single items, whose
    answer is then null.  Partitions are the concurrency; order is kept by the items' own columns.
    """

    def solve(texts):
        try:
            got = call(texts)
            if len(got) == len(texts):
                return got
        except Exception:  # noqa: BLE001  any failure of the outside service halves the batch
            pass
        half = len(texts) // 2
        return solve(texts[:half]) + solve(texts[half:]) if half else [None]

    def run(frames):
        for f in frames:
            answers = [a for i in range(0, len(f), size) for a in solve(f[text].iloc[i : i + size].tolist())]
            yield f.assign(answer=answers)

    return items.mapInPandas(run, schema)
