"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power of an exponent,
normalised.  Exponent 1 keeps the shares, 0 makes all sources equal.  The
largest exponent that meets the target entropy is found by bisection (several
halvings a pass: a grid of exponents is evaluated in one small aggregate), and
then raised, likewise, until no source is repeated beyond the limit.

Weights become a plan of blocks.  Block e of a source is its documents in a
pseudo-random order of their own; a source with a budget of 2.4 times its tokens
gets blocks 0 and 1 whole and block 2 as far as its tokens fit the budget.
Running sums go over hash ranges first, so no task sees a whole source.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bytes_of, spool

ENTROPY, REPEATS, GRID, PASSES, RANGES, SEED = 0.97, 4.0, 32, 5, 4096, "mix-1"
BROADCAST_BYTES = 16 << 20
#: Times that a plan may repeat a source in whole; four are usual.
MOST_BLOCKS = 10_000


def tokens_of(text: Column) -> Column:
    """Words of the text, parted by blanks, tabs and line ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def _search(shares: DataFrame, value, holds, lo: float, hi: float, upper: bool) -> float:
    """The largest (``upper``) or smallest exponent of [lo, hi] for which ``holds`` is true of ``value``; which must be monotone."""
    for _ in range(PASSES):
        step = (hi - lo) / GRID
        points = [lo + step * i for i in range(GRID + 1)]
        rows = value(shares.withColumn("x", F.explode(F.array(*map(F.lit, points))))).collect()  # one row a grid point
        got = {r["x"]: holds(r["v"]) for r in rows}
        good = [i for i, x in enumerate(points) if got.get(x, True)]
        if not good:
            return lo if upper else hi
        at = max(good) if upper else min(good)
        if upper:
            lo, hi = points[at], points[min(at + 1, GRID)]
        else:
            lo, hi = points[max(at - 1, 0)], points[at]
        if lo == hi:
            break
    return lo if upper else hi


def exponent(shares: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The exponent for (source, p) rows with shares p > 0: entropy is a share of the greatest possible, repeats the limit of (largest share / share) ** (1 - exponent)."""
    row = shares.agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("most"), F.min("p").alias("least")).first()
    if row["n"] < 2:
        return 1.0

    def entropies(grid: DataFrame) -> DataFrame:
        z, a = F.sum(F.pow("p", F.col("x"))), F.sum(F.pow("p", F.col("x")) * F.log("p"))
        return grid.groupBy("x").agg((F.log(z) - F.col("x") * a / z).alias("v"))

    def repetitions(grid: DataFrame) -> DataFrame:
        return grid.groupBy("x").agg(F.pow(F.lit(row["most"]) / F.min("p"), 1 - F.col("x")).alias("v"))

    import math

    alpha = _search(shares, entropies, lambda v: v >= entropy * math.log(row["n"]), 0.0, 1.0, True)
    if (row["most"] / row["least"]) ** (1 - alpha) > repeats:
        alpha = _search(shares, repetitions, lambda v: v <= repeats, alpha, 1.0, False)
    return alpha


def plan(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget_tokens: int | None = None, seed: str = SEED, most_blocks: int = MOST_BLOCKS, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document and block: doc_id, source, n_tokens, block (from 0), order_key, weight.

    Sorted by block and order_key, the rows are the mixed stream.  Without
    ``budget_tokens`` the budget is the least that uses every source at least
    once, so every document is in block 0.  Null sources are a source of their
    own, with a null name; documents without words ride along in every whole
    block; a source without any words has weight 0 and its documents are in
    block 0.  Repeated rows are documents of their own.  A budget under which a source
    would be repeated more than ``most_blocks`` times is a ValueError: the plan has a row for each.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-"))
    rows = spool(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), named.alias("s"), tokens_of(F.col(text)).alias("n_tokens")), "tokens")
    sums = spool(rows.groupBy("s").agg(F.sum("n_tokens").alias("t")), "sources")
    total = sums.agg(F.sum("t")).first()[0] or 0
    shares = sums.where("t > 0").select("s", "t", (F.col("t") / F.lit(float(total or 1))).alias("p"))
    alpha = exponent(shares, entropy, repeats)
    ends = shares.agg(F.sum(F.pow("p", F.lit(alpha))).alias("z"), F.max("p").alias("most")).first()
    z = ends["z"] or 1.0
    weight = F.pow("p", F.lit(alpha)) / F.lit(z)
    # The whole of the source that is repeated least: its share over its weight, in tokens.
    budget = float(budget_tokens) if budget_tokens is not None else total * (ends["most"] or 1.0) ** (1 - alpha) * z
    # 1e-9: a source that is used exactly n times gets its n blocks whole, whatever the rounding.
    copies = shares.select("s", "t", weight.alias("weight"), (weight * F.lit(budget) / F.col("t") + F.lit(1e-9)).alias("r"))
    quota = sums.join(copies.drop("t"), "s", "left").select("s", "t", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.floor(F.coalesce("r", F.lit(1.0))).alias("whole"), F.coalesce("r", F.lit(1.0)).alias("r"))
    quota = quota.withColumn("rest", F.floor((F.col("r") - F.col("whole")) * F.col("t")))

    key = lambda block: F.md5(F.concat_ws("|", F.lit(seed), block.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # A row a source: broadcast if they are few, else a join that AQE deals out where a source is hot.
    quota = spool(quota, "quota")
    _, size = bytes_of(quota, F.octet_length("s") + 48)
    most = quota.agg(F.max("whole")).first()[0] or 0
    if most > most_blocks:
        raise ValueError(f"the budget repeats a source {most} times; at most {most_blocks} are planned")
    named_rows = rows.join(F.broadcast(quota) if size <= BROADCAST_BYTES else quota, "s")
    full = named_rows.where("whole > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1))).withColumn("order_key", key(F.col("block")))

    last = named_rows.where("rest > 0").withColumn("block", F.col("whole").cast("int")).withColumn("order_key", key(F.col("block")))
    last = last.withColumn("range", F.pmod(F.conv(F.substring("order_key", 1, 3), 16, 10).cast("int"), F.lit(RANGES)))
    ranges = last.groupBy("s", "range").agg(F.sum("n_tokens").alias("own"))
    ranges = ranges.select("s", "range", (F.sum("own").over(Window.partitionBy("s").orderBy("range")) - F.col("own")).alias("before"))
    running = F.col("before") + F.sum("n_tokens").over(Window.partitionBy("s", "range").orderBy("order_key", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    part = last.join(ranges, ["s", "range"]).withColumn("upto", running).where("upto <= rest")

    cols = ["doc_id", "source", "n_tokens", "block", "order_key", "weight"]
    return full.select(*cols).union(part.select(*cols))
