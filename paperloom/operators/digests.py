"""Digest trees: proofs that long lists are the same, which name the first item where they aren't.

Items stand at places 0, 1, 2 and so on.  A leaf is the digest of an item, a node that of at most
``FANOUT`` children in their order, so a tree over n items has log n levels, each of
them one grouped pass with a bounded list a group.  Comparing two trees goes down from
the top and reads one node's children a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.ids import canonical_list
from paperloom.operators.rules import union
from paperloom.operators.state import require_empty
from paperloom.schema import fresh
from paperloom.storage import spool

FANOUT = 256


def numbered(rows: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """Rows with their number, from 0, in an order: ranges of it are numbered side by side, and only the ranges' sizes are summed in one place.

    Rows that tie are numbered by a hash of what they hold.
    """
    tie, block, at = (fresh(rows, c) for c in ("_tie", "_block", "_at"))
    dealt = spool(rows.withColumn(tie, F.xxhash64(F.to_json(F.struct(*rows.columns)))).repartitionByRange(*order, tie).withColumn(block, F.spark_partition_id()), "numbered")
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = dealt.groupBy(block).agg(F.count(F.lit(1)).alias("_n")).select(block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    own = dealt.withColumn(at, F.row_number().over(Window.partitionBy(block).orderBy(*order, tie)))
    return own.join(sizes, block).select(*rows.columns, (F.col(at) - 1 + F.col("_n")).alias(name))


def tree(items: DataFrame, place: str, *fields: str | Column, fanout: int = FANOUT) -> DataFrame:
    """(level, node, digest) of all nodes: level 0 has the items, the last level one node, the root.  No items, no nodes.

    Places are whole numbers from 0, each once; else StateConflict.
    """
    leaves = spool(items.select(F.lit(0).alias("level"), F.col(place).cast("long").alias("node"), F.sha2(canonical_list(*[F.col(f) if isinstance(f, str) else f for f in fields]), 256).alias("digest")), "leaves")
    require_empty(leaves.where("node IS NULL OR node < 0"), "items without a place")
    require_empty(leaves.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "places with several items")
    top, out, level = leaves.agg(F.max("node")).first()[0], leaves, 0
    below = leaves
    while top:
        level, top = level + 1, top // fanout
        parts = F.array_sort(F.collect_list(F.struct("node", "digest")))
        joined = F.array_join(F.transform(parts, lambda p: F.concat_ws(":", (p["node"] % fanout).cast("string"), p["digest"])), ",")
        below = spool(below.groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(F.sha2(joined, 256).alias("digest")).select(F.lit(level).alias("level"), "node", "digest"), "level")
        out = out.unionByName(below)
    return out


def root(nodes: DataFrame) -> str | None:
    """The digest at the top; None of an empty list."""
    row = nodes.orderBy(F.desc("level")).select("digest").limit(1).collect()
    return row[0]["digest"] if row else None


def first_difference(a: DataFrame, b: DataFrame, fanout: int = FANOUT) -> int | None:
    """The first place where two lists differ, or where one of them ends; None if they are equal.  Both trees have the same fanout."""
    level = max((t.agg(F.max("level")).first()[0] for t in (a, b)), key=lambda x: -1 if x is None else x)
    if level is None:
        return None
    node = None
    for at in range(level, -1, -1):
        some = [t.where((F.col("level") == at) if node is None else (F.col("level") == at) & F.col("node").between(node * fanout, node * fanout + fanout - 1)).select("node", F.col("digest").alias(n)) for t, n in ((a, "x"), (b, "y"))]
        found = some[0].join(some[1], "node", "full_outer").where("NOT x <=> y").agg(F.min("node")).first()[0]
        if found is None and node is None and at == level:
            return None
        node = found
    return node


def checkpoint_faults(plan: DataFrame, checkpoint: DataFrame, bound_to: str | None = None) -> DataFrame:
    """(rule, key, detail) for what a checkpoint holds that its plan doesn't allow.

    ``plan`` has (item_id, position, batch), ``checkpoint`` (item_id, place).  Items have to be the plan's, each once, in its order,
    and batches whole; ``bound_to`` is the root that the checkpoint names for the plan's items.
    """
    say = lambda t, rule, key, detail: t.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), detail.cast("string").alias("detail"))
    known = checkpoint.join(plan.select("item_id", "position", "batch"), "item_id")
    repeated = checkpoint.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    by_place, by_plan = numbered(known.select("item_id", "place"), "place", "item_id", name="got"), numbered(known.select("item_id", "place", "position"), "position", "place", name="want")
    moved = by_place.join(by_plan, ["item_id", "place"]).where("got <> want")
    done = known.select("item_id", "batch").distinct().groupBy("batch").agg(F.count(F.lit(1)).alias("done"))
    part = plan.groupBy("batch").agg(F.count(F.lit(1)).alias("planned")).join(done, "batch").where("done < planned")
    found = [
        say(checkpoint.join(plan, "item_id", "left_anti"), "item_known", "item_id", F.lit("not in the plan")),
        say(repeated, "item_once", "item_id", F.col("n")),
        say(moved, "item_in_order", "item_id", F.concat_ws("/", "got", "want")),
        say(part, "batch_whole", "batch", F.concat_ws("/", "done", "planned")),
    ]
    if bound_to is not None:
        own = root(tree(numbered(plan.select("item_id", "batch", "position"), "position"), "place", "item_id", F.col("batch").cast("string")))
        odd = plan.sparkSession.range(1).where(F.lit(own != bound_to))
        found.append(say(odd.withColumn("k", F.lit("root")), "plan_bound", "k", F.lit(own)))
    return union(*found)
