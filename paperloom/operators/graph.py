"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.storage import discard, spool

#: Edges that one task settles at once (16 bytes each); both ways give the same components.
SMALL = 1 << 20


def with_least(table: DataFrame, key: str | list[str], least: DataFrame) -> DataFrame:
    """The join of edges with a spooled table of minima: neither side is an aggregate, so AQE may split the rows of a hub."""
    return table.join(least, key)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over spooled (hi, lo) edges with hi > lo.

    A hub's neighbours are never gathered: its smallest neighbour comes from a
    map-side combined minimum, which is a table of its own before the edges meet it.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = spool(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = with_least(both, "u", least).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    large = spool(large.where("hi <> lo").distinct(), "large")
    lower = spool(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    small = with_least(large, "hi", lower)
    small = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(small.select("hi", F.col("m").alias("lo")))
    out = spool(small.where("hi <> lo").distinct(), "stars")
    discard(least, large, lower)
    return out


def _settled(edges: DataFrame) -> DataFrame:
    """(node, component) of at most SMALL edges, in one task: labels are hooked to smaller ones and shortened until no edge joins two."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        ends = np.concatenate([np.concatenate(x) for x in zip(*parts, strict=True)])
        nodes, spot = np.unique(ends, return_inverse=True)
        a, b = spot[: len(ends) // 2], spot[len(ends) // 2 :]
        label = np.arange(len(nodes))
        while len(a):
            x, y = label[a], label[b]
            np.minimum.at(label, x, y)
            np.minimum.at(label, y, x)
            while (label[label] != label).any():
                label = label[label]
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "component"])

    return edges.repartition(1).mapInArrow(run, "node long, component long")


def connected_components(edges: DataFrame, most_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component is its smallest node.

    Nodes without edges don't appear.  Self-loops, repeated and reversed edges
    are harmless.  Rounds grow as the logarithm of the longest path, and each
    one is spooled, so the plan stays short and a lost executor costs one round.
    Once at most ``small`` edges are left, by count, one task settles them.
    """
    now = spool(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("hi"), F.least("a", "b").cast("long").alias("lo")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("h")).first()
        if seen["n"] <= small:
            return _settled(now)
        if (seen["n"], seen["h"]) == mark:
            break
        mark = (seen["n"], seen["h"])
        last, now = now, _stars(now)
        discard(last)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) for every row of ``nodes`` (id); a node without edges is a component of its own."""
    found = connected_components(edges)
    return spool(nodes.select("id").distinct().join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("component")), "components")
