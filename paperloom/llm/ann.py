"""Approximate nearest neighbours by collision counting.

Each of m random projections maps a block of vectors to a sorted array.  For a
query, every array has a window centred on the query's own projection; a vector
collides where it lies in the window, and one that collides in ``share`` of the
projections or more is verified on the original vectors.  Windows are widened by
virtual rehashing, that is by growing one factor on the same arrays.

How often two vectors collide depends on their distance alone, so the windows
tell when to stop: a query is done once a vector as far as the k-th best one
verified would have been found with ``confidence``.  Nearer ones are likelier
still.  No share of the vectors and no number of candidates is set: clustered
vectors stop after a few, vectors without any structure late.

Largest inner product becomes nearest distance by one more coordinate that gives
all vectors the same length.  For that, a block's vectors are banded by length
(a band's lengths differ by a factor of two at most); bands whose longest vector
cannot reach the k-th best score are left out.

Queries meet the vectors in blocks of ``block`` rows.  A block is one task's
index, built once; the queries stream past it.  Every block gives its best k, and
the best of those are taken by rank, k a task before the shuffle.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, spool

BLOCK, PROJECTIONS, SHARE, CONFIDENCE, GROWTH = 16384, 48, 0.75, 0.92, 1.2

#: Where there are fewer blocks than TASKS, each one's queries are dealt to several tasks, of at least TEAM queries.
TASKS, TEAM = 64, 256


def usable(v: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0)


def window_per_distance(projections: int, need: int, confidence: float) -> float:
    """Half a window's width, for distance 1, at which ``need`` of the projections collide with this probability."""
    enough = lambda p: sum(math.comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(need, projections + 1)) >= confidence
    lo, hi = 0.0, 1.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if enough(mid) else (mid, hi)
    return NormalDist().inv_cdf(min((1 + hi) / 2, 1 - 1e-12))


class Band:
    """Sorted projections of vectors of about one length; ``scaled`` has them as at most 1 long."""

    def __init__(self, scaled, k: int, projections: int, share: float, confidence: float, seed: int):
        import numpy as np

        n, size = scaled.shape
        lengths = np.sqrt((scaled**2).sum(1))
        self.unit = scaled / lengths.max()
        self.axes = np.random.default_rng(seed).standard_normal((size + 1, projections))
        spots = np.hstack([self.unit, np.sqrt(np.maximum(0.0, 1 - (lengths / lengths.max()) ** 2))[:, None]]) @ self.axes
        self.need = math.ceil(share * projections)
        self.per_distance = window_per_distance(projections, self.need, confidence)
        # The sorted arrays stand in one, each with room to the next, so that one binary search serves all.
        self.room = 4 * np.abs(spots).max() + 64 * projections
        self.base, self.first = np.arange(projections) * self.room, np.arange(projections) * n
        self.order = np.argsort(spots, axis=0, kind="stable").T.copy()
        self.flat = (np.sort(spots, axis=0).T + self.base[:, None]).ravel()
        # Where windows start: as wide as a few of the vectors would end with, taken as queries.
        few = self.unit[:: -(-n // 9)]
        near = np.sort(self.unit @ (few / np.sqrt((few * few).sum(1, keepdims=True))).T, axis=0)[-min(n, k + 1)]
        self.start = max(self.per_distance * float(np.median(self.distance(near))), 1e-6)

    @staticmethod
    def distance(cosine):
        import numpy as np

        return np.sqrt(np.maximum(0.0, 2 - 2 * cosine))

    def collisions(self, lo: list[int], hi: list[int]):
        """In how many windows each vector lies; what is outside is counted where that is less."""
        import numpy as np

        m, n = self.order.shape
        count = lambda parts: np.bincount(np.concatenate(parts), minlength=n)
        if 2 * (sum(hi) - sum(lo)) <= n * m:
            return count([self.order[j, x:y] for j, (x, y) in enumerate(zip(lo, hi, strict=True))])
        return m - count([part for j, (x, y) in enumerate(zip(lo, hi, strict=True)) for part in (self.order[j, :x], self.order[j, y:])])

    def candidates(self, query, k: int):
        """Places of the vectors verified for a query of length 1."""
        import numpy as np

        n, m = self.order.shape[1], len(self.base)
        at, wide = np.append(query, 0) @ self.axes + self.base, self.start
        while True:
            lo, hi = np.searchsorted(self.flat, at - wide) - self.first, np.searchsorted(self.flat, at + wide, "right") - self.first
            found = np.flatnonzero(self.collisions(lo.tolist(), hi.tolist()) >= self.need)
            if (lo <= 0).all() and (hi >= n).all():
                return np.arange(n)
            if len(found) <= k:
                wide *= GROWTH
                continue
            near = self.unit[found] @ query
            enough = self.per_distance * float(self.distance(np.partition(near, len(near) - k - 1)[len(near) - k - 1]))
            if wide >= enough:
                return found
            wide = enough


class Index:
    """One block of vectors of one size, in bands of length; longest first."""

    def __init__(self, rows, ids, vectors, k: int, projections: int = PROJECTIONS, share: float = SHARE, confidence: float = CONFIDENCE, seed: int = 7):
        import numpy as np

        self.rows, self.ids, self.vectors, self.k = rows, ids, vectors, k
        top = np.abs(vectors).max(1)
        length = np.log2(top) + np.log2(np.sqrt(((vectors / top[:, None]) ** 2).sum(1)))  # no square overflows or vanishes
        band = np.floor(length + 0.5)
        self.bands = []
        for b in sorted(set(band.tolist()), reverse=True):
            at = np.flatnonzero(band == b)
            scaled = (vectors[at] / top[at, None]) * np.exp2(np.log2(top[at]) - b - 1)[:, None]
            self.bands.append((at, float(length[at].max()), Band(scaled, k, projections, share, confidence, seed)))

    def search(self, row: int, query):
        """(ids, scores) of the best k for one query, without its own row."""
        import numpy as np

        k, top = self.k, np.abs(query).max()
        short = query / top
        size = np.sqrt((short * short).sum())
        best, scores = np.empty(0, np.int64), np.empty(0)
        for at, longest, band in self.bands:
            if len(best) == k and scores[-1] > 0 and math.log2(scores[-1]) > longest + math.log2(size) + math.log2(top) + 1e-9:
                break
            found = at[band.candidates(short / size, k)]
            found = found[self.rows[found] != row]
            with np.errstate(over="ignore", invalid="ignore"):
                best, scores = np.concatenate([best, found]), np.concatenate([scores, (self.vectors[found] * query).sum(1)])
            order = np.where(np.isnan(scores), -np.inf, scores)
            if len(best) > k:
                keep = order >= np.partition(order, len(order) - k)[len(order) - k]
                best, scores, order = best[keep], scores[keep], order[keep]
            first = np.lexsort((self.rows[best], self.ids[best], -order))[:k]
            best, scores = best[first], scores[first]
        return self.ids[best], scores


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", block: int = BLOCK, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for every query row, by inner product in double precision.

    ``is_query`` is a condition on the table's columns.  Vectors that are null,
    zero, or hold a null or non-finite component take no part, nor do rows
    without an id; vectors of other lengths than the query's are no candidates.
    A query's candidates are all rows but its own: rows that repeat an id are
    queries and candidates each for themselves, with ranks of their own.  Scores
    that overflow are infinite; one that is no number (infinities of both signs)
    ranks last.  An empty table or one without queries gives an empty result.
    """
    v = F.col(embedding)
    good = vectors.where(usable(v) & F.col(vec_id).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.size(v).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("q"))
    good = spool(good, "vectors")  # a table, so that queries and candidates see the same rows
    n, queries = good.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    blocks = max(1, -(-n // block))
    teams = max(1, min(TASKS // blocks, queries // TEAM))  # one, once there are blocks enough
    part = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    team = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(teams)).cast("int")
    columns = ("part", "dim", "asks", "row", "id", "v")
    mine = good.withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(teams - 1)))).withColumns({"part": part * teams + F.col("team"), "asks": F.lit(0)}).select(*columns)
    asked = good.where("q").withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "asks": F.lit(1)}).withColumn("part", F.col("block") * teams + team).select(*columns)
    # A block's vectors come first, then its queries, as a stream: a task holds one block and a batch of queries.
    dealt = mine.union(asked).repartition(blocks * teams, "part").sortWithinPartitions("part", "dim", "asks", "row")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        key, held, index = None, [], None
        names = ["query_row", "query_id", "vec_id", "score"]
        for b in batches:
            t = pa.Table.from_batches([b])
            marks = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("part", "dim", "asks")], 1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), len(marks)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                p, dim, asks = marks[lo].tolist()
                rows, ids = (t.column(c).to_numpy()[lo:hi] for c in ("row", "id"))
                flat = t.column("v").combine_chunks().slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, dim)
                if (p, dim) != key:
                    key, held, index = (p, dim), [], None
                if not asks:
                    held.append((rows, ids, flat))
                    continue
                if not held:
                    continue
                if index is None:
                    index = Index(*(np.concatenate(x) for x in zip(*held, strict=True)), k, confidence=confidence)
                    held = [None]
                found = [(r, i, *index.search(r, q)) for r, i, q in zip(rows.tolist(), ids.tolist(), flat, strict=True)]
                size = [len(f[2]) for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat([f[0] for f in found], size).astype(np.int64)), pa.array(np.repeat([f[1] for f in found], size).astype(np.int64)), pa.array(np.concatenate([f[2] for f in found]).astype(np.int64)), pa.array(np.concatenate([f[3] for f in found]))], names)

    with small_batches(vectors.sparkSession):
        found = spool(dealt.mapInArrow(run, "query_row long, query_id long, vec_id long, score double"), "found")
    order = Window.partitionBy("query_row", "query_id").orderBy((-F.col("score")).asc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
