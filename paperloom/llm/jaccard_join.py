"""Exact Jaccard join of word shingle sets by universe partition and pigeonhole.

Two sets link when their Jaccard similarity reaches percent / 100.  Then sizes a
and b bound their symmetric difference by H = floor((100 - percent) (a + b) /
(100 + percent)).  Sizes fall into bands; a band's scheme hashes the universe of
shingles into segments, and a set's segments are indexed by their content:

* plain segments: with budget 1, a difference of H leaves at least one of H + 1
  segments alike.  The scheme has some segments more, so that every set may
  leave its smallest ones out (v = 0: a near-empty segment is alike in
  unrelated sets): with e segments more, e + 1 are alike, and the largest
  H + 1 of each set, in an order both sets agree on, share one;
* doubled segments, with budget 2 and twice the share of the universe: alike,
  or one shingle apart, which the set's one-deletion neighbourhood finds.

``allocate`` chooses how many segments are doubled: it weighs the index entries
against the chance matches that the number of documents makes likely, each by
what it costs: an entry is written, dealt and sorted, a chance match is a look at
two sketches.

Sets that are equal are one class from the start.  The documents of an index
entry are linked to its smallest one, not to each other, so a group of n near
copies costs n verifications.  Where a verified star leaves an entry in several
components, other stars follow, around documents drawn by a hash, and in the end
pairs between the components that are left; no link is lost.  An entry with many
documents outside its largest component is not compared pair by pair: its
documents are indexed once more, with segments cut by another hash, and meet
only where they share an entry of that index, too, which every link does.

Every set has a parity sketch, one bit for each shingle or so, whose bits that
differ are a lower bound of the symmetric difference.  Pairs are held against it
first; only those within H bring their sets together.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.graph import connected_components

from .common import discard, fresh, small_batches, spool
from .hashing import WordHasher

SHINGLE, PERCENT = 4, 85
BAND, SLACK, CHANCE = 4, 0.15, 0.05
#: What a chance match costs, in index entries: it is a look at two sketches that are in memory.
LOOK = 0.01
#: Documents of an index entry that one task compares with as many others; how often an entry with more outside its largest component is indexed anew.
CELL, DEPTH = 1024, 2
#: Open entries with more documents than BUSY get up to STARS further stars before pairs are looked at.
STARS, BUSY = 4, 32


def most_apart(a: int, b: int, percent: int) -> int:
    """The greatest symmetric difference of linked sets of sizes a and b."""
    return (100 - percent) * (a + b) // (100 + percent)


def band_ends(percent: int, upto: int = 1 << 40) -> list[int]:
    """Largest size of each band; a band spans BAND times the ratio of sizes that can link."""
    ends, ratio = [0], (100 / percent) ** BAND
    while ends[-1] < upto:
        ends.append(max(ends[-1] + 1, math.floor((ends[-1] + 1) * ratio)))
    return ends


def allocate(largest: int, percent: int, docs: float) -> tuple[int, int, int]:
    """(doubled segments, plain segments, most apart) for sets of up to ``largest`` shingles, the cheapest for so many documents."""
    apart = most_apart(largest, largest, percent)
    slack = math.ceil(SLACK * (apart + 1))
    best = None
    for doubled in sorted({0, (apart + 1) // 4, (apart + 1) // 2}):
        plain = apart + 1 - 2 * doubled
        unit = largest / (apart + 1 + (slack if plain else 0))
        entries = plain + doubled * (2 + 2 * unit)
        chance = docs * (plain * CHANCE**unit + doubled * (1 + 4 * unit) * CHANCE ** max(0.0, 2 * unit - 1))
        cost = entries + LOOK * chance
        if best is None or cost < best[0]:
            best = (cost, doubled, plain + (slack if plain else 0))
    return best[1], best[2], apart


class Index:
    """Index entries of shingle sets; one per worker."""

    def __init__(self, shingle: int, percent: int, docs: float, doubled: int | None = None, cut: int = 0):
        self.hasher, self.k, self.percent, self.docs, self.force = WordHasher(), shingle, percent, docs, doubled
        self.salt = self.hasher.np.uint64(cut * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)  # another universe partition for every cut
        self.ends, self.schemes = band_ends(percent), {}

    def shingles(self, text: str | None):
        """Sorted distinct shingle hashes: A-Z lower-cased, words parted by blanks and control whitespace."""
        np = self.hasher.np
        return np.unique(self.hasher.shingles(self.hasher.words(text.encode().lower().split() if text else []), self.k))

    def scheme(self, band: int) -> tuple[int, int, int]:
        if band not in self.schemes:
            got = allocate(self.ends[band], self.percent, self.docs)
            if self.force is not None:  # tests: a share of the budget in percent
                apart = got[2]
                doubled = (apart + 1) * self.force // 200
                plain = apart + 1 - 2 * doubled
                got = (doubled, plain + (math.ceil(SLACK * (apart + 1)) if plain else 0), apart)
            self.schemes[band] = got
        return self.schemes[band]

    def entries(self, x):
        """The 64-bit index entries of a set."""
        np, h = self.hasher.np, self.hasher
        n = len(x)
        if n == 0:
            return np.empty(0, np.uint64)
        import bisect

        band = bisect.bisect_left(self.ends, n)
        out = []
        # As the larger set of a pair in its own band; as the smaller one in the next band too, if it can link with sizes there.
        bands = [band, band + 1] if 100 * n >= self.percent * (self.ends[band] + 1) else [band]
        for b in bands:
            doubled, plain, apart = self.scheme(b)
            mine = min(apart, (100 - self.percent) * n // self.percent)  # the most that any partner leaves apart
            if mine == 0:  # equal sets only, which are one class already
                continue
            units = 2 * doubled + plain
            spot = (h.mix(x ^ np.uint64(b * 2 + 1) ^ self.salt) >> np.uint64(11)).astype(np.float64) * (units / (1 << 53))
            spot = np.minimum(spot.astype(np.int64), units - 1)
            seg = np.where(spot < 2 * doubled, spot // 2, spot - doubled)
            value = h.mix(x + np.uint64(b))
            sums = np.zeros(doubled + plain, np.uint64)
            np.add.at(sums, seg, value)
            sizes = np.bincount(seg, minlength=doubled + plain)
            tag = h.mix(np.arange(doubled + plain, dtype=np.uint64) + np.uint64((b + 1) << 32))
            token = lambda s, size, t: h.mix(h.mix(s + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + t)
            whole = token(sums, sizes, tag)
            need = max(0, mine + 1 - 2 * doubled)
            if plain and need:
                p = np.arange(doubled, doubled + plain)
                out.append(whole[p[np.lexsort((whole[p], -sizes[p]))[:need]]])
            if doubled:
                out.append(whole[:doubled])
                inside = seg < doubled
                s = seg[inside]
                out.append(token(sums[s] - value[inside], sizes[s] - 1, tag[s]))
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def sketch(x, hasher: WordHasher) -> bytes:
    """Parity of the shingles in each of so many slots as there are shingles, rounded up to a power of two (64 at least)."""
    np = hasher.np
    slots = 1 << max(6, (max(1, len(x)) - 1).bit_length())
    odd = np.bincount((hasher.mix(x ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(raw: bytes, size: int):
    """A sketch with ``size`` bytes at most, as 64-bit words: halves are added bit by bit, which is the sketch with half the slots."""
    import numpy as np

    x = np.frombuffer(raw, np.uint64)
    while 8 * len(x) > size:
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return x


def repeated_ids(docs: DataFrame, doc_id: str) -> DataFrame | None:
    """doc_id and rows of the ids that several rows have; None if there are none."""
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id is not null")
    twice = spool(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "twice")
    return twice if twice.limit(1).count() else None


def texts_by_id(docs: DataFrame, twice: DataFrame | None, doc_id: str, text: str) -> DataFrame:
    """doc_id and texts: one row an id, and one for each row without an id."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.array(text).alias("texts"))
    if twice is None:
        return narrow
    many = narrow.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.flatten(F.collect_set("texts")).alias("texts"))
    return spool(narrow.join(twice, "doc_id", "left_anti").union(many), "by-id")


def union_of(texts: list[str | None], ix: Index):
    """The set of a document: the shingles of all its texts."""
    import numpy as np

    sets = [ix.shingles(t) for t in texts]
    return sets[0] if len(sets) == 1 else np.unique(np.concatenate(sets)) if sets else ix.shingles(None)


def index_table(narrow: DataFrame, shingle: int, percent: int, count: float, doubled: int | None = None) -> DataFrame:
    """doc_id, n (set size), fp1 and fp2 (128 bits of the set), sketch, entries, for every row of (doc_id, texts)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ix = Index(shingle, percent, count, doubled)
        for b in batches:
            n, one, two, bits, entries = [], [], [], [], []
            for t in b.column(1):
                x = union_of(t.as_py(), ix)
                n.append(len(x))
                one.append(int(ix.hasher.mix(x).sum(dtype=np.uint64).view(np.int64)))
                two.append(int(ix.hasher.mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                bits.append(sketch(x, ix.hasher))
                entries.append(ix.entries(x).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bits, pa.binary()), pa.array(entries, pa.list_(pa.int64()))], ["doc_id", "n", "fp1", "fp2", "sketch", "entries"])

    return narrow.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, sketch binary, entries array<long>")


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link; ``sets`` has (doc_id, n, sketch), one row an id."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("b"), "b").where("n_b > 0").join(side("a"), "a")
    both = both.where(percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))

    def check(batches):
        import numpy as np
        import pyarrow as pa

        for r in batches:
            keep = []
            for m, n, x, y in zip(*(r.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")), strict=True):
                size = min(len(x), len(y))
                keep.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= most_apart(m, n, percent))
            yield pa.RecordBatch.from_arrays([r.column("a"), r.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(check, "a long, b long")


def standing(members: DataFrame) -> DataFrame:
    """entry, most (its largest component, of equal ones the smallest), inside and outside (documents in it, and not), for members (entry, doc_id, c)."""
    parts = members.groupBy("entry", "c").agg(F.count(F.lit(1)).alias("k"))
    top = F.max(F.struct("k", (-F.col("c")).alias("c")))
    return parts.groupBy("entry").agg(top.alias("top"), F.sum("k").alias("docs")).select("entry", (-F.col("top.c")).alias("most"), F.col("top.k").alias("inside"), (F.col("docs") - F.col("top.k")).alias("outside"))


def likely_within(members: DataFrame, sets: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """Pairs (a, b) of documents of one entry, but of two components, whose sizes and sketches allow a link.

    ``members`` has (entry, doc_id, c), ``sets`` (doc_id, n, sketch), one row an id.
    Pairs that fail aren't made.  Documents outside the entry's largest component
    meet those inside and each other, in cells of at most ``cell`` documents by
    as many; those inside don't meet each other.
    """
    parts = lambda c: F.ceil(F.col(c) / cell).cast("int")
    shape = spool(standing(members).select("entry", "most", parts("inside").alias("p"), parts("outside").alias("q")), "shape")
    dealt = members.join(shape, "entry").withColumn("far", F.col("c") == F.col("most"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.when(F.col("far"), F.col("p")).otherwise(F.col("q"))).cast("int"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    spot = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    inside = F.transform(upto("q"), lambda j: spot(F.col("mine"), j))
    outside = F.concat(F.transform(upto("p"), lambda i: spot(i, F.col("mine"))), F.transform(upto("q"), lambda j: spot(F.col("p") + F.least(j, F.col("mine")), F.greatest(j, F.col("mine")))))
    dealt = dealt.where("q > 0").withColumn("at", F.explode(F.when(F.col("far"), inside).otherwise(outside)))
    dealt = dealt.select("entry", "at.i", "at.j", "far", "mine", "doc_id", "c").join(sets, "doc_id")  # sketches come last, as they are most of a row
    # Where nothing deals the rows anew after the join by entry, they are dealt by entry, which serves the grouping, too, but brings all cells of an entry into one task.
    dealt = dealt.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "entry", "i", "j")

    def run(key, t):
        import numpy as np
        import pyarrow as pa

        ids, n, c, mine = (t.column(k).to_numpy() for k in ("doc_id", "n", "c", "mine"))
        far = t.column("far").to_numpy(zero_copy_only=False)
        raw = t.column("sketch").to_pylist()
        size = min(map(len, raw))
        bits = np.stack([folded(x, size) for x in raw])
        one_group = not far.any() and (mine == mine[0]).all()
        first, second = [], []
        for k in np.flatnonzero(~far):
            ok = (c != c[k]) & (percent * np.maximum(n, n[k]) <= 100 * np.minimum(n, n[k]))
            ok &= far if far.any() else (ids > ids[k]) if one_group else (mine > mine[k])
            at = np.flatnonzero(ok)
            if len(at):
                apart = np.bitwise_count(bits[at] ^ bits[k]).sum(1, dtype=np.int64)
                at = at[apart <= (100 - percent) * (n[at] + n[k]) // (100 + percent)]
                first.append(np.minimum(ids[at], ids[k]))
                second.append(np.maximum(ids[at], ids[k]))
        none = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([none, *first]), "b": np.concatenate([none, *second])})

    return dealt.groupBy("entry", "i", "j").applyInArrow(run, "a long, b long")


def open_members(members: DataFrame, joined: DataFrame) -> DataFrame:
    """entry, doc_id and component c of the members of entries in several components."""
    labelled = spool(members.join(joined, members["doc_id"] == joined["node"], "left").select("entry", "doc_id", F.coalesce("component", "doc_id").alias("c")), "labelled")
    entries = spool(labelled.groupBy("entry").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("entry"), "open-entries")
    out = spool(labelled.join(entries, "entry"), "open")
    discard(labelled)
    return out


def star_pairs(members: DataFrame, turn: int, busy: int = BUSY) -> DataFrame | None:
    """Pairs (a, b) around one member of each entry of more than ``busy``, drawn by a hash that is the same in all entries; None if there is no such entry."""
    drawn = F.min_by(F.struct("doc_id", "c"), F.xxhash64("doc_id", F.lit(turn)))
    centres = spool(members.groupBy("entry").agg(F.count(F.lit(1)).alias("docs"), drawn.alias("m")).where(F.col("docs") > busy).select("entry", F.col("m.doc_id").alias("m"), F.col("m.c").alias("mc")), "centres")
    if not centres.limit(1).count():
        return None
    pairs = members.join(centres, "entry").where("c <> mc")
    return pairs.select(F.least("doc_id", "m").alias("a"), F.greatest("doc_id", "m").alias("b")).distinct()


def cut_finer(members: DataFrame, narrow: DataFrame, shingle: int, percent: int, docs: float, doubled: int | None, cut: int, cell: int = CELL) -> DataFrame:
    """``members`` (entry, doc_id, c) with entries of more than ``cell`` documents outside their largest component replaced by those of another universe partition.

    A link in an entry shares a segment of the other partition, too, so it stays
    in one of the finer entries.  Segments and finer entries of one component
    hold no link that is new, and go; segments before they meet the entries, as
    most are in one document alone, and each document has many of both.
    """
    crowded = spool(standing(members).where(F.col("outside") > cell).select("entry"), "crowded")
    if not crowded.limit(1).count():
        return members
    many = spool(members.join(crowded, "entry"), "many")
    wanted = spool(many.select("doc_id", "c").distinct(), "wanted")
    texts = narrow.join(wanted, "doc_id", "left_semi")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ix = Index(shingle, percent, docs, doubled, cut)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([ix.entries(union_of(t.as_py(), ix)).view(np.int64) for t in b.column(1)], pa.list_(pa.int64()))], ["doc_id", "more"])

    again = spool(texts.mapInArrow(run, "doc_id long, more array<long>"), "finer")
    each = again.join(wanted, "doc_id").select("doc_id", "c", F.explode("more").alias("m"))
    met = spool(each.groupBy("m").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("m"), "finer-met")
    each = spool(each.join(met, "m").select("doc_id", "m"), "finer-each")
    discard(again)
    finer = spool(many.join(each, "doc_id").select(F.xxhash64("entry", "m").alias("entry"), "doc_id", "c"), "finer-members")
    open_ = spool(finer.groupBy("entry").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("entry"), "finer-open")
    out = spool(members.join(crowded, "entry", "left_anti").union(finer.join(open_, "entry").select("entry", "doc_id", "c")), "open")
    discard(many, wanted, met, each, finer)
    return out


def verified(pairs: DataFrame, narrow: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by the exact sizes of intersection and union.

    Sets are made anew for the documents in pairs only, and meet in two joins;
    a document in many pairs is dealt to several tasks by AQE.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = narrow.join(wanted, "doc_id", "left_semi")

    def sets(batches):
        import pyarrow as pa

        ix = Index(shingle, percent, 1.0)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([union_of(t.as_py(), ix).tobytes() for t in b.column(1)], pa.binary())], ["doc_id", "set"])

    made = spool(texts.mapInArrow(sets, "doc_id long, set binary"), "sets")
    both = pairs.join(made.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b").join(made.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a")

    def check(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True)) if percent * max(len(x), len(y)) <= 100 * min(len(x), len(y)) else 0
                keep.append(same > 0 and 100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", doubled: int | None = None, cell: int = CELL, depth: int = DEPTH, turns: int = STARS, busy: int = BUSY) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) for every row of ``docs``.

    Texts that are null or have no word have no set and link with nothing, not
    even each other.  Rows that repeat an id give a row each; the id's set
    has the shingles of all its texts.  Rows without an id have component null.  Extra columns
    don't matter; an empty table gives an empty result.
    """
    twice = repeated_ids(docs, doc_id)
    narrow = texts_by_id(docs, twice, doc_id, text)
    count = float(narrow.count())
    with small_batches(docs.sparkSession):
        table = spool(index_table(narrow, shingle, percent, count, doubled), "index")
        keyed = table.where("n > 0 and doc_id is not null")
        # Equal sets: each class is stood for by its smallest id.
        groups = spool(keyed.groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last").drop("last"), "groups")
        copies = spool(keyed.join(groups, ["n", "fp1", "fp2"]).where("doc_id <> rep").select("doc_id", "rep"), "copies")
        own = keyed.join(copies.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.explode("entries").alias("entry"))

        shared = spool(own.groupBy("entry").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count(F.lit(1)).alias("docs")).where("a < z"), "shared")
        two = shared.where("docs = 2").select("a", F.col("z").alias("b"))
        many = shared.where("docs > 2")
        members = spool(own.join(many.select("entry", "a"), "entry").select("entry", "doc_id", "a"), "members")
        sets = spool(keyed.select("doc_id", "n", "sketch"), "sketches")
        sizes = spool(table.select("doc_id", "n"), "sizes")
        discard(table)  # the largest of the tables
        stars = spool(likely(two.union(members.where("a < doc_id").select("a", F.col("doc_id").alias("b"))).distinct(), sets, percent), "stars")
        links = spool(verified(stars, narrow, shingle, percent), "links")
        joined = spool(connected_components(links), "joined")

        # Entries that the star left in several components: more stars, then pairs between the components.
        rest = open_members(members.select("entry", "doc_id"), joined)
        discard(shared, members)
        for turn in range(1, turns + 1):
            pairs = star_pairs(rest, turn, busy)
            if pairs is None:
                break
            tried = spool(likely(pairs.join(stars, ["a", "b"], "left_anti"), sets, percent), "stars")
            links = spool(links.union(verified(tried, narrow, shingle, percent)), "links")
            stars = stars.union(tried)
            joined = spool(connected_components(links), "joined")
            rest = open_members(rest.select("entry", "doc_id"), joined)
        if rest.limit(1).count():
            for cut in range(1, depth + 1):
                rest = cut_finer(rest, narrow, shingle, percent, count, doubled, cut, cell)
            more = spool(likely_within(rest, sets, percent, cell).distinct().join(stars, ["a", "b"], "left_anti"), "more")
            if more.limit(1).count():
                again = spool(verified(more, narrow, shingle, percent), "again")
                joined = spool(connected_components(links.union(again)), "joined")

    reps = copies.join(joined, copies["rep"] == joined["node"], "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    labels = joined.join(copies.select("doc_id"), joined["node"] == copies["doc_id"], "left_anti").select(F.col("node").alias("doc_id"), "component")
    found = spool(reps.union(labels).groupBy("doc_id").agg(F.min("component").alias("component")), "found")
    if twice is not None:
        sizes = sizes.join(twice, "doc_id", "left").withColumn("row", F.explode(F.sequence(F.lit(1), F.coalesce("rows", F.lit(1)))))
    return sizes.join(found, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, with all their columns; of rows that repeat an id, that with the text that sorts first; rows without an id stay."""
    found, nth = fresh(docs, "found"), fresh(docs, "nth")
    gone = classes(docs, shingle, percent, doc_id, text).where("component_id <> doc_id").select(F.col("doc_id").alias(found)).distinct()
    kept = docs.join(spool(gone, "gone"), F.col(doc_id).cast("long") == F.col(found), "left_anti")
    twice = repeated_ids(kept, doc_id)
    if twice is None:
        return kept
    twice = twice.select(F.col("doc_id").alias(found))
    same = F.col(doc_id).cast("long") == F.col(found)
    many = kept.join(twice, same).withColumn(nth, F.row_number().over(Window.partitionBy(found).orderBy(F.col(text).asc_nulls_last(), F.xxhash64(*kept.columns))))
    return kept.join(twice, same, "left_anti").union(many.where(F.col(nth) == 1).select(*kept.columns))
