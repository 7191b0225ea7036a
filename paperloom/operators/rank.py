"""Ranking, caps and selections.

Independent caps are window ranks.  Where a cap depends on what was taken
before, the ranked rows have first been cut to a number the policy bounds, and a
fold over that short list decides.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.normalize import host_of
from paperloom.schema import TRIAGE, filled, fresh, rank_of
from paperloom.storage import spool


@dataclass(frozen=True)
class Policy:
    """Caps of the featured selection."""

    target: int = 5
    hard_max: int = 8
    per_category: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    pool: int | None = None
    target_total: int | None = None
    hard_max_total: int | None = None
    excluded: tuple[str, ...] = ("BACKFILL_INDEXING", "CORRECTION_NOTICE")

    def __post_init__(self):
        limits = [(self.target, self.hard_max), *self.per_category.values()]
        if any(not 0 <= a <= b for a, b in limits) or (self.pool is not None and self.pool < 1):
            raise ValueError("a target is between 0 and its hard maximum, a pool at least 1")
        if None not in (self.target_total, self.hard_max_total) and self.target_total > self.hard_max_total:
            raise ValueError("the target in all is beyond the hard maximum in all")

    def limit(self, which: int) -> Column:
        out = F.lit((self.target, self.hard_max)[which])
        for name, pair in self.per_category.items():
            out = F.when(F.col("category") == name, pair[which]).otherwise(out)
        return out


def rank_key() -> list[Column]:
    """Triage, then score, then id."""
    return [rank_of(F.col("triage_status"), TRIAGE, 3), -F.coalesce("routing_score", F.lit(0)), F.col("work_id")]


def featured(records: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The records that are featured (W1): a category's best up to its caps, filled to the total, trimmed to the hard total.

    Rows have work_id, category, routing_score, triage_status, event_status and event_class.
    """
    cls = F.coalesce("event_class", F.lit("OTHER"))
    pool = records.where((F.col("event_status") != "NO_QUALIFYING_EVENT") & ~cls.isin(*policy.excluded) & (F.coalesce("work_id", F.lit("")) != ""))
    by_category = Window.partitionBy("category").orderBy(*rank_key())
    pool = pool.withColumn("_rank", F.row_number().over(by_category))
    if policy.pool is not None:
        pool = pool.where(F.col("_rank") <= policy.pool)
    preferred = F.col("triage_status").isin("PRIORITY", "REVIEW_REQUIRED")
    # The rank puts preferred rows first, so a category's choice is a prefix of it.
    n_preferred = F.count(F.when(preferred, 1)).over(Window.partitionBy("category"))
    size = F.least(F.greatest(F.least(n_preferred, policy.limit(1)), policy.limit(0)), policy.limit(1))
    pool = pool.withColumn("_chosen", F.col("_rank") <= size).withColumn("_anchor", F.col("_rank") <= F.least(policy.limit(0), size))
    # What a category can still take is a prefix, too: at most hard_max rows of each go on.
    pool = pool.where(F.col("_rank") <= policy.limit(1))
    if policy.target_total is None and policy.hard_max_total is None:
        return pool.where("_chosen").drop("_rank", "_chosen", "_anchor")
    everything = Window.orderBy(F.desc("_chosen"), *rank_key())
    pool = pool.withColumn("_place", F.row_number().over(everything)).withColumn("_n", F.count(F.when(F.col("_chosen"), 1)).over(Window.partitionBy(F.lit(1))))
    if policy.target_total is not None:
        pool = pool.withColumn("_chosen", F.col("_chosen") | (F.col("_place") <= policy.target_total))
    pool = pool.where("_chosen")
    if policy.hard_max_total is not None:
        trimmed = Window.orderBy(F.desc("_anchor"), *rank_key())
        pool = pool.withColumn("_last", F.row_number().over(trimmed)).where(F.col("_last") <= policy.hard_max_total).drop("_last")
    return pool.drop("_rank", "_chosen", "_anchor", "_place", "_n")


def display_order(candidates: DataFrame, categories: list[str], required: DataFrame | None = None) -> DataFrame:
    """All candidates with display_rank in their category (W4): required first, notices last, review before priority, score, id."""
    rows = candidates
    if required is None:
        rows = rows.withColumn("_must", F.lit(1))
    else:
        rows = rows.join(required.select("work_id", F.lit(0).alias("_must")).distinct(), "work_id", "left").fillna({"_must": 1})
    notice = F.when(F.col("event_class") == "BACKFILL_INDEXING", 1).when(F.col("event_class") == "CORRECTION_NOTICE", 2).otherwise(0)
    rows = rows.withColumn("category_rank", rank_of(F.col("category"), tuple(categories), len(categories)))
    order = Window.partitionBy("category").orderBy("_must", notice, rank_of(F.col("triage_status"), ("REVIEW_REQUIRED", "PRIORITY", "LOWER_PRIORITY"), 3), F.desc("score"), "work_id")
    return rows.withColumn("display_rank", F.row_number().over(order)).drop("_must")


def probe_plan(candidates: DataFrame, most: int = 15, per_host: int = 2, url: str = "publisher_url", order: str = "rank") -> DataFrame:
    """The candidates to probe (W7): in order, so many of a host and so many in all.  Adds attempt, from 1."""
    host = Window.partitionBy("_host").orderBy(order)
    rows = candidates.where(F.col(url) != "").withColumn("_host", host_of(F.col(url))).withColumn("_n", F.row_number().over(host)).where(F.col("_n") <= per_host)
    # orderBy and limit are a bounded top-k; only ``most`` rows get a global number.
    first = rows.orderBy(order).limit(most)
    return first.withColumn("attempt", F.row_number().over(Window.orderBy(order))).drop("_host", "_n")


#: Answers after which a host gets no further request; resolvers, which have no budget of their own.
BLOCKS, RESOLVERS = (401, 403, 429), ("doi.org", "dx.doi.org")


def probe(candidates: DataFrame, fetch: Callable[[str], int], most: int = 15, per_host: int = 2, stop: tuple[int, ...] = BLOCKS, url: str = "publisher_url", order: str = "rank") -> DataFrame:
    """Probes in order with feedback (W7): so many of a host, none after it blocked, so many in all.  Adds attempt (from 1), status, http_status.

    What is asked is what a loop over the candidates would ask, in rounds: a
    candidate's turn has come if all before it of its host are answered, and if it is
    within the budget even should every open candidate before it be asked.  A round
    asks all whose turn has come, side by side, and writes the answers down before
    the next; the first open candidate is always among them or beyond the budget.
    Places are counted in ranges of the order, so no task sees all candidates.  Only the
    ranges' sums, a few numbers for each task, are added up in one place.  A
    candidate without url is passed over; equal places go by a hash of the row.
    """
    cols = candidates.columns
    host, tie, k, block, at = (fresh(candidates, c) for c in ("_host", "_tie", "_k", "_block", "_at"))
    rows = candidates.where(filled(F.col(url))).withColumn(host, host_of(F.col(url))).withColumn(tie, F.xxhash64(F.to_json(F.struct(*cols))))
    own = F.row_number().over(Window.partitionBy(host).orderBy(order, tie))
    rows = rows.withColumn(k, own).where(F.col(k) <= max(most, per_host)).where(F.col(k) <= F.when(F.col(host).isin(*RESOLVERS), most).otherwise(per_host))
    rows = spool(rows.repartitionByRange(order, tie).withColumn(block, F.spark_partition_id()), "probes")
    open_ = spool(rows.withColumn(at, F.row_number().over(Window.partitionBy(block).orderBy(order, tie, k))), "open")
    kinds = dict(open_.dtypes)
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in open_.columns) + ", status string, http_status int"

    def ask(frames):
        for f in frames:
            codes = [fetch(u) for u in f[url]]
            yield f.assign(status=["SUCCESS" if 200 <= c < 400 else "FAILED" for c in codes], http_status=codes)

    def placed(asked: DataFrame | None, waiting: DataFrame) -> DataFrame:
        """Both in one order, with how many of each are up to and with a row."""
        both = waiting.select(block, at, F.lit(0).alias("a"), F.lit(1).alias("w"))
        both = both if asked is None else both.unionAll(asked.select(block, at, F.lit(1), F.lit(0)))
        sums = both.groupBy(block).agg(F.sum("a").alias("a"), F.sum("w").alias("w"))
        before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
        base = sums.select(block, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("a", "w")))
        upto = Window.partitionBy(block).orderBy(at)
        return both.select(block, at, "w", F.sum("a").over(upto).alias("a1"), F.sum("w").over(upto).alias("w1")).join(base, block).where("w = 1").select(block, at, (F.col("a1") + F.col("a0")).alias("asked"), (F.col("a1") + F.col("a0") + F.col("w1") + F.col("w0")).alias("upto"))

    asked = None
    while open_.limit(1).count():
        seen = open_.join(placed(asked, open_), [block, at]).where(F.col("asked") < most)
        first = F.row_number().over(Window.partitionBy(host).orderBy(k)) == 1
        seen = spool(seen.withColumn("turn", (F.col("upto") <= most) & first), "turns")
        got = spool(seen.where("turn").select(*open_.columns).mapInPandas(ask, shape), "answers")
        asked = got if asked is None else asked.unionAll(got)
        shut = got.where(F.col("http_status").isin(*stop)).select(host).distinct()
        open_ = spool(seen.where("NOT turn").select(*open_.columns).join(shut, host, "left_anti").select(*open_.columns), "open")
    if asked is None:
        asked = open_.select("*", F.lit(None).cast("string").alias("status"), F.lit(None).cast("int").alias("http_status"))
    base = asked.groupBy(block).agg(F.count(F.lit(1)).alias("n")).select(block, F.coalesce(F.sum("n").over(Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n"))
    number = F.row_number().over(Window.partitionBy(block).orderBy(at))
    return asked.withColumn("attempt", number).join(base, block).select(*cols, (F.col("attempt") + F.col("n")).cast("int").alias("attempt"), "status", "http_status")


def newest_first(records: DataFrame, most: int) -> DataFrame:
    """A feed's records, newest first, each DOI or url once, so many at most."""
    key = F.coalesce(F.nullif(F.lower("doi"), F.lit("")), F.col("landing_url"))
    order = [F.desc_nulls_last("publication_date"), F.lower("doi"), F.lower("title"), F.col("landing_url")]
    once = records.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
    return once.orderBy(*order).limit(most)


# --- the older selections; rows have the four scores, total_score, publication_date, paper_id

BEST = (F.desc, "total_score", "publication_date")


def best() -> list[Column]:
    return [F.desc("total_score"), F.desc("publication_date"), F.col("paper_id")]


def stream_pool(papers: DataFrame, least: float = 45, most: int = 30, per_stream: Mapping[str, int] | None = None, gates: bool = True) -> DataFrame:
    """The best papers under a cap per stream and one in all (W16; without gates W17)."""
    rows = papers.where(F.col("total_score") >= least)
    if gates:
        minimum = F.when(F.col("stream") == "llm_social", 65).otherwise(62)
        weak = F.col("evidence_tier").isin("Other/U", "Preclinical/U") & (F.col("interest_score") < 70)
        rows = rows.where(F.col("exclusion_reason").isNull() & (F.col("relevance_score") >= minimum) & ~weak)
    cap = F.lit(most)
    for name, n in (per_stream or {}).items():
        cap = F.when(F.col("stream") == name, n).otherwise(cap)
    n = F.row_number().over(Window.partitionBy("stream").orderBy(*best()))
    return rows.withColumn("_n", n).where(F.col("_n") <= cap).drop("_n").orderBy(*best()).limit(most)


def section(rules: Mapping[str, int] | None = None, strict: bool = True) -> Column:
    """anchor, strong_watch, weird_but_important or null (W19; not strict: the base rule)."""
    r = {"anchor_min_evidence": 75, "strong_min_evidence": 55, "strong_min_relevance": 60, "weird_min_interest": 85} | dict(rules or {})
    anchor = F.col("evidence_score") >= r["anchor_min_evidence"]
    strong = (F.col("evidence_score") >= r["strong_min_evidence"]) & (F.col("relevance_score") >= r["strong_min_relevance"])
    weird = F.col("interest_score") >= r["weird_min_interest"]
    if strict:
        anchor = anchor & F.col("study_design").isin("Meta-analysis", "Systematic review", "Guideline", "Randomized controlled trial", "Field experiment", "Longitudinal study") & (F.col("relevance_score") >= 65)
        strong = strong & ~F.col("study_design").isin("Scoping review", "Narrative review", "Preclinical synthesis")
        weird = weird & (F.col("relevance_score") >= 65)
    out = F.when(anchor, "anchor").when(strong, "strong_watch").when(weird, "weird_but_important")
    return F.when(F.col("exclusion_reason").isNull(), out) if strict else out


# Least relevance of each category.
CATEGORIES = {"clinical_medicine": 58, "sport_science": 62, "sport_nutrition_fitness": 62, "llm_research": 65, "human_ai": 65}


def eligible_by_category(papers: DataFrame, least: float = 45) -> DataFrame:
    """Papers that may compete in their category."""
    minimum = F.lit(None).cast("int")
    for name, n in CATEGORIES.items():
        minimum = F.when(F.col("category") == name, n).otherwise(minimum)
    weak = F.col("evidence_tier").isin("Other/U", "Preclinical/U") & (F.col("interest_score") < 70)
    return papers.where(F.col("exclusion_reason").isNull() & (F.col("relevance_score") >= minimum) & (F.col("total_score") >= least) & ~weak)


def diverse(papers: DataFrame, most: int, per_direction: int, by: str = "category", direction: str = "direction") -> DataFrame:
    """One place for the best of each direction, the rest by score under a cap per direction (W15).  Adds place.

    Rows without a direction have no cap of their own.
    """
    has = F.col(direction).isNotNull()
    n = F.row_number().over(Window.partitionBy(by, direction).orderBy(*best()))
    rows = papers.withColumn("_n", F.when(has, n))
    lead = F.col("_n") == 1
    ok = ~has | (F.col("_n") <= F.greatest(F.lit(per_direction), F.lit(1)))
    # Leaders come by score alone; equal scores in the order their best papers have.
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.when(lead, 0).otherwise(1), *best()))
    return rows.where(ok).withColumn("place", place).where(F.col("place") <= most).drop("_n")


def category_pool(papers: DataFrame, most: int = 30, per_direction: int = 6) -> DataFrame:
    """Each category's pool (W13): research directions in diverse order, the other categories by score."""
    ai = papers["category"].isin("llm_research", "human_ai")
    other = papers.where(~ai).withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(*best()))).where(F.col("place") <= most)
    return diverse(papers.where(ai), most, per_direction).unionByName(other)


def capped_in_order(rows: DataFrame, by: str, caps: Mapping[str, Mapping[str, int]], most: int, order: str = "place") -> DataFrame:
    """Rows taken in order while every cap allows it (W14, W18): so many of each value of each capped column, so many in all.

    A row beyond one cap counts for none, which makes it a sequence; each group
    is first cut to the rows that could be taken at all, at most ``most`` for
    each combination of capped values.  Rows of one place are numbered by a hash of
    what they hold, so there are never more than ``most`` of a group, and a row
    that is there twice counts twice.
    """
    names = list(caps)
    tie = F.xxhash64(F.to_json(F.struct(*rows.columns)))
    n = F.row_number().over(Window.partitionBy(by, *names).orderBy(order, tie))
    short = rows.withColumn("_n", n).where(F.col("_n") <= most)
    item = F.struct(F.struct(F.col(order), tie, F.col("_n")).alias("o"), F.struct(*rows.columns).alias("r"))
    place = lambda x, y: F.when(x["o"] < y["o"], -1).when(y["o"] < x["o"], 1).otherwise(0)
    lists = short.groupBy(by).agg(F.array_sort(F.collect_list(item), place).alias("items"))

    def room(acc: Column, x: Column, c: str) -> Column:
        limit = F.lit(caps[c].get("*", most))
        for value, n in caps[c].items():
            if value != "*":
                limit = F.when(x["r"][c] == value, n).otherwise(limit)
        return F.size(F.filter(acc, lambda y: y["r"][c].eqNullSafe(x["r"][c]))) < limit

    def step(acc: Column, x: Column) -> Column:
        ok = F.size(acc) < most
        for c in names:
            ok = ok & room(acc, x, c)
        return F.when(ok, F.array_append(acc, x)).otherwise(acc)

    return lists.select(F.explode(F.aggregate("items", F.slice("items", 1, 0), step)).alias("x")).select("x.r.*")
