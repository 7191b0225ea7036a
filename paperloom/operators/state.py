"""State across runs: keyed upserts, order-free merges, append-only tables, gaps and relations.

Merges are groups by key with ordered maxima, so merging is idempotent and
doesn't depend on which state comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.ids import event_id, stable_id
from paperloom.operators.graph import components, with_least
from paperloom.schema import ACCESS_DEPTHS, CLAIM_STATUSES, IDENTIFIERS, PROBED, filled, rank_of, strings
from paperloom.storage import spool


class StateConflict(RuntimeError):
    """States, or tables of one state, contradict each other."""


def require_empty(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raises StateConflict if there are violations; a few come to the driver for the message."""
    bad = violations.limit(show).collect()
    if bad:
        raise StateConflict(f"{what}: " + "; ".join(str(r.asDict()) for r in bad))


def latest(value: str, at: str = "last_seen_at") -> Column:
    """The value of the latest row that has one; ties go to the greater value (A4).  An aggregate."""
    c = F.col(value)
    return F.max_by(c, F.when(filled(c.cast("string")), F.struct(F.col(at), c.cast("string"))))


def stable_unique(values: Column) -> Column:
    """Distinct texts, ordered, in the spelling that sorts first."""
    keyed = F.array_sort(F.array_distinct(F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))))
    return F.transform(F.filter(keyed, lambda p, i: (i == 0) | (F.get(keyed, i - 1)["k"] != p["k"])), lambda p: p["v"])


def ledger(candidates: DataFrame, probes: DataFrame, notified: DataFrame) -> DataFrame:
    """The run's candidate table (J3): each work with its probe, and whether its event is new.

    ``probes`` has (work_id, url, status, http_status), ``notified`` (event_id).
    """
    one = probes.groupBy("work_id").agg(F.max_by(F.struct("url", "status", "http_status"), F.struct("status", "url")).alias("probe"))
    rows = candidates.join(one, "work_id", "left").withColumn("event_id", F.when(F.col("qualifying_event").isNotNull(), event_id(F.col("work_id"), F.col("qualifying_event"))))
    rows = rows.join(notified.select("event_id", F.lit(True).alias("_known")).distinct(), "event_id", "left")
    status = F.when(F.col("event_id").isNull(), "NO_QUALIFYING_EVENT").when(F.coalesce("_known", F.lit(False)), "ALREADY_NOTIFIED").otherwise("QUALIFYING")
    return rows.withColumn("event_status", status).drop("_known")


def upsert(prior: DataFrame, seen: DataFrame) -> DataFrame:
    """Works after a run (J4): (work_id, title, category, first_seen_at, last_seen_at, seen_count, streams, access_depth, oa_status)."""
    p, n = prior.alias("p"), seen.alias("n")
    both = p.join(n, F.col("p.work_id") == F.col("n.work_id"), "full_outer")
    pick = lambda c: F.coalesce(F.nullif(F.col(f"n.{c}"), F.lit("")), F.col(f"p.{c}")).alias(c)
    depth = [rank_of(F.col(f"{s}.access_depth"), ACCESS_DEPTHS, 0) for s in "pn"]
    said = F.array(F.col("p.oa_status"), F.col("n.oa_status"))
    return both.select(
        F.coalesce("p.work_id", "n.work_id").alias("work_id"),
        pick("title"),
        pick("category"),
        F.least("p.first_seen_at", "n.first_seen_at").alias("first_seen_at"),
        F.greatest("p.last_seen_at", "n.last_seen_at").alias("last_seen_at"),
        (F.coalesce("p.seen_count", F.lit(0)) + F.coalesce("n.seen_count", F.lit(0))).alias("seen_count"),
        F.array_sort(F.array_union(strings(F.col("p.streams")), strings(F.col("n.streams")))).alias("streams"),
        F.element_at(F.array(*map(F.lit, ACCESS_DEPTHS)), F.greatest(*depth) + 1).alias("access_depth"),
        F.when(F.array_contains(said, "YES"), "YES").when(F.array_contains(said, "NO"), "NO").otherwise("UNKNOWN").alias("oa_status"),
    )


def append_new(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table and the rows whose key it lacks: an insert that repeats without effect (S25, U6).  Of rows with one key, the first by their text."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*table.columns), F.to_json(F.struct(*table.columns))).alias("_row"))
    return table.unionByName(first.join(table.select(key), key, "left_anti").select("_row.*"))


def append_only_violations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the earlier table that the later one lacks or has changed."""
    return before.exceptAll(after.select(*before.columns))


def work_groups(works: DataFrame) -> DataFrame:
    """Works with the group they belong to: the same id or a shared strong identifier, never a title."""
    rows = works.withColumn("_id", F.xxhash64("work_id", F.col("last_seen_at").cast("string"), F.to_json("identifiers")))
    keys = F.concat(F.array(F.concat(F.lit("work="), F.col("work_id"))), F.transform(F.filter(F.map_entries("identifiers"), lambda e: filled(e["value"])), lambda e: F.concat(e["key"], F.lit("="), F.lower(F.trim(e["value"])))))
    each = rows.select("_id", F.explode(keys).alias("k"))
    first = spool(each.groupBy("k").agg(F.min("_id").alias("a")), "first")
    edges = with_least(each, "k", first).select("a", F.col("_id").alias("b"))
    joined = components(rows.select(F.col("_id").alias("id")), edges)
    return rows.join(joined, rows["_id"] == joined["id"]).drop("_id", "id").withColumnRenamed("component", "group")


def group_conflicts(grouped: DataFrame) -> DataFrame:
    """(group, kind, values) where a group has two values of one kind of identifier."""
    each = grouped.select("group", F.explode("identifiers").alias("kind", "v")).where(filled(F.col("v")))
    found = each.groupBy("group", "kind").agg(F.array_sort(F.collect_set(F.lower(F.trim("v")))).alias("values"))
    return found.where(F.size("values") > 1)


def merge_works(base: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both states' works, one row per group (A2, U2): first and last by time, greatest count, lists united, probes kept.

    Works have work_id, title, category, identifiers (map), first_seen_at, last_seen_at, seen_count, streams, notes,
    notified_event_ids, oa_status, access_status, access_depth, fulltext_locations.  Raises StateConflict on
    contradicting identifiers.
    """
    grouped = work_groups(base.unionByName(incoming))
    require_empty(group_conflicts(grouped), "identifiers of one work differ")
    united = lambda c: stable_unique(F.flatten(F.collect_list(strings(F.col(c))))).alias(c)
    strong = [F.concat(F.lit(f"{k}:"), F.lower(F.element_at("identifiers", F.lit(k)))) for k in IDENTIFIERS]
    named = [F.min(F.when(F.col("work_id") == s, F.col("work_id"))) for s in strong]
    said = F.collect_set("oa_status")
    depth = F.max(rank_of(F.col("access_depth"), ACCESS_DEPTHS, 0))
    probed = F.col("access_status").isin(*PROBED)
    out = grouped.groupBy("group").agg(
        F.coalesce(*named, F.min("work_id")).alias("work_id"),
        latest("title").alias("title"),
        latest("category").alias("category"),
        F.array_sort(F.collect_set("work_id")).alias("merged_ids"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.max("seen_count").alias("seen_count"),
        *map(united, ("streams", "notes", "notified_event_ids")),
        F.when(F.array_contains(said, "YES"), "YES").when(F.array_contains(said, "NO"), "NO").otherwise("UNKNOWN").alias("oa_status"),
        F.coalesce(F.max_by("access_status", F.when(probed, F.struct("last_seen_at", "access_status"))), latest("access_status"), F.lit("NOT_CHECKED")).alias("access_status"),
        F.element_at(F.array(*map(F.lit, ACCESS_DEPTHS)), depth + 1).alias("access_depth"),
    )
    ids = grouped.select("group", F.explode("identifiers").alias("k", "v")).where(filled(F.col("v"))).groupBy("group", "k").agg(F.min("v").alias("v"))
    ids = ids.groupBy("group").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("identifiers"))
    spots = grouped.select("group", "last_seen_at", F.explode("fulltext_locations").alias("x"))
    weight = F.struct(F.col("x.access_status").isin(*PROBED), F.col("last_seen_at"), F.to_json("x"))
    spots = spots.groupBy("group", "x.url").agg(F.max_by("x", weight).alias("x")).groupBy("group").agg(F.array_sort(F.collect_list("x")).alias("fulltext_locations"))
    return out.join(ids, "group", "left").join(spots, "group", "left").drop("group")


def id_map(merged: DataFrame) -> DataFrame:
    """(old_id, work_id) for every id that went into a merged work."""
    return merged.select(F.explode("merged_ids").alias("old_id"), "work_id")


def resolved_ids(pairs: DataFrame) -> DataFrame:
    """(old_id, work_id) with each id's last successor, from (old_id, work_id) pairs of any number of generations.

    Pointers are doubled: a round joins the pairs with themselves, so chains of n
    steps take log2 n rounds.  Raises StateConflict where an id has two successors,
    or is its own after some steps.  Pairs of one id with itself say nothing.
    """
    now = spool(pairs.where("old_id <> work_id").select("old_id", "work_id").distinct(), "ids")
    require_empty(now.groupBy("old_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("old_id"), "ids with several successors")
    for _ in range(max(now.count(), 1).bit_length() + 1):
        open_ = now.select(F.col("old_id").alias("work_id"), F.col("work_id").alias("_next"))
        after = spool(now.join(open_, "work_id", "left").select("old_id", F.coalesce("_next", "work_id").alias("work_id"), F.col("_next").isNotNull().alias("_moved")), "ids")
        now = after.select("old_id", "work_id")
        require_empty(now.where("old_id = work_id").select("old_id"), "ids that succeed themselves")
        if not after.where("_moved").limit(1).count():
            return now
    require_empty(now.join(now.select(F.col("old_id").alias("work_id")), "work_id", "left_semi").select("old_id"), "ids that lead to a circle")
    return now


def remap(rows: DataFrame, ids: DataFrame, column: str = "work_id") -> DataFrame:
    """Rows with old work ids replaced."""
    m = ids.select(F.col("old_id").alias("_old"), F.col("work_id").alias("_new"))
    return rows.join(m, rows[column] == m["_old"], "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


IMMUTABLE = ("work_id", "event_type", "occurred_at", "source", "source_url", "source_field", "precision", "confidence")


def merge_notified(events: DataFrame) -> DataFrame:
    """One row per event id, the last notification (A5); raises if what an id stands for differs."""
    same = [F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(c) for c in IMMUTABLE]
    odd = events.groupBy("event_id").agg(*same).where(" or ".join(f"{c} > 1" for c in IMMUTABLE))
    require_empty(odd.select("event_id"), "event ids that stand for several events")
    return events.groupBy("event_id").agg(*[F.max_by(c, F.struct("notified_at", "source")).alias(c) for c in (*IMMUTABLE, "notified_at")])


def merge_claims(base: DataFrame, incoming: DataFrame) -> DataFrame:
    """Claims of both states (A6, J14): texts must agree, sources are united, the most cautious status stays."""
    both = base.unionByName(incoming)
    require_empty(both.groupBy("claim_id").agg(F.count_distinct("claim").alias("n")).where("n > 1").select("claim_id"), "claims with several texts")
    return both.groupBy("claim_id").agg(
        F.max("claim").alias("claim"),
        F.element_at(F.array(*map(F.lit, CLAIM_STATUSES)), F.max(rank_of(F.col("status"), CLAIM_STATUSES, 0)) + 1).alias("status"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(strings(F.col("source_ids")))))).alias("source_ids"),
    )


def merge_gaps(base: DataFrame, incoming: DataFrame) -> DataFrame:
    """Gaps of both states (A6): attempts are the greater count if one side's receipts contain the other's, else their sum, up to the limit."""
    b, n = base.alias("b"), incoming.alias("n")
    both = b.join(n, F.col("b.gap_id") == F.col("n.gap_id"), "full_outer")
    mine, theirs = strings(F.col("b.receipt_ids")), strings(F.col("n.receipt_ids"))
    nested = (F.size(F.array_except(mine, theirs)) == 0) | (F.size(F.array_except(theirs, mine)) == 0)
    x, y = F.coalesce("b.attempt_count", F.lit(0)), F.coalesce("n.attempt_count", F.lit(0))
    most = F.greatest("b.max_attempts", "n.max_attempts")
    attempts = F.least(F.when(nested, F.greatest(x, y)).otherwise(x + y), most)
    newer = F.coalesce(F.col("n.last_attempt_at") >= F.col("b.last_attempt_at"), F.col("b.gap_id").isNull())
    status = F.when(newer, F.col("n.status")).otherwise(F.col("b.status"))
    return both.select(
        F.coalesce("b.gap_id", "n.gap_id").alias("gap_id"),
        F.coalesce("b.scope_id", "n.scope_id").alias("scope_id"),
        F.when((status == "OPEN") & (attempts >= most), "UNRESOLVABLE").otherwise(status).alias("status"),
        attempts.cast("int").alias("attempt_count"),
        most.alias("max_attempts"),
        F.greatest("b.last_attempt_at", "n.last_attempt_at").alias("last_attempt_at"),
        F.array_sort(F.array_union(mine, theirs)).alias("receipt_ids"),
    )


def gap_backlog(checks: DataFrame, attempts: DataFrame, prior: DataFrame, run_id: str, most: int = 3) -> DataFrame:
    """Gaps after a run (J11): a source that failed or was not tried opens one, a success closes it, follow-ups use up its attempts.

    ``checks`` has (source_id, status), ``attempts`` (attempt_id, source_id, stage, status), ``prior`` the gaps
    (gap_id, scope_id, first_seen_run, last_attempt_run, status, attempt_count, max_attempts, receipt_ids).
    """
    real = F.col("status") != "NOT_ATTEMPTED"
    tried = attempts.groupBy(F.col("source_id").alias("scope_id")).agg(
        F.array_sort(F.collect_set("attempt_id")).alias("ids"),
        F.count(F.when(real & (F.col("stage") == "FOLLOWUP"), 1)).cast("int").alias("followups"),
        F.count(F.when(real, 1)).alias("real"),
        F.min(F.when(F.col("status").isin("SUCCESS", "NO_RESULTS"), F.col("attempt_id"))).alias("resolution_receipt_id"),
    )
    now = checks.select(F.col("source_id").alias("scope_id"), F.col("status").alias("check_status")).join(tried, "scope_id", "left").withColumn("gap_id", stable_id("gap", F.lit("SOURCE_UNAVAILABLE"), F.col("scope_id")))
    p = prior.select(*[F.col(c).alias(f"p_{c}") for c in prior.columns])
    both = now.join(p, F.col("gap_id") == F.col("p_gap_id"), "full_outer")
    is_gap = F.col("check_status").isin("FAILED", "NOT_ATTEMPTED")
    solved = F.when(~is_gap, F.col("resolution_receipt_id"))
    known = F.col("p_gap_id").isNotNull()
    attempts_ = F.coalesce("p_attempt_count", F.lit(0)) + F.coalesce("followups", F.lit(0))
    limit = F.coalesce("p_max_attempts", F.lit(most))
    status = F.when(solved.isNotNull(), "RESOLVED").when(is_gap & (attempts_ >= limit), "UNRESOLVABLE").otherwise("OPEN")
    changed = F.col("gap_id").isNotNull() & (is_gap | (known & solved.isNotNull()))
    pick = lambda new, old: F.when(changed, new).otherwise(F.col(old))
    out = both.where(changed | known).select(
        F.coalesce("gap_id", "p_gap_id").alias("gap_id"),
        F.coalesce("scope_id", "p_scope_id").alias("scope_id"),
        pick(F.coalesce("p_first_seen_run", F.lit(run_id)), "p_first_seen_run").alias("first_seen_run"),
        pick(F.when(F.col("real") > 0, run_id).otherwise(F.coalesce("p_last_attempt_run", F.lit(run_id))), "p_last_attempt_run").alias("last_attempt_run"),
        pick(status, "p_status").alias("status"),
        pick(attempts_, "p_attempt_count").cast("int").alias("attempt_count"),
        limit.alias("max_attempts"),
        pick(F.array_sort(F.array_union(strings(F.col("p_receipt_ids")), strings(F.col("ids")))), "p_receipt_ids").alias("receipt_ids"),
        F.when(changed, solved).alias("resolution_receipt_id"),
    )
    return out


def work_relations(prior: DataFrame, current: DataFrame, run_id: str) -> DataFrame:
    """Earlier works that go on under another id (J10): gone now, one match by a strong identifier, none that contradicts.

    Both have work_id and identifiers (map); ``current`` has is_preprint.
    """
    each = lambda t, p: t.select(F.col("work_id").alias(f"{p}_id"), F.explode("identifiers").alias("kind", "v")).where(filled(F.col("v"))).select(f"{p}_id", "kind", F.lower(F.trim("v")).alias("v"))
    gone = prior.join(current.select("work_id"), "work_id", "left_anti")
    old, new = each(gone, "old"), each(current, "new")
    match = old.join(new, ["kind", "v"]).groupBy("old_id").agg(F.min("new_id").alias("new_id"), F.max("new_id").alias("_most"), F.array_sort(F.collect_set("kind")).alias("shared")).where("new_id = _most")
    clash = match.join(old, "old_id").join(new.withColumnRenamed("v", "w"), ["new_id", "kind"]).where("v <> w").select("old_id").distinct()
    facts = lambda t, p: t.groupBy(f"{p}_id").agg(F.array_contains(F.collect_set("kind"), "doi").alias(f"{p}_doi"), F.array_contains(F.collect_set("kind"), "arxiv_id").alias(f"{p}_arxiv"))
    rows = match.join(clash, "old_id", "left_anti").join(facts(old, "old"), "old_id").join(facts(new, "new"), "new_id")
    rows = rows.join(current.select(F.col("work_id").alias("new_id"), "is_preprint"), "new_id")
    kind = F.when(F.col("new_doi") & F.col("old_arxiv") & ~F.coalesce("is_preprint", F.lit(False)), "PREPRINT_TO_VOR").otherwise("NEW_VERSION")
    rows = rows.withColumn("relation_type", kind)
    return rows.select(stable_id("workrel", F.col("old_id"), F.col("new_id"), F.col("relation_type")).alias("relation_id"), F.col("old_id").alias("from_work_id"), F.col("new_id").alias("to_work_id"), "relation_type", "shared", F.lit(run_id).alias("observed_run_id"))


def merge_provenance(base: Column, incoming: Column, own: Column) -> Column:
    """Parent runs of both sides, each once, without the run itself."""
    return F.array_except(F.array_union(strings(base), strings(incoming)), F.array(own))


def project_sources(base: DataFrame, incoming: DataFrame, registry: DataFrame) -> DataFrame:
    """Evidence sources of both sides, the second's rows first (J13); raises unless they are exactly the registry's."""
    cols = [c for c in base.columns if c != "source_id"]
    b, n = base.alias("b"), incoming.alias("n")
    out = b.join(n, F.col("b.source_id") == F.col("n.source_id"), "full_outer").select(F.coalesce("n.source_id", "b.source_id").alias("source_id"), *[F.coalesce(f"n.{c}", f"b.{c}").alias(c) for c in cols])
    ids, known = out.select("source_id"), registry.select("source_id")
    require_empty(ids.exceptAll(known).unionAll(known.exceptAll(ids)), "sources differ from the registry")
    return out


# --- the older registry: records by key, found by any alias


def alias_index(records: DataFrame) -> DataFrame:
    """(alias, key): the first record that has an alias owns it (J22).  Records have key, position, aliases."""
    each = records.select("key", "position", F.explode("aliases").alias("alias"))
    return each.groupBy("alias").agg(F.min_by("key", F.struct("position", "key")).alias("key"))


def match_history(papers: DataFrame, records: DataFrame) -> DataFrame:
    """Papers with outcome new_work, new_version_event or history_duplicate, the record they belong to, and the transition.

    Papers have paper_id, aliases, is_preprint, open_access, repository_versions; records also key, position, embargoed.
    """
    index = alias_index(records)
    each = papers.select("paper_id", F.posexplode("aliases").alias("i", "alias"))
    found = each.join(index, "alias").groupBy("paper_id").agg(F.min_by("key", "i").alias("key"))
    old = records.select("key", *[F.col(c).alias(f"old_{c}") for c in ("is_preprint", "open_access", "repository_versions", "embargoed")])
    rows = papers.join(found, "paper_id", "left").join(old, "key", "left")
    true = lambda c: F.coalesce(F.col(c), F.lit(False))
    accepted = lambda c: F.array_contains(F.transform(strings(F.col(c)), F.lower), "acceptedversion")
    transition = (
        F.when(true("old_is_preprint") & ~true("is_preprint"), "preprint_to_peer_reviewed_upgrade")
        .when(accepted("repository_versions") & ~accepted("old_repository_versions"), "author_accepted_manuscript_first_available")
        .when(~true("old_open_access") & true("open_access"), F.when(true("old_embargoed"), "embargo_lifted").otherwise("oa_fulltext_first_available"))
    )
    rows = rows.withColumn("transition", F.when(F.col("key").isNotNull(), transition))
    outcome = F.when(F.col("key").isNull(), "new_work").when(F.col("transition").isNotNull(), "new_version_event").otherwise("history_duplicate")
    return rows.withColumn("outcome", outcome).withColumn("key", F.coalesce("key", F.get("aliases", F.lit(0)))).drop("old_is_preprint", "old_open_access", "old_repository_versions", "old_embargoed")


def mark_selection(records: DataFrame, featured: DataFrame, pool: DataFrame) -> DataFrame:
    """Records with outcome featured or candidate where an alias of a selected paper is theirs."""
    each = records.select("key", F.explode(F.array_union("aliases", F.array("key"))).alias("alias"))
    hit = lambda t: each.join(t.select(F.explode("aliases").alias("alias")).distinct(), "alias", "left_semi").select("key").distinct()
    rows = records.join(hit(featured).withColumn("_f", F.lit(True)), "key", "left").join(hit(pool).withColumn("_c", F.lit(True)), "key", "left")
    return rows.withColumn("outcome", F.when(F.col("_f"), "featured").when(F.col("_c"), "candidate").otherwise(F.col("outcome"))).drop("_f", "_c")


def enrich(papers: DataFrame, found: DataFrame, key: str = "doi") -> DataFrame:
    """Blanks filled from a lookup table (J20): pmcid and open_access."""
    f = found.groupBy(key).agg(F.max("pmcid").alias("_pmcid"), F.max("open_access").alias("_oa"))
    return papers.join(f, key, "left").withColumns({"pmcid": F.coalesce(F.nullif("pmcid", F.lit("")), "_pmcid", F.lit("")), "open_access": F.coalesce("_oa", "open_access")}).drop("_pmcid", "_oa")


def first_seen_union(base: Column, incoming: Column) -> Column:
    """Both lists in order, each value once."""
    return F.array_union(base, incoming)


def promote(base: DataFrame, incoming: DataFrame, base_sources: DataFrame, incoming_sources: DataFrame, registry: DataFrame, remaps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(works, sources) of an offline promotion (J24, K19): states merged, sources projected and bound to the merged works.

    ``remaps`` has the (old_id, work_id) pairs of earlier generations; an id of any of them is followed to the work it is
    now.  Raises StateConflict unless the sources are exactly the registry's and each belongs to a work.
    """
    works = spool(merge_works(base, incoming), "promoted")
    ids = id_map(works) if remaps is None else id_map(works).unionByName(remaps.select("old_id", "work_id"))
    sources = remap(project_sources(base_sources, incoming_sources, registry), resolved_ids(ids))
    require_empty(sources.join(works.select("work_id"), "work_id", "left_anti").select("source_id", "work_id"), "sources of works that aren't there")
    return works, sources
