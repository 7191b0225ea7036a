"""Entity resolution: observations into works.

Strong identifiers are edges; a component that would hold two values of one kind
of identifier is a conflict, and conflicts abort.  Titles may bridge components
whose identifiers complement each other, if date and author, venue or source
agree.  What a component's observations say is folded into one row by ordered
minima, not by a loop, so the order rows arrive in has no say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.normalize import doi, identifier, identity_key, record_title_key, title_key, work_id
from paperloom.operators.access import oa_status, stable_union
from paperloom.operators.classify import classify, is_formal, stable_types
from paperloom.operators.events import merge_events
from paperloom.operators.graph import components, connected_components, with_least
from paperloom.operators.rules import dealt
from paperloom.schema import IDENTIFIERS, filled, strings, text_of
from paperloom.storage import discard, spool

# Titles that say nothing, and sources that are no source.
GENERIC_TITLES = ("announcement", "commentary", "contents", "correction", "editorial", "erratum", "foreword", "introduction", "letter", "news", "preface")
GENERIC_SOURCES = ("formal", "formalproceedingsorpublisher", "publisher", "unknown")


class IdentityConflict(RuntimeError):
    """Observations with different values of one kind of identifier would become one work."""


def _identifiers(kinds: tuple[str, ...] = IDENTIFIERS) -> Column:
    """Kinds and values of an observation's identifiers, case folded; each is normalised once."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.lower(doi(F.col(k)) if k == "doi" else F.trim(text_of(F.col(k)))).alias("v")) for k in kinds])
    return F.filter(each, lambda x: x["v"] != "")


def _telling_hash() -> Column:
    """The hash of a title's key, null for a title that says nothing."""
    words = F.regexp_extract_all("_title", F.lit("[a-z0-9]+"), 0)
    telling = (F.size(words) >= 4) & (F.length(F.array_join(words, "")) >= 20) & (F.size(F.array_except(words, F.array(*map(F.lit, GENERIC_TITLES)))) > 0)
    return F.when(telling, F.unhex(F.sha2("_title", 256)))


def _keyed(rows: DataFrame) -> DataFrame:
    """Observations with an id of their own, spooled so that it stays the same, and with what they are compared by, which is made once."""
    rows = rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_title", title_key(F.col("title")))
    return spool(rows.withColumns({"_hash": _telling_hash(), "_ids": _identifiers()}), "observations")


def identifier_edges(rows: DataFrame, kinds: tuple[str, ...] = IDENTIFIERS) -> DataFrame:
    """(a, b) from each observation to the first one with the same identifier."""
    each = F.col("_ids") if "_ids" in rows.columns and kinds == IDENTIFIERS else _identifiers(kinds)
    pairs = rows.select("_id", F.explode(each).alias("x")).select("_id", "x.k", "x.v")
    first = spool(pairs.groupBy("k", "v").agg(F.min("_id").alias("a")), "first")
    return with_least(pairs, ["k", "v"], first).where("a <> _id").select("a", F.col("_id").alias("b"))


def conflicts(labelled: DataFrame, kinds: tuple[str, ...] = IDENTIFIERS) -> DataFrame:
    """(component, kind, values) where a component has several values of one kind of identifier."""
    each = F.array_compact(F.array(*[F.when(identifier(k).isNotNull(), F.struct(F.lit(k).alias("kind"), F.lower(identifier(k)).alias("v"))) for k in kinds]))
    found = labelled.select("component", F.explode(each).alias("x")).groupBy("component", "x.kind").agg(F.array_sort(F.collect_set("x.v")).alias("values"))
    return found.where(F.size("values") > 1)


#: Facts about open titles that one task goes through in order; both ways give the same bridges.
SMALL = 1 << 18


def _held(labelled: DataFrame) -> DataFrame:
    """(part, k, v): components' identifiers, each once."""
    each = F.col("_ids") if "_ids" in labelled.columns else _identifiers()
    return labelled.select(F.col("component").alias("part"), F.explode(each).alias("x")).select("part", "x.*").distinct()


def _title_facts(labelled: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What observations of telling titles say, by title and component, and components' identifiers: (title, part, k, v), (part, k, v).

    Only titles of several components count.  A title is a number in the order of titles; until it has one, its hash stands for it, as a title may be as long as a text.  Each title and part has a row of the kind ``part``, and one of the kind ``named`` if an observation has an identifier.
    """
    for name, made in (("_hash", _telling_hash()), ("_ids", _identifiers())):
        labelled = labelled if name in labelled.columns else labelled.withColumn(name, made)
    told = labelled.where(F.col("_hash").isNotNull())
    own = "_id" if "_id" in labelled.columns else "component"  # the row that a shared title's text is read from
    shared = told.groupBy("_hash").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min(own).alias("own")).where("a < b")
    shared = spool(shared.select("_hash", F.col("own").alias(own)), "shared-titles")
    names = with_least(told.select("_hash", own, "_title"), ["_hash", own], shared)
    names = spool((names if own == "_id" else names.dropDuplicates(["_hash"])).select("_title", "_hash"), "title-names")
    # Ranges of the order come one after the other, and so do the ids of their rows.
    ranged = names.repartitionByRange("_title").sortWithinPartitions("_title").withColumn("place", F.monotonically_increasing_id())
    numbers = spool(ranged.select("_hash", "place"), "title-numbers")
    plain = lambda c: F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "")
    sources = F.array_except(F.transform(F.concat(F.array("source"), strings(F.col("observed_sources"))), plain), F.array(*map(F.lit, GENERIC_SOURCES)))
    said = {"date": F.array(F.substring(text_of(F.col("publication_date")), 1, 10)), "author": F.transform(strings(F.col("authors")), plain), "venue": F.array(plain(F.col("venue"))), "source": sources}
    of = lambda k: lambda v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    one = lambda k, ok: F.when(ok, F.array(F.struct(F.lit(k).alias("k"), F.lit("-").alias("v")))).otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    pairs = F.concat(one("part", F.lit(True)), one("named", F.size("_ids") > 0), *[F.transform(c, of(k)) for k, c in said.items()])
    each = with_least(told, "_hash", numbers).select(F.col("place").alias("title"), F.col("component").alias("part"), F.explode(F.filter(pairs, lambda p: p["v"] != "")).alias("x"))
    facts = spool(each.select("title", "part", "x.*").distinct(), "facts")
    held = _held(labelled) if held is None else held
    return facts, spool(held.join(facts.where("k = 'part'").select("part"), "part", "left_semi"), "held")


def agrees(kinds: set[str], bare: bool) -> bool:
    """Whether what all components of a title say in common is enough to bridge it."""
    return "date" in kinds and ("author" in kinds or "venue" in kinds or (bare and "source" in kinds))


def _in_order(facts: DataFrame, held: DataFrame) -> DataFrame:
    """(part, root) after the titles of at most SMALL facts, one after the other in one task; facts and identifiers are those of roots."""

    def run(batches):
        import pyarrow as pa

        titles, ids, up = {}, {}, {}
        for b in batches:
            for title, part, k, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                up[part] = part
                if title is None:
                    ids.setdefault(part, {})[k] = v
                else:
                    titles.setdefault(title, {}).setdefault(part, set()).add((k, v))

        def root(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for title in sorted(titles):
            said = {}
            for part, facts in titles[title].items():
                said.setdefault(root(part), set()).update(facts)
            pairs = {p for r in said for p in ids.get(r, {}).items()}
            if len(said) < 2 or len({k for k, _ in pairs}) < len(pairs):
                continue
            common = {k for k, _ in set.intersection(*said.values())}
            if agrees(common, any(("named", "-") not in x for x in said.values())):
                top = min(said)
                up.update(dict.fromkeys(said, top))
                ids[top] = dict(pairs)
        parts = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(map(root, parts), pa.int64())], ["part", "root"])

    rows = facts.select("title", "part", "k", "v").unionAll(held.select(F.lit(None).cast("long"), "part", "k", "v"))
    return rows.repartition(1).mapInArrow(run, "part long, root long")


def _moved(facts: DataFrame, held: DataFrame, small: int = SMALL) -> DataFrame:
    """(part, root) of the components that a bridge has given another root.

    Titles go in their order, as an earlier bridge changes what a later title has
    to agree on.  A title's turn has come once it is the least open one at each of
    its components: nothing that is open before it can touch them.  All titles whose
    turn has come have components of their own, so a round judges them side by side.  A title's components agree if
    they say the same date, and the same author, venue or, where one has no identifier, source; they
    contradict each other if they hold two identifiers of one kind.  Nothing is
    gathered by title or component: what all say, and what contradicts itself, is found by counting.
    A round keeps the open titles alone, and the identifiers at them.  Once at most ``small`` facts are left, by
    count, one task goes through their titles.
    """
    out = facts.sparkSession.createDataFrame([], "part long, root long")

    def further(moves: DataFrame) -> DataFrame:
        """What has moved so far, with the moves of a round."""
        last = out.join(moves.select(F.col("part").alias("root"), "to"), "root", "left").select("part", F.coalesce("to", "root").alias("root"))
        return spool(last.unionAll(moves.select("part", F.col("to").alias("root"))), "moved")

    n = facts.count()
    while n:
        if n + held.count() <= small:
            last = spool(_in_order(facts, held), "in-order")
            return further(last.where("part <> root").select("part", F.col("root").alias("to")))
        parts = facts.where("k = 'part'").select("title", "part")
        first = spool(parts.groupBy("part").agg(F.min("title").alias("first")), "turns")
        turn = with_least(parts, "part", first).groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("to"), F.bool_and(F.col("title") == F.col("first")).alias("ready"))
        turn = spool(turn.where("n > 1"), "titles")  # titles of one part are through
        now = spool(with_least(facts, "title", turn.where("ready").drop("ready")), "ready")
        own = now.where("k = 'part'").select("title", "part", "to")
        names = held.join(own, "part").select("title", "k", "v", F.lit(None).cast("long").alias("n"))
        each = now.select("title", "k", "v", "n").unionAll(names).groupBy("title", "k", "v").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
        has = lambda *k: F.bool_or(F.coalesce(F.col("m") == F.col("n"), F.lit(False)) & F.col("k").isin(*k))
        bare = F.coalesce(F.max(F.when(F.col("k") == "named", F.col("m"))), F.lit(0)) < F.max("n")
        two = F.greatest(*[F.count(F.when(F.col("k") == k, 1)) for k in IDENTIFIERS]) > 1
        fine = each.groupBy("title").agg((has("date") & (has("author", "venue") | (bare & has("source"))) & ~two).alias("ok")).where("ok")
        moves = spool(own.where("part <> to").join(fine.select("title"), "title", "left_semi").select("part", "to"), "moves")
        moved = lambda t: t.join(moves, "part", "left").withColumn("part", F.coalesce("to", "part")).drop("to")
        out = further(moves)
        facts = spool(moved(facts.join(turn.where("NOT ready").select("title"), "title", "left_semi")).select("title", "part", "k", "v").distinct(), "facts")
        if n := facts.count():
            left = moved(held).join(facts.where("k = 'part'").select("part"), "part", "left_semi")
            held = spool(left.select("part", "k", "v").distinct(), "held")
    return out


def bridged(labelled: DataFrame, small: int = SMALL) -> DataFrame:
    """(part, root): components after titles have bridged those that complement each other and agree."""
    facts, held = _title_facts(labelled)
    parts = facts.where("k = 'part'").select("part").distinct()
    return parts.join(_moved(facts, held, small), "part", "left").select("part", F.coalesce("root", "part").alias("root"))


def label(candidates: DataFrame, bridge: bool = True, small: int = SMALL) -> DataFrame:
    """The observations with their component (J1).  Raises IdentityConflict where identifiers contradict each other.

    Titles bridge components in their order; a bridge that would bring contradicting identifiers together is left out.
    """
    rows = _keyed(candidates)
    found = connected_components(identifier_edges(rows))
    labelled = spool(rows.join(found, F.col("_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "_id")).drop("node"), "labelled")
    discard(rows)
    held = spool(_held(labelled), "identifiers")
    if held.groupBy("part", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect():
        bad = conflicts(labelled).limit(5).collect()
        raise IdentityConflict("; ".join(f"{r['kind']}: {', '.join(r['values'])}" for r in bad))
    if not bridge:
        return labelled
    roots = _moved(*_title_facts(labelled, held), small)
    return labelled.join(roots, labelled["component"] == roots["part"], "left").withColumn("component", F.coalesce("root", "component")).drop("part", "root")


#: Observations of a component from which they are put in order over ranges of it, and not in one task; both ways give the same works.
CROWD = 1 << 18


def fold(labelled: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per component (A1): the first observation by title, formality, identifiers, score and source; blanks filled from
    the others in that order; a formal version's title, source, date and links before a preprint's; lists united; the best score."""
    rows = classify(labelled)
    ids = F.concat_ws("|", *[F.concat(F.lit(f"{k}="), identifier(k)) for k in sorted(IDENTIFIERS)])
    plain = F.to_json(F.struct(*[c for c in labelled.columns if not c.startswith("_") and c != "component"]))
    order = {"_o1": F.when(is_formal(), 0).otherwise(1), "_o2": ids, "_o3": -F.coalesce("score", F.lit(0)), "_o4": F.lower(text_of(F.col("source"))), "_o5": plain}
    # A number stands for an observation's place in the order: minima that each carried what is ordered by would be kilobytes a row.
    rows, keys = rows.withColumn("_formal", is_formal()).withColumns(order), ["_title", *order]
    if labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).limit(1).count():
        keys += [c for c in ("_id",) if c in labelled.columns]  # copies tie, whichever comes first; their ids spread them over ranges
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        rows = dealt(rows, "component").sortWithinPartitions("component", *keys)
    rows = rows.withColumn("_order", F.monotonically_increasing_id())
    base = lambda c: F.min_by(c, "_order")
    first_filled = lambda c: F.min_by(c, F.when(filled(F.col(c)), F.col("_order")))
    formal = lambda c: F.min_by(c, F.when(F.col("_formal"), F.col("_order")))
    none = lambda c: F.nullif(c, F.lit(""))
    overriding = lambda c: none(F.when(~base("_formal"), formal(c)))
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    lists = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_order", F.col(c).alias("x")))), lambda s: s["x"]))
    out = rows.groupBy("component").agg(
        *[F.coalesce(overriding(c), none(base(c)), F.lit("")).alias(c) for c in ("title", "source")],
        *[F.coalesce(overriding(c), none(base(c)), first_filled(c), F.lit("")).alias(c) for c in ("venue", "abstract", "landing_url")],
        F.coalesce(overriding("publication_date"), none(base("publication_date")), F.min_by("publication_date", F.when(F.col("_formal") & filled(F.col("publication_date")), F.col("_order"))), F.lit("")).alias("publication_date"),
        *[base(c).alias(c) for c in ("stream", "category")],
        *[F.coalesce(first_filled(c), F.lit("")).alias(c) for c in IDENTIFIERS],
        F.array_distinct(lists("authors")).alias("authors"),
        stable_types(F.flatten(F.collect_set(strings(F.col("provider_publication_types"))))).alias("provider_publication_types"),
        merge_events(F.flatten(F.collect_list("events"))).alias("events"),
        stable_union(F.flatten(F.collect_list("oa_evidence"))).alias("oa_evidence"),
        united(strings(F.col("query_ids"))).alias("query_ids"),
        united(F.when(F.size(strings(F.col("observed_streams"))) > 0, F.col("observed_streams")).otherwise(F.array("stream"))).alias("observed_streams"),
        united(F.when(F.size(strings(F.col("observed_sources"))) > 0, F.col("observed_sources")).otherwise(F.array("source"))).alias("observed_sources"),
        F.when(F.bool_or(F.coalesce("open_access", F.lit(False))), True).otherwise(base("open_access")).alias("open_access"),
        F.when(F.bool_or(F.upper("oa_status") == "YES"), "YES").when(F.bool_or(F.upper("oa_status") == "NO"), "NO").otherwise("UNKNOWN").alias("oa_status"),
        (F.bool_or(F.coalesce("is_preprint", F.lit(False))) & ~F.bool_or("_formal")).alias("is_preprint"),
        F.max(F.coalesce("score", F.lit(0))).alias("score"),
        F.count(F.lit(1)).alias("n_observations"),
    )
    open_ = filled(F.col("pmcid")) | filled(F.col("arxiv_id"))
    out = out.withColumn("open_access", F.when(open_, True).otherwise(F.col("open_access"))).withColumn("oa_status", oa_status())
    return classify(out).withColumn("work_id", work_id())


def deduplicate(candidates: DataFrame, bridge: bool = True) -> DataFrame:
    """Works from observations, best score first."""
    works = fold(label(candidates, bridge)).drop("component")
    return works.repartition("work_id").orderBy(F.desc("score"), "work_id")  # Spark's sample of the order reads the shuffle and folds nothing again


# --- feeds and registries


def merge_feed_and_registry(feed: DataFrame, registry: DataFrame) -> DataFrame:
    """A provider's feed and its registry as one inventory (J5): same DOI or url, else a supported title; the feed's values first.

    Rows have record_id, doi, landing_url, title, publication_date, authors, venue.
    Each group of records that share an alias or a supported title is one record,
    unless its DOIs differ: then records of one DOI are together, and one without joins the smallest DOI
    among the records whose url it has, else of those it agrees with by title, or stays alone.
    """
    rows = feed.withColumn("_rank", F.lit(0)).unionByName(registry.withColumn("_rank", F.lit(1)))
    rows = spool(rows.withColumn("id", F.monotonically_increasing_id()).withColumn("_key", record_title_key(F.col("title"))), "records")
    alias = F.array_compact(F.array(F.concat(F.lit("doi:"), F.nullif(F.lower("doi"), F.lit(""))), F.concat(F.lit("url:"), F.nullif(F.col("landing_url"), F.lit("")))))
    each = rows.select("id", F.explode(alias).alias("k"))
    by_alias = with_least(each, "k", spool(each.groupBy("k").agg(F.min("id").alias("a")), "first")).where("a <> id").select("a", F.col("id").alias("b"))
    words = F.regexp_extract_all(F.lower(text_of(F.col("title"))), F.lit("[a-z0-9]+"), 0)
    telling = (F.size(words) >= 3) & (F.length("_key") >= 12) & ~F.col("_key").isin(*GENERIC_TITLES)
    names = F.transform(strings(F.col("authors")), lambda n: F.concat(F.lit("a:"), F.regexp_replace(F.lower(n), "[^a-z0-9]+", "")))
    venue = record_title_key(F.col("venue"))
    support = F.array_distinct(F.array_compact(F.concat(names, F.array(F.when(venue != "", F.concat(F.lit("v:"), venue))))))
    told = spool(rows.where(telling & filled(F.col("publication_date"))).select("id", F.lower(text_of(F.col("doi"))).alias("doi"), "_key", F.substring("publication_date", 1, 10).alias("d"), F.explode(support).alias("s")), "support")
    # Records that agree are linked to the first without a DOI; where each has one, to the first of the same.
    free = spool(told.where("doi = ''").groupBy("_key", "d", "s").agg(F.min("id").alias("u")), "free")
    same = spool(told.where("doi <> ''").groupBy("_key", "d", "s", "doi").agg(F.min("id").alias("m")), "same")
    star = told.join(free, ["_key", "d", "s"], "left").join(same, ["_key", "d", "s", "doi"], "left").withColumn("c", F.coalesce("u", "m")).where("c <> id")
    by_title = star.select(F.least("c", "id").alias("a"), F.greatest("c", "id").alias("b")).distinct()
    joined = components(rows.select("id"), by_alias.union(by_title))
    has_doi, url = filled(F.col("doi")), F.nullif("landing_url", F.lit(""))
    of_url = spool(rows.where(has_doi & url.isNotNull()).groupBy("landing_url").agg(F.min(F.lower("doi")).alias("near")), "urls")
    of_title = spool(told.where("doi <> ''").groupBy("_key", "d", "s").agg(F.min("doi").alias("near")), "titles")
    by_url = with_least(rows.where(~has_doi).select("id", "landing_url"), "landing_url", of_url).select("id", F.lit(0).alias("how"), "near")
    near = by_url.unionAll(with_least(told.where("doi = ''"), ["_key", "d", "s"], of_title).select("id", F.lit(1), "near")).groupBy("id").agg(F.min(F.struct("how", "near"))["near"].alias("_near"))
    rows = rows.join(joined, "id").join(near, "id", "left")
    dois = Window.partitionBy("component")
    many = F.size(F.collect_set(F.when(filled(F.col("doi")), F.lower("doi"))).over(dois)) > 1
    rows = rows.withColumn("_group", F.when(many & filled(F.col("doi")), F.concat_ws("|", "component", F.lower("doi"))).when(many & F.col("_near").isNotNull(), F.concat_ws("|", "component", "_near")).when(many, F.concat_ws("|", "component", "id")).otherwise(F.col("component").cast("string")))
    first = lambda c, ok: F.coalesce(F.min_by(c, F.when(ok, F.struct("_rank", "id"))), F.min_by(c, F.struct("_rank", "id"))).alias(c)
    cols = [c for c in feed.columns]
    some = lambda c: F.size(c) > 0 if dict(rows.dtypes)[c].startswith("array") else filled(F.col(c).cast("string"))
    return rows.groupBy("_group").agg(*[first(c, some(c)) for c in cols], F.count(F.lit(1)).alias("n_records")).drop("_group")


# --- the older rule


def deduplicate_papers(papers: DataFrame) -> DataFrame:
    """Papers with the same key or title as one (J21): the best total's row, ids filled from the others, streams and versions united."""
    rows = spool(papers.withColumn("id", F.monotonically_increasing_id()).withColumn("_keys", F.array(F.concat(F.lit("k:"), identity_key()), F.concat(F.lit("t:"), F.trim(F.regexp_replace(F.lower(text_of(F.col("title"))), r"[^\p{L}\p{N}_]+", " "))))), "papers")
    each = rows.select("id", F.explode("_keys").alias("k")).where("k <> 't:'")
    edges = with_least(each, "k", spool(each.groupBy("k").agg(F.min("id").alias("a")), "first")).where("a <> id").select("a", F.col("id").alias("b"))
    joined = components(rows.select("id"), edges)
    rows = rows.join(joined, "id").withColumn("_order", F.struct(-F.col("total_score"), F.col("id")))
    streams = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", F.concat(F.array("stream"), strings(F.col("secondary_streams"))).alias("s")))), lambda r: r["s"])))
    special = ("stream", "secondary_streams", "doi", "pmid", "pmcid", "openalex_id", "open_access", "repository_versions")
    plain = [c for c in papers.columns if c not in special]
    out = rows.groupBy("component").agg(
        *[F.min_by(c, "_order").alias(c) for c in plain],
        streams.alias("_streams"),
        *[F.coalesce(F.min_by(c, F.when(filled(F.col(c)), F.col("_order"))), F.lit("")).alias(c) for c in ("doi", "pmid", "pmcid", "openalex_id")],
        F.min_by("open_access", F.when(F.col("open_access").isNotNull(), F.col("_order"))).alias("open_access"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_order", F.col("repository_versions").alias("v")))), lambda r: strings(r["v"])))).alias("repository_versions"),
    )
    return out.withColumns({"stream": F.get("_streams", F.lit(0)), "secondary_streams": F.slice("_streams", 2, F.greatest(F.size("_streams") - 1, F.lit(0)))}).drop("_streams", "component").select(*papers.columns)
