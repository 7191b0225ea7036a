"""Line dedup by frequency within a site.

Pages are grouped by host; a line is boilerplate of a host if more than
``ratio`` of the host's pages contain it.  A line on a single page is no
boilerplate of any host, however small (``min_pages`` is 2).  Lines are compared
without the blanks around them, by two independent 64-bit hashes of the whole
line, so that counting moves 16 bytes a line instead of its text.

A host has at most (lines of a mean page) / ratio boilerplate lines, however
many pages it has.  The lists are measured before they are broadcast; beyond
the bound, pages meet them in a join on host and a salt, so that a host with a
third of all pages is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, fresh, spool

RATIO, MIN_PAGES, BROADCAST_BYTES, SALTS = 0.1, 2, 16 << 20, 64


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(2), line).alias("b"))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(host, keys): the keys of each host's boilerplate lines; hosts without any don't appear."""
    pages = pages.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), _bare))
    each = pages.select("host", F.explode(lines).alias("line")).where("line <> ''")
    counts = each.select("host", _key(F.col("line")).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    totals = spool(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "totals")
    if bytes_of(totals, F.octet_length("host") + 8)[1] <= broadcast_bytes:
        totals = F.broadcast(totals)
    else:  # tables on both sides, so that AQE may split a host of many lines
        counts = spool(counts, "counts")
    return counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row of ``pages`` with its boilerplate lines dropped from ``text``, and n_lines, n_dropped, all_dropped.

    ``all_dropped`` marks pages of boilerplate alone: every line that isn't blank
    is dropped.  Whether those pages stay, go or keep their text is the caller's
    choice.  Null texts stay null (0 lines); rows without a host stay as they
    are; an empty text has one empty line.  Repeated rows count as pages of their
    own.  All columns of ``pages`` stay; a new one whose name is taken gets an
    underscore after it.
    """
    at, keys, mine, salt, kept = (fresh(pages, c) for c in ("bp_host", "bp_keys", "bp_mine", "bp_salt", "bp_kept"))
    n_lines, n_dropped, all_dropped = (fresh(pages, c) for c in ("n_lines", "n_dropped", "all_dropped"))
    lists = spool(boilerplate(pages, host, text, ratio, min_pages, broadcast_bytes), "boilerplate").select(F.col("host").alias(at), F.col("keys").alias(keys), F.transform("keys", lambda k: k["a"]).alias(f"{keys}_a"))
    _, size = bytes_of(lists, F.size(keys) * 24 + F.octet_length(at))
    if size <= broadcast_bytes:
        joined = pages.join(F.broadcast(lists), F.col(host) == F.col(at), "left")
    else:
        salted = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = pages.withColumn(mine, F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
        joined = joined.join(salted, (F.col(host) == F.col(at)) & (F.col(mine) == F.col(salt)), "left")
    lines = F.split(F.col(text), "\n", -1)
    # Which of the page's first hashes are any of the host's: one pass over a hash set; the whole key is looked up for those lines alone.
    near = F.array_intersect(F.transform(lines, lambda x: F.xxhash64(_bare(x))), F.col(f"{keys}_a"))
    left = F.filter(lines, lambda x: (_bare(x) == "") | ~F.array_contains(f"{kept}_near", F.xxhash64(_bare(x))) | ~F.array_contains(F.col(keys), _key(_bare(x))))
    joined = joined.withColumn(f"{kept}_near", F.when(F.col(keys).isNotNull() & F.col(text).isNotNull(), near))
    joined = joined.withColumn(kept, F.when(F.size(f"{kept}_near") > 0, left))
    cut = F.coalesce(F.size(kept) < F.size(lines), F.lit(False))
    return joined.withColumns({
        n_lines: F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long"),
        n_dropped: F.when(cut, F.size(lines) - F.size(kept)).otherwise(0).cast("long"),
        all_dropped: cut & ~F.exists(kept, lambda x: _bare(x) != ""),
        text: F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text)),
    }).select(*pages.columns, n_lines, n_dropped, all_dropped)
