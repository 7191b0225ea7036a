"""A Spark data source of inventories whose pages are found one by one: cursors that lead on, and numbered listings.

A store is a folder ``<source>/<inventory_id>/`` with a page a file.  A cursor
chain starts at the cursor ``*``; a page names the next (its file is the quoted
cursor with ``.json``).  A listing has pages ``1.html`` and on, newest first.
What page comes next, and whether one does, depends on the page before, so
a chain is read by one task, page after page, and a page that isn't needed is
never opened.  Inventories are dealt to partitions, a source's in a row.

A row is a page that was asked for: (source, inventory_id, page, cursor,
attempts, n_bytes, fault, body).  Faults say why a chain isn't whole, or what is
wrong with a page's order; the pages that came stay.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from paperloom.sources.offline import Patience, open_local

SCHEMA = "source string, inventory_id string, page int, cursor string, attempts int, n_bytes long, fault string, body string"

#: Rows of a full page where no total is stated, pages after which a chain is too long.
FULL_PAGE, MOST_PAGES = 1000, 25

#: Faults after which an inventory isn't complete; the other faults are about a page's order.
FAULTS = ("REQUEST_FAILED", "INVALID_PAYLOAD", "ENDED_EARLY", "STALLED", "TOO_MANY_PAGES", "WINDOW_NOT_CLOSED", "CIRCUIT_OPEN", "NOT_DESCENDING", "NOT_MONOTONIC")

#: Sources that may be skipped by name: a source is a provider, of which there are some hundreds.
MOST_SOURCES = 10_000

Page = tuple[int, str | None, int, int, str | None, str | None]
Fetch = Callable[[str], tuple[str | None, int, str | None]]


def _message(text: str) -> dict | None:
    try:
        m = json.loads(text)["message"]
        return m if isinstance(m["items"], list) else None
    except (ValueError, KeyError, TypeError):
        return None


def _size(text: str | None) -> int:
    return len(text.encode()) if text is not None else 0


def cursor_chain(fetch: Fetch, most_pages: int = MOST_PAGES, full: int = FULL_PAGE) -> Iterator[Page]:
    """Pages (page, cursor, attempts, bytes, fault, body) of a chain, up to its stated total, a short page, or a fault."""
    cursor, seen, total, got = "*", {"*"}, None, 0
    for page in range(1, most_pages + 1):
        text, attempts, fault = fetch(quote(cursor, safe="") + ".json")
        m = _message(text) if text is not None else None
        if m is None:
            yield page, cursor, attempts, _size(text), "REQUEST_FAILED: " + fault if fault else "INVALID_PAYLOAD", text
            return
        items, stated, following = m["items"], m.get("total-results"), str(m.get("next-cursor") or "").strip()
        got += len(items)
        if total is None and isinstance(stated, (int, str)) and str(stated).isdigit():
            total = int(stated)
        over = got >= total if total is not None else len(items) < full
        if not over:
            fault = "ENDED_EARLY" if not items else "STALLED" if not following or following in seen else "TOO_MANY_PAGES" if page == most_pages else None
        yield page, cursor, attempts, _size(text), fault, text
        if over or fault:
            return
        seen.add(following)
        cursor = following


def dates_of(text: str, pattern: str, formats: tuple[str, ...]) -> list[date]:
    """The dates of a listing in the order of the page; what has none of the formats is passed over."""
    out = []
    for found in re.findall(pattern, text):
        for f in formats:
            try:
                out.append(datetime.strptime(" ".join(found.split()), f).date())
                break
            except ValueError:
                pass
    return out


def numbered_pages(fetch: Fetch, start: date, pattern: str, formats: tuple[str, ...] = ("%d %B %Y", "%Y-%m-%d", "%B %d, %Y"), most_pages: int = 1, first: int = 1) -> Iterator[Page]:
    """Pages of a listing, newest first, up to the first that reaches behind ``start`` in good order.

    Dates have to fall within a page and from page to page; a page where they don't says so and can't end the scan.
    """
    oldest = None
    for page in range(first, first + most_pages):
        text, attempts, fault = fetch(f"{page}.html")
        if text is None:
            yield page, None, attempts, 0, f"REQUEST_FAILED: {fault}", None
            return
        days = dates_of(text, pattern, formats)
        falls = days == sorted(days, reverse=True)
        joins = oldest is None or not days or max(days) <= oldest
        oldest = min(days) if days else oldest
        closed = bool(days) and falls and joins and oldest < start
        fault = "NOT_DESCENDING" if not falls else "NOT_MONOTONIC" if not joins else "WINDOW_NOT_CLOSED" if not closed and page == first + most_pages - 1 else None
        yield page, None, attempts, _size(text), fault, text
        if closed:
            return


class ChainPartition(InputPartition):
    def __init__(self, source: str, inventories: list[str]):
        self.source, self.inventories = source, inventories


class ChainReader(DataSourceReader):
    def __init__(self, opener: Callable[[str, int], bytes], options: dict[str, str]):
        self.opener, self.options, self.patience = opener, options, Patience.of(options)

    def partitions(self):
        path, size = self.options["path"], int(self.options.get("inventoriesPerPartition", 16))
        out = []
        for source in sorted(os.listdir(path)):
            if self.options.get("source", source) == source:
                names = sorted(os.listdir(os.path.join(path, source)))
                out += [ChainPartition(source, names[i : i + size]) for i in range(0, len(names), size)]
        return out or [ChainPartition("", [])]

    def _pages(self, folder: str) -> Iterator[Page]:
        fetch = lambda name: self.patience.fetch(self.opener, os.path.join(folder, name))
        o = self.options
        if o.get("kind", "cursor") == "cursor":
            return cursor_chain(fetch, int(o.get("maxPages", MOST_PAGES)), int(o.get("fullPage", FULL_PAGE)))
        return numbered_pages(fetch, date.fromisoformat(o["start"]), o["datePattern"], most_pages=int(o.get("maxPages", 1)), first=int(o.get("firstPage", 1)))

    def read(self, partition):
        shut = partition.source in set(json.loads(self.options.get("skip", "[]")))
        left = int(self.options.get("mostFailures", 1 << 30))
        for name in partition.inventories:
            if shut or left <= 0:
                yield partition.source, name, None, None, 0, 0, "CIRCUIT_OPEN", None
                continue
            for page in self._pages(os.path.join(self.options["path"], partition.source, name)):
                left -= bool(page[4] and page[4].startswith("REQUEST_FAILED"))
                yield partition.source, name, *page


class ChainSource(DataSource):
    """Short name ``chains``.

    Options: ``path``; ``kind`` cursor (with ``fullPage``) or numbered (with ``start``, an ISO day, ``datePattern``, a pattern with one
    group, ``firstPage``); ``maxPages``; ``maxBytes``, ``attempts`` and ``pauseSeconds`` of a page; ``source``;
    ``inventoriesPerPartition`` (16).  A partition asks a source no more after ``mostFailures`` failed pages; ``skip`` is a JSON list
    of sources that aren't asked at all.  A subclass may open pages in another way.
    """

    opener = staticmethod(open_local)

    @classmethod
    def name(cls):
        return "chains"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ChainReader(self.opener, self.options)


def inventory_receipts(pages: DataFrame) -> DataFrame:
    """One row per inventory: pages asked and received, attempts, bytes, its faults in order of pages, and whether it is complete."""
    faults = F.transform(F.array_sort(F.collect_list(F.when(F.col("fault").isNotNull(), F.struct("page", "fault")))), lambda x: x["fault"])
    return pages.groupBy("source", "inventory_id").agg(
        F.count("page").alias("pages_requested"), F.count("body").alias("pages_received"), F.sum("attempts").alias("attempts"), F.sum("n_bytes").alias("n_bytes"), faults.alias("faults"),
    ).withColumn("complete", F.size("faults") == 0)


def open_circuits(receipts: DataFrame, most_failures: int) -> str:
    """The ``skip`` option after a run's receipts: sources of which more than so many inventories failed for good.

    The receipts are the state table of a run, appended to by each of its scans.  A run has some hundreds of sources;
    beyond MOST_SOURCES this fails.
    """
    failed = F.exists("faults", lambda f: f.startswith("REQUEST_FAILED"))
    shut = receipts.where(failed).groupBy("source").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_failures).select("source").limit(MOST_SOURCES + 1).collect()
    if len(shut) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources failed")
    return json.dumps(sorted(r["source"] for r in shut))
