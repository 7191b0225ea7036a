"""Identifiers, urls and dates in their canonical forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import collapse, folded, strip_markup, unescape
from paperloom.schema import IDENTIFIERS, filled, text_of

# --- identifiers


def doi(col: Column) -> Column:
    """Lower case, without resolver and ``doi:`` in front and blanks and dots behind."""
    bare = F.regexp_replace(F.lower(collapse(col)), r"^https?://(?:dx\.)?doi\.org/", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^doi:\s*", ""), "[ .]+$", "")


def feed_doi(col: Column) -> Column:
    """The first thing that looks like a DOI, lower case; empty if there is none."""
    bare = F.regexp_replace(F.trim(unescape(text_of(col))), r"(?i)^doi\s*:\s*", "")
    found = F.regexp_extract(F.regexp_replace(bare, r"(?i)^https?://(?:dx\.)?doi\.org/", ""), r"(?i)(10\.\d{4,9}/[-._;()/:A-Z0-9]+)", 1)
    return F.lower(F.regexp_replace(found, "[ .,;]+$", ""))


def first_doi(*fields: Column) -> Column:
    """The first field that holds a DOI; fields that say so go before general identifiers."""
    return F.coalesce(*[F.nullif(feed_doi(f), F.lit("")) for f in fields], F.lit(""))


def title_key(title: Column) -> Column:
    """Folded title, what is neither word nor space as blanks, collapsed."""
    return collapse(F.regexp_replace(folded(text_of(title)), r"(?U)[^\p{L}\p{N}_\s]", " "))


def record_title_key(title: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(strip_markup(title)), r"(?U)[^a-z0-9]+", "")


def identifier(name: str) -> Column:
    """The normalised identifier, or null where it is missing."""
    return F.nullif(doi(F.col(name)) if name == "doi" else F.trim(text_of(F.col(name))), F.lit(""))


def identifiers() -> Column:
    """Type to value, of those that are there."""
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), identifier(n).alias("value")) for n in IDENTIFIERS])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def work_id() -> Column:
    """``type:value`` of the strongest identifier, else ``title:`` and the hash of the title's key."""
    strong = [F.concat(F.lit(f"{n}:"), identifier(n)) for n in IDENTIFIERS]
    return F.coalesce(*strong, F.concat(F.lit("title:"), F.sha2(title_key(F.col("title")), 256)))


def terminal_id(col: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(F.regexp_replace(F.trim(text_of(col)), "/+$", ""), "/", -1)


def arxiv_id(url: Column) -> Column:
    """Path after ``abs/``, else the last segment, without version."""
    path = F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*?)/*(?:[?#]|$)", 1)
    return F.regexp_replace(F.when(path.startswith("abs/"), F.substring(path, 5, 1 << 30)).otherwise(terminal_id(url)), r"v\d+$", "")


def identity_key() -> Column:
    """DOI, else PubMed id, else OpenAlex id, else hash of the title."""
    title = F.trim(F.regexp_replace(F.lower(text_of(F.col("title"))), r"[^\p{L}\p{N}_]+", " "))
    return F.coalesce(
        F.concat(F.lit("doi:"), identifier("doi")),
        F.concat(F.lit("pmid:"), identifier("pmid")),
        F.concat(F.lit("openalex:"), F.nullif(F.lower(terminal_id(F.col("openalex_id"))), F.lit(""))),
        F.concat(F.lit("title:"), F.sha1(title)),
    )


def aliases() -> Column:
    """Every key a paper may have been seen under before, strongest first."""
    title = F.trim(F.regexp_replace(F.lower(text_of(F.col("title"))), r"[^\p{L}\p{N}_]+", " "))
    named = [("doi", "doi", identifier("doi")), ("pmid", "pmid", F.lower(identifier("pmid"))), ("pmcid", "pmcid", F.lower(identifier("pmcid"))), ("openalex_id", "openalex", F.nullif(F.lower(terminal_id(F.col("openalex_id"))), F.lit("")))]
    return F.array_distinct(F.array_compact(F.array(*[F.concat(F.lit(f"{p}:"), v) for _, p, v in named], F.concat(F.lit("title:"), F.sha1(title)))))


def record_aliases(key: Column, known: Column) -> Column:
    """Aliases of a stored record: its key, those it lists, those of its identifiers and title."""
    return F.array_distinct(F.concat(F.array(key), F.coalesce(known, F.array().cast("array<string>")), aliases()))


# --- urls


def ordered_unique_urls(urls: Column) -> Column:
    """Trimmed http(s) urls, each once, in order."""
    clean = F.transform(F.coalesce(urls, F.array().cast("array<string>")), lambda u: F.trim(text_of(u)))
    return F.array_distinct(F.filter(clean, lambda u: u.rlike("^https?://")))


def _quoted(col: Column) -> Column:
    """Percent-encoded, slashes kept."""
    return F.replace(F.replace(F.url_encode(col), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def fulltext_urls() -> Column:
    """Direct repository urls, never resolvers or abstracts."""
    pmc = F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), _quoted(identifier("pmcid")), F.lit("/"))
    pdf = F.concat(F.lit("https://arxiv.org/pdf/"), _quoted(identifier("arxiv_id")))
    return F.array_distinct(F.array_compact(F.array(pmc, F.concat(pmc, F.lit("pdf")), pdf)))


def discovery_urls() -> Column:
    """Every link that shows where an observation is from, in a fixed order (P20)."""
    more = F.array(
        F.concat(F.lit("https://arxiv.org/abs/"), _quoted(identifier("arxiv_id"))),
        F.concat(F.lit("https://europepmc.org/articles/"), _quoted(identifier("pmcid"))),
        F.when(F.col("landing_url").rlike("^https?://"), F.col("landing_url")),
        F.concat(F.lit("https://doi.org/"), _quoted(identifier("doi"))),
        F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), _quoted(identifier("pmid")), F.lit("/")),
        F.when(F.col("openalex_id").rlike("^https?://"), F.col("openalex_id")),
    )
    return ordered_unique_urls(F.concat(fulltext_urls(), F.array_compact(more)))


# Hosts that show abstracts and indexes.
DISCOVERY_HOSTS = ("pubmed.ncbi.nlm.nih.gov", "pmc.ncbi.nlm.nih.gov", "europepmc.org", "arxiv.org", "export.arxiv.org", "openalex.org")
DISCOVERY_DOMAINS = (".europepmc.org", ".arxiv.org", ".openalex.org")


def publisher_url() -> Column:
    """Where the publisher's page is: the DOI, else the archive, else a landing page that is no index; else empty."""
    host = host_of(F.col("landing_url"))
    is_index = host.isin(*DISCOVERY_HOSTS) | F.exists(F.array(*map(F.lit, DISCOVERY_DOMAINS)), lambda d: F.endswith(host, d))
    by_index = F.replace(F.lower(text_of(F.col("source"))), F.lit("_"), F.lit(" ")).isin("pubmed", "europe pmc", "arxiv") & (host == "")
    other = F.col("openalex_id").rlike("^https?://") & ~host_of(F.col("openalex_id")).isin("openalex.org", "api.openalex.org")
    return (
        F.when(filled(F.col("doi")), F.concat(F.lit("https://doi.org/"), _quoted(doi(F.col("doi")))))
        .when(filled(F.col("pmcid")), F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), F.col("pmcid"), F.lit("/")))
        .when(is_index | by_index, "")
        .when(F.col("landing_url").rlike("^https?://"), F.col("landing_url"))
        .when(other, F.col("openalex_id"))
        .otherwise("")
    )


TRACKING = r"(?i)^(utm_.*|fbclid|gclid)$"


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, query sorted and without tracking, no fragment, no slash at the end; empty if it is no http(s) url."""
    u = F.trim(text_of(url))
    scheme, host, path = F.lower(F.regexp_extract(u, "^([A-Za-z]+)://", 1)), host_of(u), path_of(u)
    raw = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(raw, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).rlike(TRACKING))
    full = F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    by_key = F.array_sort(F.transform(full, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("v"))))
    query = F.array_join(F.transform(by_key, lambda p: F.concat_ws("=", p["k"], p["v"])), "&")
    out = F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    out = F.when((path != "") & (path != "/"), F.regexp_replace(out, "/+$", "")).otherwise(out)
    return F.when(scheme.isin("http", "https") & (host != ""), out).otherwise("")


def _bare_host(url: Column) -> Column:
    return F.regexp_replace(host_of(url), r"^www\.", "")


def source_type(url: Column) -> Column:
    """What kind of site a url is on."""
    h = _bare_host(url)
    under = lambda d: (h == d) | h.endswith(f".{d}")
    return (
        F.when(under("doi.org"), "publisher")
        .when(h == "pubmed.ncbi.nlm.nih.gov", "pubmed")
        .when(h.isin("europepmc.org", "pmc.ncbi.nlm.nih.gov") | h.endswith(".ebi.ac.uk"), "europe_pmc")
        .when(under("arxiv.org"), "arxiv")
        .when(under("openreview.net"), "openreview")
        .when(h.isin("aclanthology.org", "proceedings.mlr.press"), "conference_proceedings")
        .when(under("openalex.org"), "other")
        .otherwise("publisher")
    )


def source_role(url: Column, kind: Column) -> Column:
    """What a url may stand for in evidence."""
    path = F.lower(path_of(url))
    primary = ((kind == "europe_pmc") & F.contains(path, F.lit("/articles/pmc"))) | ((kind == "arxiv") & path.rlike("^/(pdf|html)/")) | ((kind == "openreview") & path.startswith("/pdf"))
    return (
        F.when(primary, "PRIMARY_RESEARCH")
        .when(kind.isin("pubmed", "other", "europe_pmc", "arxiv", "openreview"), "DISCOVERY_ONLY")
        .when(kind.isin("conference_proceedings", "publisher") | (_bare_host(url) == "doi.org"), "FORMAL_PUBLICATION")
        .otherwise("OTHER")
    )


def is_discovery_landing(url: Column, kind: Column) -> Column:
    """Whether a url is an index or abstract page."""
    return source_role(url, kind) == "DISCOVERY_ONLY"


def feed_link(link: Column) -> Column:
    """Without the campaign parameter that one publisher's feeds add."""
    ours = host_of(link).isin("sciencedirect.com", "www.sciencedirect.com")
    cut = F.regexp_replace(F.regexp_replace(link, r"([?&])dgcid=[^&#]*", "$1"), r"&&+", "&")
    cut = F.regexp_replace(F.regexp_replace(cut, r"\?&", "?"), r"[?&](#|$)", "$1")
    return F.when(ours, cut).otherwise(link)


def with_page(endpoint: Column, parameter: str, page: Column) -> Column:
    """The url with its page parameter replaced, as the last one."""
    u, fragment = F.substring_index(endpoint, "#", 1), F.regexp_extract(endpoint, "(#.*)$", 1)
    raw = F.when(F.contains(u, F.lit("?")), F.regexp_extract(u, r"\?(.*)$", 1)).otherwise("")
    kept = F.filter(F.split(raw, "&"), lambda p: (p != "") & (F.substring_index(p, "=", 1) != parameter))
    query = F.array_join(F.concat(kept, F.array(F.concat(F.lit(f"{parameter}="), page.cast("string")))), "&")
    return F.concat(F.substring_index(u, "?", 1), F.lit("?"), query, fragment)


def container_identity(url: Column, path_regex: str, prefix: str = "") -> Column:
    """The journal in a url's path, by a pattern with one group."""
    found = F.lower(F.trim(F.regexp_extract(path_of(url), path_regex, 1)))
    return F.when(found == "", "").otherwise(F.concat(F.lit(f"{prefix}:" if prefix else ""), found))


# --- dates

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
RFC_FORMATS = ("EEE, d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss zzz", "d MMM yyyy HH:mm:ss zzz")


def iso_date(col: Column) -> Column:
    """The date in the first ten characters, or null; a month alone is no date."""
    head = F.substring(text_of(col), 1, 10)
    return F.when(head.rlike(ISO_DATE), F.try_to_date(head, "yyyy-MM-dd"))


def provider_date(col: Column) -> Column:
    """An ISO or RFC 2822 date or time as an ISO date; empty if it is neither.

    The date is the one that is written, whatever the offset.
    """
    t = F.trim(text_of(col))
    written = F.regexp_extract(t, r"(\d{1,2} [A-Za-z]{3} \d{4})", 1)
    return F.coalesce(iso_date(t).cast("string"), F.try_to_date(written, "d MMM yyyy").cast("string"), F.lit(""))


def epoch_date(col: Column) -> Column:
    """Seconds or milliseconds since 1970 as a UTC date; other values as ``provider_date``.

    Numbers above 10^10 are milliseconds.  Years after 9999 have five digits and no sign.
    """
    t = F.trim(text_of(col.cast("string")))
    number = F.expr("null").cast("double")
    number = F.try_to_number(F.when(t.rlike(r"^\d{1,18}$"), t), F.lit("999999999999999999")).cast("double")
    seconds = F.when(number > 10_000_000_000, number / 1000).otherwise(number)
    day = F.ltrim(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")).cast("string"), F.lit("+"))
    return F.when(number.isNotNull(), day).otherwise(provider_date(t))


# Month names by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def lenient_date(year: Column, month: Column, day: Column) -> Column:
    """Year with month by name or number and day; what can't be a date is the first of January, no year is empty."""
    y, m, d = (F.trim(text_of(c)) for c in (year, month, day))
    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(m), 1, 3)).cast("int")
    mm = F.when(named > 0, named).when(m.rlike(r"^\d{1,2}$"), F.expr("null").cast("int")).otherwise(1)
    mm = F.coalesce(mm, F.when(m.rlike(r"^\d{1,2}$"), m).cast("int"))
    dd = F.when(d.rlike(r"^\d{1,2}$"), d).otherwise("1").cast("int")
    yy = F.when(y.rlike(r"^\d{4}$"), y).cast("int")
    made = F.try_to_date(F.format_string("%04d-%02d-%02d", yy, mm, dd), "yyyy-MM-dd").cast("string")
    return F.when(y == "", "").otherwise(F.coalesce(made, F.concat(y, F.lit("-01-01"))))


def journal_date(article: tuple[Column, Column, Column], issue: tuple[Column, Column, Column], free: Column) -> Column:
    """Article date, else issue date, else the year in free text."""
    year = F.regexp_extract(text_of(free), r"((?:19|20)\d{2})", 1)
    return F.coalesce(F.nullif(lenient_date(*article), F.lit("")), F.nullif(lenient_date(*issue), F.lit("")), F.when(year != "", F.concat(year, F.lit("-01-01"))), F.lit(""))


def parts_date(fields: list[tuple[str, Column]], lenient: bool = False) -> tuple[Column, Column]:
    """(date, field) of the first of the date-parts arrays that is a date; missing parts are 1.

    ``lenient``: a year with impossible month or day is its first of January (P64).
    """
    found, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for field, parts in reversed(fields):
        p = F.get(parts, F.lit(0))
        y, m, d = F.get(p, F.lit(0)), F.coalesce(F.get(p, F.lit(1)), F.lit(1)), F.coalesce(F.get(p, F.lit(2)), F.lit(1))
        made = F.try_to_date(F.when(y.isNotNull(), F.format_string("%04d-%02d-%02d", y, m, d)), "yyyy-MM-dd").cast("string")
        if lenient:
            made = F.coalesce(made, F.when(y.isNotNull(), F.format_string("%04d-01-01", y)))
        found, name = F.when(made.isNotNull(), made).otherwise(found), F.when(made.isNotNull(), F.lit(field)).otherwise(name)
    return F.coalesce(found, F.lit("")), F.coalesce(name, F.lit(""))


def labelled_citation(description: Column) -> tuple[Column, Column, Column]:
    """(first-online date, venue, authors) from a description with labels; a month alone is no date."""
    t = strip_markup(description)
    day = F.try_to_date(F.regexp_extract(t, r"(?i)Publication date:\s*Available online\s+(\d{1,2}\s+[A-Za-z]+\s+\d{4})(?=\s+Source:|$)", 1), "d MMMM yyyy")
    venue = F.regexp_replace(F.regexp_extract(t, r"(?i)Source:\s*(.+?)(?=\s+Author\(s\):|$)", 1), r"(?i),\s*Volume\s+.*$", "")
    authors = F.filter(F.transform(F.split(F.regexp_extract(t, r"(?i)Author\(s\):\s*(.*)$", 1), ","), lambda a: F.trim(a)), lambda a: a != "")
    return F.coalesce(day.cast("string"), F.lit("")), F.trim(venue), authors


def date_after_label(text: Column, label: str, formats: tuple[str, ...] = ("d MMMM yyyy", "MMMM d, yyyy", "yyyy-MM-dd")) -> Column:
    """The first date within 160 characters after a label; empty without."""
    at = F.instr(F.lower(text), label.lower())
    tail = F.substring(text, at + len(label), F.lit(160))
    token = F.regexp_extract(tail, r"(\d{1,2} [A-Za-z]{3,9} \d{4}|[A-Za-z]{3,9} \d{1,2}, \d{4}|\d{4}-\d{2}-\d{2})", 1)
    made = F.coalesce(*[F.try_to_date(token, f) for f in formats])
    return F.when(at > 0, F.coalesce(made.cast("string"), F.lit(""))).otherwise("")


def guarded_date(published: Column, landing_url: Column) -> Column:
    """A feed's date, unless the year in the work's id says otherwise."""
    made, year = provider_date(published), F.regexp_extract(terminal_id(landing_url), r"^(\d{4})\.", 1)
    return F.when((year != "") & (F.substring(made, 1, 4) != year), "").otherwise(made)


# --- others


def inverted_abstract(index: Column) -> Column:
    """Words by position, ties by word, from a map of words to positions."""
    spots = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.coalesce(F.array_join(F.transform(F.array_sort(spots), lambda s: s["w"]), " "), F.lit(""))


def delivery_prefix(run_id: Column, ended_at: Column) -> Column:
    """Alias of a run's files: its time and id."""
    return F.concat_ws("_", F.date_format(ended_at, "yyyyMMdd-HHmm"), F.regexp_replace(run_id, "[^A-Za-z0-9]+", "-"))
