"""Sinks: documents, archives and reports.

Tables are written by Spark.  A report or a state file is one document: its rows
were cut to a bounded number in Spark before they come to the driver.
"""

from __future__ import annotations

import fcntl
import hashlib
import html
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.coverage import parity
from paperloom.operators.state import StateConflict, require_empty


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def canonical(document) -> bytes:
    """Sorted keys, no NaN, one line at the end: equal documents are equal bytes."""
    return (json.dumps(document, ensure_ascii=False, sort_keys=True, indent=2, allow_nan=False) + "\n").encode()


def rows_of(df: DataFrame, most: int = 100_000) -> list[dict]:
    """A bounded table as JSON rows; more rows than that belong into a written table."""
    got = df.limit(most + 1).toJSON().collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows for one document")
    return [json.loads(x) for x in got]


def write_atomic(path: Path, data: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile(dir=path.parent, delete=False) as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f.name, path)


def write_bundle(folder: str, documents: dict[str, bytes]) -> dict[str, str]:
    """All files or none (K1, K4, K5): staged beside their places, then renamed; returns their hashes."""
    root, staged, kept = Path(folder), {}, {}
    root.mkdir(parents=True, exist_ok=True)
    try:
        for name, data in documents.items():
            staged[name] = root / f".{name}.staged"
            staged[name].write_bytes(data)
        for name, part in staged.items():
            if (root / name).exists():
                kept[name] = (root / name).read_bytes()
            os.replace(part, root / name)
    except OSError:
        for name, data in kept.items():
            write_atomic(root / name, data)
        raise
    finally:
        for part in staged.values():
            part.unlink(missing_ok=True)
    return {name: sha256(data) for name, data in documents.items()}


def commit_state(path: str, document: dict, expected: str | None) -> str:
    """Replaces a state file if it still is what was read (K2, K3): its hash, or None for no file.  Returns the new hash."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    with open(target.with_suffix(".lock"), "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        found = sha256(target.read_bytes()) if target.exists() else None
        if found != expected:
            raise StateConflict(f"{path} has changed since it was read")
        data = canonical(document)
        write_atomic(target, data)
        return sha256(data)


def write_snapshot(df: DataFrame, path: str) -> None:
    """A table as JSON lines; an existing one is an error."""
    df.write.mode("errorifexists").json(path)


def append_history(df: DataFrame, path: str) -> None:
    """Run history as JSON lines, appended."""
    df.write.mode("append").json(path)


def archive(table: DataFrame, run: DataFrame, key: str = "run_id") -> DataFrame:
    """The archive with a run; a run that is there already is an error (K7)."""
    require_empty(run.select(key).join(table.select(key), key, "left_semi"), "runs archived before")
    return table.unionByName(run)


def inventory(spark, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file below a path (K8)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def freeze(df: DataFrame, path: str) -> str:
    """A discovery result for a later run (K15, S18): written once, its content hash returned."""
    df.write.mode("errorifexists").parquet(path)
    each = df.select(F.sha2(F.to_json(F.struct(*df.columns)), 256).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).alias("s")).first()
    return sha256(f"{each['n']}:{each['s']}".encode())


def grouped(ledger: DataFrame, featured: DataFrame) -> DataFrame:
    """The rows of a report (K6): all of each category in display order, with whether they are featured."""
    marked = ledger.join(featured.select("work_id", F.lit(True).alias("featured")), "work_id", "left").fillna({"featured": False})
    return marked.orderBy("category_rank", "category", F.desc("featured"), "display_rank")


def html_report(ledger: DataFrame, featured: DataFrame, title: str, most: int = 100_000) -> bytes:
    """A page with a card per record, its facets as data attributes (K6, K12, X2); more than ``most`` records are an error, none is left out."""
    esc = lambda v: html.escape("" if v is None else str(v), quote=True)
    out, last = [f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{esc(title)}</title></head><body><h1>{esc(title)}</h1>'], None
    for r in rows_of(grouped(ledger, featured), most):
        if r["category"] != last:
            out.append(f"{'</section>' if last is not None else ''}<section data-category=\"{esc(r['category'])}\"><h2>{esc(r['category'])}</h2>")
            last = r["category"]
        facets = {"work-id": r["work_id"], "triage": r.get("triage_status"), "event-class": r.get("event_class"), "oa": r.get("oa_status"), "sources": r.get("sources_piped"), "featured": str(r["featured"]).lower()}
        out.append(f"<article {' '.join(f'data-{k}=\"{esc(v)}\"' for k, v in facets.items())}><h3>{esc(r['title'])}</h3><p>{esc(r.get('venue'))}</p></article>")
    return ("\n".join([*out, "</section>" if last is not None else "", "</body></html>"]) + "\n").encode()


def markdown_report(featured: DataFrame, pool: DataFrame, most: int = 500) -> str:
    """A report of sections per category, and what of the pool isn't featured (K11); rows have category, section, place, title, total_score."""
    rest = pool.join(featured.select("paper_id"), "paper_id", "left_anti")
    out, last = ["# Digest"], None
    for r in rows_of(featured.orderBy("category", "section", "place"), most):
        if (r["category"], r["section"]) != last:
            out += ["", f"## {r['category']} / {r['section']}"]
            last = (r["category"], r["section"])
        out.append(f"{r['place']}. **{r['title']}** ({r['total_score']})")
    out += ["", "## Other candidates", *[f"- {r['title']} ({r['total_score']})" for r in rows_of(rest.orderBy("category", "place"), most)]]
    return "\n".join(out) + "\n"


def coverage_line(papers: DataFrame, column: str = "directions") -> DataFrame:
    """The distinct research directions of a selection."""
    return papers.select(F.explode(column).alias("d")).agg(F.array_join(F.array_sort(F.collect_set("d")), ",").alias("coverage"))


def preflight(staged: DataFrame, authorised: DataFrame) -> None:
    """Staged paths must be exactly the authorised ones."""
    require_empty(parity(staged, authorised, "path"), "staged files differ from the authorised")
