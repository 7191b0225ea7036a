"""Reports of any length: executors render the cards, a part for each range of a category; the driver writes the frame.

A part holds at most ``PER_PART`` cards, so it is one bounded row before it is a
file.  Its name, place and digest are in the manifest, a table beside the parts;
the root of the digest tree over it stands for the whole report.  Frame and parts,
one after the other, are the bytes of ``report.html_report``.
"""

from __future__ import annotations

import html
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import digests
from paperloom.schema import text_of
from paperloom.storage import spool

PER_PART = 500

#: Data attributes of a card and the ledger's columns behind them; columns that a ledger lacks are empty.
FACETS = {"work-id": "work_id", "triage": "triage_status", "event-class": "event_class", "oa": "oa_status", "sources": "sources_piped", "featured": "featured"}


def escaped(col: Column) -> Column:
    """Text for HTML, as ``html.escape`` writes it."""
    out = text_of(col.cast("string"))
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


def card(columns: list[str]) -> Column:
    of = lambda c: escaped(F.col(c)) if c in columns else F.lit("")
    facets = [F.concat(F.lit(f'data-{k}="'), of(c), F.lit('"')) for k, c in FACETS.items()]
    return F.concat(F.lit("<article "), F.concat_ws(" ", *facets), F.lit("><h3>"), of("title"), F.lit("</h3><p>"), of("venue"), F.lit("</p></article>"))


def parts(ledger: DataFrame, featured: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """(part, category, n_cards, body, sha256): the report's cards in display order, in parts numbered from 0.

    Cards are numbered by ranges of their order (``digests.numbered``), so a category of any size is rendered by many
    tasks.  A work that is featured comes before those of its category that aren't; a null category is the empty one.
    """
    rows = ledger.withColumn("category", text_of(F.col("category"))).join(featured.select("work_id", F.lit(True).alias("featured")).distinct(), "work_id", "left").fillna({"featured": False})
    rows = rows.select("category_rank", "category", F.when(F.col("featured"), 0).otherwise(1).alias("_second"), F.coalesce("display_rank", F.lit(1 << 30)).alias("display_rank"), "work_id", card(rows.columns).alias("card"))
    placed = spool(digests.numbered(rows, "category_rank", "category", "_second", "display_rank", "work_id"), "cards")
    first = placed.groupBy("category_rank", "category").agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    dealt = placed.join(spool(first, "categories").withColumnRenamed("category_rank", "_rank").withColumnRenamed("category", "_category"), F.col("category_rank").eqNullSafe(F.col("_rank")) & (F.col("category") == F.col("_category")))
    block = F.floor((F.col("place") - F.col("_first")) / per_part).alias("_block")
    bodies = dealt.groupBy("category_rank", "category", "_first", "_n", block).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "card"))), lambda x: x["card"]), "\n").alias("_cards"), F.count(F.lit(1)).alias("n_cards"))
    head = F.concat(F.when(F.col("_first") > 0, "</section>").otherwise(""), F.lit('<section data-category="'), escaped(F.col("category")), F.lit('"><h2>'), escaped(F.col("category")), F.lit("</h2>\n"))
    ends = ((F.col("_block") + 1) * per_part >= F.col("_n")) & (F.col("_first") + F.col("_n") == placed.count())
    body = F.concat(F.when(F.col("_block") == 0, head).otherwise(""), "_cards", F.when(ends, F.lit("\n</section>")).otherwise(""))
    named = bodies.select((F.col("_first") + F.col("_block") * per_part).alias("_at"), "category", "n_cards", body.alias("body"))
    return digests.numbered(named, "_at", name="part").select("part", "category", "n_cards", "body", F.sha2("body", 256).alias("sha256"))


def frame(title: str) -> tuple[str, str]:
    """What stands before the parts, and after them."""
    t = html.escape(title, quote=True)
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{t}</title></head><body><h1>{t}</h1>\n', "</body></html>\n"


def write_pages(ledger: DataFrame, featured: DataFrame, title: str, path: str, per_part: int = PER_PART) -> str | None:
    """Writes parts/part=n/*.txt and manifest/ below ``path`` by Spark; returns the report's root digest, None if it has no cards.

    Equal ledgers give equal parts, manifests and roots.
    """
    made = spool(parts(ledger, featured, per_part), "pages")
    made.select("part", "body").repartition("part").write.mode("errorifexists").partitionBy("part").text(f"{path}/parts")
    manifest = made.select("part", "category", "n_cards", F.octet_length("body").alias("bytes"), "sha256")
    manifest.write.mode("errorifexists").parquet(f"{path}/manifest")
    return digests.root(digests.tree(manifest.withColumn("title", F.lit(title)), "part", "sha256", "title"))


def broken_parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts that aren't what the manifest says, or aren't there: (part, found)."""
    manifest = spark.read.parquet(f"{path}/manifest")
    text = spark.read.text(f"{path}/parts", wholetext=True).groupBy("part").agg(F.max("value").alias("v"))
    found = text.select(F.col("part").cast("long").alias("part"), F.sha2(F.expr("left(v, length(v) - 1)"), 256).alias("found"))  # the writer ends a file with a line break
    return manifest.join(found, "part", "full_outer").where("NOT sha256 <=> found").select("part", "found")


def assemble(spark: SparkSession, path: str, title: str, target: str) -> int:
    """One file from the parts, for readers that need one: streamed through the driver a part at a time; returns its bytes."""
    head, tail = frame(title)
    rows = spark.read.text(f"{path}/parts", wholetext=True).withColumn("part", F.col("part").cast("long")).orderBy("part").select("value")
    staged = Path(target).with_suffix(".staged")
    with open(staged, "wb") as f:
        size = f.write(head.encode())
        for r in rows.toLocalIterator():
            size += f.write(r["value"].encode())
        size += f.write(tail.encode())
    staged.replace(target)
    return size
