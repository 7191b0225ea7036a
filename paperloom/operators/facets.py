"""The interactive view: facets of a record, and a filter over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.schema import strings, text_of


def with_facets(ledger: DataFrame) -> DataFrame:
    """Adds the search text and the piped lists that the report carries per record (X2), and whether it is featured."""
    blob = F.lower(F.concat_ws(" ", "title", "venue", F.array_join(strings(F.col("authors")), " "), "doi"))
    rows = ledger.withColumns({"search": text_of(blob), "sources_piped": F.array_join(strings(F.col("observed_sources")), "|"), "studies_piped": F.array_join(strings(F.col("study_designs")), "|")})
    return rows if "featured" in ledger.columns else rows.withColumn("featured", F.lit(False))


def facet_filter(records: DataFrame, search: str = "", source: str = "", study: str = "", **equal: str) -> DataFrame:
    """Records that fit every facet given (X1): equality on columns, membership in piped lists, and a part of the search text."""
    out = records
    for column, value in equal.items():
        out = out.where(F.col(column) == value) if value else out
    if source:
        out = out.where(F.array_contains(F.split("sources_piped", r"\|"), source))
    if study:
        out = out.where(F.array_contains(F.split("studies_piped", r"\|"), study))
    return out.where(F.contains("search", F.lit(search.lower().strip()))) if search.strip() else out


def facet_counts(records: DataFrame, column: str = "category") -> DataFrame:
    """Visible records per value."""
    return records.groupBy(column).agg(F.count(F.lit(1)).alias("visible"))
