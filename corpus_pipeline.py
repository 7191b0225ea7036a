"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
what a stage returns to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, jaccard_join, line_frequency, mixing, zstd_quality
from paperloom.llm.common import read, spool

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good (score 0.7 or more)."""
    return zstd_quality.keep_good(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars follows the text.

    A document of boilerplate alone keeps its text: such documents are copies, and the next stage leaves one of them.
    """
    cut = line_frequency.drop_boilerplate(docs.withColumn("_whole", F.col("text")))
    cut = cut.withColumn("text", F.when(F.col("all_dropped"), F.col("_whole")).otherwise(F.col("text")))
    less = (F.col("n_dropped") > 0) & ~F.col("all_dropped")
    return cut.withColumn("n_chars", F.when(less, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group with similarity 0.8 or more on shingles of five words."""
    return jaccard_join.one_of_each(docs, shingle=5, percent=80).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated: those with benchmark windows over at least a twentieth of their words go."""
    rows = spool(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")  # ids may be null or repeat
    bad = decontaminate.verdicts(rows, read(spark, sf_dir, "benchmark"), doc_id="_row").where("contaminated").select(F.col("doc_id").alias("_row"))
    return rows.join(spool(bad, "contaminated"), "_row", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream as a plan: one row per document and block, to be read by block and order_key."""
    return mixing.plan(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]

#: SQL has no zstandard; tests hold the pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
