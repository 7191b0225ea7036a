"""Pieces that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.storage import discard, spool

__all__ = ["LOWER", "UPPER", "ascii_lower", "bytes_of", "discard", "fresh", "in_fold", "read", "sampled", "small_batches", "spool", "spread"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else, whatever the locale."""
    return F.translate(col, UPPER, LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is run inside: with Spark's 10,000, a batch of long texts, or of pairs of sets, fills a worker.

    What is only planned inside and run later goes by the session's own setting,
    which is back after.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bytes_of(df: DataFrame, size: Column) -> tuple[int, int]:
    """Rows and summed ``size`` of a spooled table: the check that goes before any broadcast."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def sampled(share: Column, *keys: str | Column) -> Column:
    """Whether a hash of the keys falls into ``share`` (0 to 1), which may be as small as 1e-12: 40 bits of the hash count."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < share * float(1 << 40)


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; ids that are null count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def spread(text: Column, pieces: int, size: int) -> Column:
    """The whole text as one piece if it has at most pieces * size characters, else so many pieces of that size, the first at its start, the last at its end; null for null."""
    step = (F.length(text) - size) / (pieces - 1)
    some = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substr(text, F.floor(i * step).cast("int") + 1, F.lit(size)))
    return F.when(F.length(text) <= pieces * size, F.array(text)).when(text.isNotNull(), some)
