"""Streams over the batch operators: an extension, the batch semantics stay as they are.

A run per trigger (``availableNow``) is what a scheduled run does.  Late events
are kept and classified, so no watermark drops a row on the main path; only the
window counts, which are new here, use one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.operators import events as E
from paperloom.operators import state
from paperloom.streaming.gap_stream import first_only


def read(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def gated(stream: DataFrame, start: datetime, end: datetime, timezone: str = E.TIMEZONE, keep_days: int = 90) -> DataFrame:
    """Rows with an event in the window, and new ids only; an id is remembered for ``keep_days``, longer than a window is."""
    return first_only(E.gate(stream, start, end, timezone), "event_id", keep_days)


def upsert_into(stream: DataFrame, table_path: Callable[[int], str], first: DataFrame, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of works is merged into the state of the batch before it.

    The state of batch n is a table of its own, written once: a batch that is
    repeated after a failure reads the same predecessor and writes the same table again.
    """

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        prior = spark.read.parquet(table_path(batch - 1)) if batch else first
        seen = rows.groupBy("work_id").agg(*[F.max_by(c, "last_seen_at").alias(c) for c in ("title", "category", "access_depth", "oa_status")], F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.sum("seen_count").alias("seen_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("streams")))).alias("streams"))
        state.upsert(prior, seen).write.mode("overwrite").parquet(table_path(batch))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_counts(stream: DataFrame, time: str = "ts", key: str = "event_type", size: str = "1 hour", late: str = "72 hours") -> DataFrame:
    """Events per tumbling window and kind, final once the watermark has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count(F.lit(1)).alias("n"))
