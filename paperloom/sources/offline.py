"""A Spark data source of stored provider payloads.

A store is a folder of ``<source>/<query_id>@<day>.json`` (or .xml) files, each
what a provider answered.  ``spark.read.format("payloads").option("path", p).load()``
gives (source, query_id, fetched_on, body, attempts, fault).  The options ``source``, ``since``
and ``until`` skip files before they are opened.  They are options, not pushed
filters: Spark 4.1 keeps what a Python source has pushed for every later scan of
the same relation.  Files are packed into partitions by size.  They are local to executors or on a shared mount; from
object stores ``read_store`` reads the same layout with Spark's own reader.

A read is tried so many times, with growing pauses, and never beyond a number of
bytes.  What fails for good is a row with its error class and no body, not a
failed task; with ``mode`` FAILFAST it is an error.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class TooLarge(ValueError):
    """More bytes than a payload may have."""


def open_local(path: str, most: int) -> bytes:
    """At most ``most`` + 1 bytes of a file."""
    with open(path, "rb") as f:
        return f.read(most + 1)


@dataclass(frozen=True)
class Patience:
    """How a payload is fetched: bytes at most, attempts, and the pause after the first failure, doubled after each."""

    most_bytes: int = 8 << 20
    attempts: int = 3
    pause: float = 1.0

    @classmethod
    def of(cls, options: dict[str, str]) -> Patience:
        return cls(int(options.get("maxBytes", 8 << 20)), int(options.get("attempts", 3)), float(options.get("pauseSeconds", 1)))

    def fetch(self, opener: Callable[[str, int], bytes], path: str) -> tuple[str | None, int, str | None]:
        """(text, attempts made, fault): the fault is the class of the last error, null if the text is there."""
        fault = None
        for n in range(1, self.attempts + 1):
            try:
                raw = opener(path, self.most_bytes)
                if len(raw) > self.most_bytes:
                    raise TooLarge(path)
                return raw.decode("utf-8"), n, None
            except (OSError, ValueError) as error:
                fault = type(error).__name__
            if n < self.attempts:
                time.sleep(self.pause * 2 ** (n - 1))
        return None, self.attempts, fault


def packed(sized: list[tuple[int, object]], most: int) -> list[list]:
    """Items, in order, in lists of at most ``most`` bytes or one item; an item counts for 64 KB at least."""
    out, room = [], 0
    for size, item in sized:
        cost = max(size, 1 << 16)
        if not out or cost > room:
            out.append([])
            room = most
        out[-1].append(item)
        room -= cost
    return out


class PayloadPartition(InputPartition):
    def __init__(self, files: list[tuple[str, str, str, str]]):
        self.files = files


class PayloadReader(DataSourceReader):
    def __init__(self, opener: Callable[[str, int], bytes], options: dict[str, str]):
        self.opener, self.patience, self.path = opener, Patience.of(options), options["path"]
        self.source, self.since, self.until = options.get("source"), options.get("since", ""), options.get("until", "9999")
        self.strict, self.most = options.get("mode", "PERMISSIVE").upper() == "FAILFAST", int(options.get("partitionBytes", 32 << 20))

    def partitions(self):
        sized = []
        for source in sorted(os.listdir(self.path)):
            if self.source not in (None, source):
                continue
            with os.scandir(os.path.join(self.path, source)) as files:
                for f in sorted(files, key=lambda f: f.name):
                    query, _, day = f.name.rsplit(".", 1)[0].partition("@")
                    if f.is_file() and self.since <= day <= self.until:
                        sized.append((f.stat().st_size, (source, query, day, f.path)))
        return [PayloadPartition(files) for files in packed(sized, self.most)] or [PayloadPartition([])]

    def read(self, partition):
        for source, query, day, path in partition.files:
            body, attempts, fault = self.patience.fetch(self.opener, path)
            if fault and self.strict:
                raise ValueError(f"{fault}: {path}")
            yield source, query, day, body, attempts, fault


class PayloadSource(DataSource):
    """Short name ``payloads``.

    Options: ``path``, ``maxBytes`` (8 MiB), ``attempts`` (3), ``pauseSeconds`` (1), ``mode`` (PERMISSIVE), ``partitionBytes``
    (32 MiB), ``source``, ``since`` and ``until`` (ISO days, both included).  A subclass may open payloads in another way.
    """

    opener = staticmethod(open_local)

    @classmethod
    def name(cls):
        return "payloads"

    def schema(self):
        return "source string, query_id string, fetched_on string, body string, attempts int, fault string"

    def reader(self, schema):
        return PayloadReader(self.opener, self.options)


def register(spark: SparkSession) -> None:
    from paperloom.sources.chains import ChainSource

    spark.dataSource.register(PayloadSource)
    spark.dataSource.register(ChainSource)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The same table by Spark's own reader, from any file system."""
    files = spark.read.text(f"{path}/*/*", wholetext=True).select(F.input_file_name().alias("p"), F.col("value").alias("body"))
    name = F.regexp_extract("p", r"/([^/]+)\.[^./]+$", 1)
    return files.select(F.regexp_extract("p", r"/([^/]+)/[^/]+$", 1).alias("source"), F.substring_index(F.url_decode(name), "@", 1).alias("query_id"), F.when(F.contains(F.url_decode(name), F.lit("@")), F.substring_index(F.url_decode(name), "@", -1)).otherwise("").alias("fetched_on"), "body")


def read_state(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, fingerprints) of stored state documents (S18, S19, S20): rows of strict documents only, and the hash of each file."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    good = raw.where(F.try_parse_json("value").isNotNull())
    rows = good.select(F.from_json("value", schema).alias("d")).select("d.*")
    return rows, raw.select("path", F.sha2("value", 256).alias("sha256"), F.try_parse_json("value").isNotNull().alias("valid"))
