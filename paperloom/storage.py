"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it names none, a temporary folder in local mode (tests), else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="paperloom-"))


def spool(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/paperloom-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spooled_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``spool`` returned and that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._spooled_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
