"""Session helpers shared by the bench, the tests and the examples."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "paperloom", **extra: str) -> SparkSession:
    """A single-JVM session with the settings the engine expects of a cluster."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("PAPERLOOM_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``; the path may be any Hadoop URI."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
