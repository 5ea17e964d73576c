"""Session builder with the settings that the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(cores: int | None = None, partitions: int | None = None, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session; on a cluster, apply SETTINGS to the session that is given."""
    cores = cores or os.cpu_count() or 1
    builder = SparkSession.builder.master(f"local[{cores}]").appName("veilwork").config("spark.driver.memory", memory)
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(partitions or cores)} | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's tables; a parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
