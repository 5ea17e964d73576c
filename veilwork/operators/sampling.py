"""Stratified allocation, picks per stratum, diverse picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilwork.functions.rand import shuffle_key


def allocation(rows: DataFrame, stratum: str, total: int, least: int) -> DataFrame:
    """stratum, n, alloc: at least `least` each, the rest by square root of size and largest remainder, capped by size.

    One row per stratum after the count, so the windows over all strata are small whatever the input's size.
    """
    every = Window.partitionBy(F.lit(1))
    n = rows.groupBy(stratum).agg(F.count("*").alias("n"))
    n = n.withColumn("floor", F.least(F.lit(least).cast("long"), "n")).withColumn("w", F.sqrt(F.col("n").cast("double")))
    n = n.withColumn("rest", F.greatest(F.lit(0).cast("long"), F.lit(total) - F.sum("floor").over(every)))
    n = n.withColumn("raw", F.col("rest") * F.col("w") / F.sum("w").over(every)).withColumn("f", F.floor("raw").cast("long"))
    n = n.withColumn("left", F.col("rest") - F.sum("f").over(every))
    n = n.withColumn("k", F.row_number().over(every.orderBy(F.desc(F.col("raw") - F.col("f")), stratum)))
    more = F.col("f") + F.when(F.col("k") <= F.col("left"), 1).otherwise(0)
    return n.select(stratum, "n", F.least(F.col("floor") + F.when(F.col("rest") > 0, more).otherwise(0), "n").cast("long").alias("alloc"))


def pick(rows: DataFrame, stratum: str, key: str, allocated: DataFrame, seed: int = 42) -> DataFrame:
    """As many rows of each stratum as allocated, by keyed shuffle."""
    order = Window.partitionBy(stratum).orderBy(shuffle_key(seed, key), key)
    return rows.withColumn("k", F.row_number().over(order)).join(allocated.select(stratum, "alloc"), stratum).where("k <= alloc").drop("k", "alloc")


def pick_k(rows: DataFrame, stratum: str, key: str, k: int, seed: int = 42) -> DataFrame:
    order = Window.partitionBy(stratum).orderBy(shuffle_key(seed, key), key)
    return rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= k).drop("k")


def diverse(rows: DataFrame, sample: str, bucket: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Up to n rows per sample: one of each bucket first, then others."""
    mixed = rows.withColumn("o", shuffle_key(seed, key))
    r = mixed.withColumn("r", F.row_number().over(Window.partitionBy(sample, bucket).orderBy("o", key)))
    place = Window.partitionBy(sample).orderBy((F.col("r") > 1).cast("int"), "o", key)
    return r.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n).drop("o", "r")
