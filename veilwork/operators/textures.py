"""Smoke textures: a table of drawn parameters, and their rendering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilwork.functions.rand import between, shuffle_key, uniform
from veilwork.operators import kernels

#: The ranges of the drawn parameters, both ends included for whole numbers.
REAL = {"base_scale": (180.0, 500.0), "angle_scale": (350.0, 550.0), "blur_length": (1.0, 2.0), "blend": (0.3, 0.7)}
WHOLE = {"base_octaves": (5, 7), "angle_octaves": (3, 5), "blur_steps": (15, 35)}


def tasks(spark: SparkSession, n: int = 2000, seed: int = 42) -> DataFrame:
    """number, path, blurred (half of them, at random), noise_seed and a column per parameter.

    The rank that halves the rows needs all numbers in one task: a row of two numbers per texture.
    """
    real = {k: between(a, b, seed, "number", F.lit(k)) for k, (a, b) in REAL.items()}
    whole = {k: (F.lit(a) + F.floor(uniform(seed, "number", F.lit(k)) * (b - a + 1))).cast("int") for k, (a, b) in WHOLE.items()}
    place = F.row_number().over(Window.orderBy(shuffle_key(seed, "number", F.lit("blurred")), "number"))
    rows = spark.range(1, n + 1).withColumnRenamed("id", "number").withColumn("blurred", place <= n // 2).repartition(F.col("number"))
    path = F.concat(F.format_string("smoke_%04d_", "number"), F.when(F.col("blurred"), "pathblur.png").otherwise("base.png"))
    return rows.withColumns({"path": path, "noise_seed": F.floor(uniform(seed, "number", F.lit("noise")) * 128).cast("int"), **real, **whole})


def texture(row: dict, width: int, height: int) -> np.ndarray:
    first = kernels.normalise(kernels.gradient_noise(width, height, row["base_scale"], row["base_octaves"], row["noise_seed"]))
    if not row["blurred"]:
        return first
    dx, dy = kernels.vector_field(width, height, row["angle_scale"], row["angle_octaves"], row["noise_seed"] + 1)
    moved = np.floor(np.clip(kernels.advect(first, dx, dy, row["blur_steps"], row["blur_length"]), 0, 255))
    return np.clip(moved * row["blend"] + first * (1.0 - row["blend"]), 0, 255).astype(np.uint8)


def render(rows: DataFrame, width: int = 2048, height: int = 2048) -> DataFrame:
    """path, data (PNG) of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), pa.array([kernels.png(texture(row, width, height))], pa.binary())], ["path", "data"])

    return rows.mapInArrow(run, "path string, data binary")
