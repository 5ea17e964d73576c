"""Manifests of a release, listings of textures, and plans that put matched files in place."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions import text as t

#: Modes of a plan (fixed values).
MODES = ("symlink", "hardlink", "copy")
#: Extensions of textures (fixed values).
TEXTURES = (".png", ".jpg", ".jpeg")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON list of objects with a declared schema; what the schema lacks is left out."""
    return spark.read.schema(schema).json(path, multiLine=True)


def with_finalists(samples: DataFrame, finalists: DataFrame) -> DataFrame:
    """Samples (key, meta) with the finalist record of their metadata's final_idx."""
    return samples.withColumn("final_idx", F.get_json_object("meta", "$.final_idx").try_cast("long")).join(finalists, "final_idx")


def textures(paths: DataFrame, folder: str) -> DataFrame:
    """path of images directly in a folder, sorted; no rows if there are none."""
    own = t.relative(F.col("path"), F.lit(folder.rstrip("/") + "/"))
    return paths.where(F.col("path").startswith(folder.rstrip("/") + "/") & ~F.contains(own, F.lit("/")) & F.lower(t.suffix(F.col("path"))).isin(*TEXTURES)).select("path").orderBy("path")


def link_plan(matched: DataFrame, folder: str, mode: str = "symlink") -> DataFrame:
    """src, dst, mode of matched originals (base, path): dst is the base name with the source's extension in the folder."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    name = F.concat(F.lit(folder.rstrip("/") + "/"), "base", F.lower(t.suffix(F.col("path"))))
    return matched.where("path is not null").select(F.col("path").alias("src"), name.alias("dst"), F.lit(mode).alias("mode"))


def put_in_place(plan: DataFrame) -> DataFrame:
    """Carries out a plan on a file system that all executors share: dst and error (null if done). What stands at dst is replaced."""

    def run(frames):
        for frame in frames:
            frame["error"] = [placed(*row) for row in frame[["src", "dst", "mode"]].itertuples(index=False)]
            yield frame[["dst", "error"]]

    return plan.select("src", "dst", "mode").mapInPandas(run, "dst string, error string")


def placed(src: str, dst: str, mode: str) -> str | None:
    src, dst = src.removeprefix("file:"), dst.removeprefix("file:")
    part = f"{dst}.part"
    try:
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        if os.path.lexists(part):
            os.unlink(part)
        {"symlink": os.symlink, "hardlink": os.link, "copy": shutil.copyfile}[mode](os.path.abspath(src), part)
        os.replace(part, dst)
    except OSError as failure:
        return str(failure)
    return None
