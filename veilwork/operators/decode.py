"""Samples (key, fields, order, meta of operators.samples) decoded to their images, variants and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions import text as t
from veilwork.functions.rand import shuffle_key


def last_part(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def told(meta: str, name: str, default: Column) -> Column:
    """A metadata value as text, with a default."""
    return F.coalesce(F.get_json_object(meta, f"$.{name}"), default)


def first_original(order: str = "order") -> Column:
    """The first field gt.* as members came; null if there is none."""
    return F.get(F.filter(order, lambda x: F.startswith(x, F.lit("gt."))), F.lit(0))


def variants(samples: DataFrame) -> DataFrame:
    """key, source, base_name, gt_field, gt, variants (field, tag, data by field name) of samples with a variant.

    A variant is a field haze_*.png; its tag is the text of the field of that name in .txt, without bytes that aren't
    UTF-8, or empty. source and base_name come from the metadata, else UNKNOWN and the key's last part.
    """
    names = F.array_sort(F.filter(F.map_keys("fields"), lambda x: F.startswith(x, F.lit("haze_")) & F.endswith(x, F.lit(".png"))))
    tag = lambda x: F.coalesce(t.utf8_or_skip(F.col("fields")[F.replace(x, F.lit(".png"), F.lit(".txt"))]), F.lit(""))
    one = F.transform(names, lambda x: F.struct(x.alias("field"), tag(x).alias("tag"), F.col("fields")[x].alias("data")))
    rows = samples.select("key", "meta", "fields", first_original().alias("gt_field"), one.alias("variants")).where(F.size("variants") > 0)
    return rows.select("key", told("meta", "source", F.lit("UNKNOWN")).alias("source"), told("meta", "base_name", last_part(F.col("key"))).alias("base_name"), "gt_field", F.col("fields")[F.col("gt_field")].alias("gt"), "variants")


def exploded(decoded: DataFrame) -> DataFrame:
    """A row per variant: key, source, base_name, field, tag, data."""
    return decoded.select("key", "source", "base_name", F.explode("variants").alias("v")).select("key", "source", "base_name", "v.*")


def one_variant(decoded: DataFrame, seed: int = 42) -> DataFrame:
    """variants() with one of them for each sample, by keyed draw, as columns field, tag, data."""
    mixed = F.array_sort(F.transform("variants", lambda v: F.struct(F.md5(F.concat(F.lit(f"{seed}|"), "key", F.lit("|"), v["field"])).alias("o"), v.alias("v"))))
    return decoded.withColumn("v", F.get(mixed, F.lit(0))["v"]).drop("variants").select("key", "source", "base_name", "gt_field", "gt", "v.*")


def triplets(samples: DataFrame, complete: bool = True) -> DataFrame:
    """key, effect_type, effect_id, scene, base_name, gt, flare, separate; complete: only samples that have all three images."""
    need = ("gt.png", "flare.png", "separate.png")
    rows = samples.where(F.forall(F.array(*map(F.lit, need)), lambda x: F.map_contains_key("fields", x))) if complete else samples
    named = [told("meta", name, F.lit("Unknown")).alias(name) for name in ("effect_type", "effect_id", "scene")]
    return rows.select("key", *named, told("meta", "base_name", last_part(F.col("key"))).alias("base_name"), *(F.col("fields")[x].alias(x.removesuffix(".png")) for x in need))


def shuffled(samples: DataFrame, seed: int = 42) -> DataFrame:
    """Samples in a keyed random order: stands for shuffles of shards and of a buffer."""
    return samples.orderBy(shuffle_key(seed, "key"), "key")
