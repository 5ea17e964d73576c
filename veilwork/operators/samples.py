"""Members of shards to samples, pairing of listings, matching of originals, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.functions import text as t


def members(rows: DataFrame) -> DataFrame:
    """key, field, content in long form; a member without a dot goes, of a repeated field the last stays."""
    split = rows.select(t.member_key(F.col("member")).alias("key"), t.member_field(F.col("member")).alias("field"), F.struct("shard", "ordinal").alias("o"), "content")
    return split.where("key is not null").groupBy("key", "field").agg(F.max_by("content", "o").alias("content"))


def grouped(rows: DataFrame) -> DataFrame:
    """key, fields (map), order (field names as members came): one shuffle; of a repeated field the last member stays."""
    member = F.struct(t.member_field(F.col("member")).alias("field"), "shard", "ordinal", "content")
    split = rows.select(t.member_key(F.col("member")).alias("key"), member.alias("m")).where("key is not null")
    every = split.groupBy("key").agg(F.collect_list("m").alias("ms")).withColumn("ms", F.array_sort("ms"))
    last = F.filter("ms", lambda x, i: ~F.coalesce(F.get("ms", i + 1)["field"] == x["field"], F.lit(False)))
    came = F.transform(F.array_sort(F.transform("ms", lambda x: F.struct(x["shard"], x["ordinal"], x["field"].alias("field")))), lambda x: x["field"])
    return every.select("key", F.map_from_entries(F.transform(last, lambda x: F.struct(x["field"], x["content"]))).alias("fields"), F.array_distinct(came).alias("order"))


def samples(rows: DataFrame, required: list[str]) -> DataFrame:
    """key, fields (map), order, meta (json) of samples with valid metadata and all required fields."""
    meta = t.utf8_or_skip(F.col("fields")["json"])
    whole = grouped(rows).select("key", "fields", "order", meta.alias("meta")).where(F.try_parse_json("meta").isNotNull())
    for field in required:
        whole = whole.where(F.map_contains_key("fields", field))
    return whole


def listing(spark, pattern: str, recursive: bool = True) -> DataFrame:
    """Paths of files; only names are read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(pattern).select("path")


def pairs(images: DataFrame, depths: DataFrame) -> DataFrame:
    """image, depth, base: joined on the expected depth name."""
    left = images.select(F.col("path").alias("image"), t.stem(F.col("path")).alias("base"))
    right = depths.select(F.col("path").alias("depth"), t.base(F.col("path")).alias("name"))
    return left.join(right, F.concat("base", F.lit("_depth.png")) == F.col("name")).select("image", "depth", "base")


def match_originals(names: DataFrame, archive: DataFrame, suffixes: tuple[str, ...] = t.ORIGINALS) -> DataFrame:
    """base, path (null if missing): of archive files with one stem and an accepted extension the last path wins."""
    index = archive.where(F.lower(t.suffix(F.col("path"))).isin(*suffixes)).groupBy(t.stem(F.col("path")).alias("base")).agg(F.max("path").alias("path"))
    return names.select("base").distinct().join(index, "base", "left")


def evaluate(files: DataFrame, inputs: DataFrame, scorer) -> tuple[DataFrame, DataFrame]:
    """Scored rows and quarantine. files: task, method, path; inputs: task, path of row_<id>_*; scorer: (input, output) -> reply.

    scorer takes two pandas Series and returns one of replies.
    """
    reply = F.pandas_udf(scorer, "string")
    left = files.where("method <> 'input'").withColumn("id", t.first_digits(t.base(F.col("path"))))
    right = inputs.select("task", F.col("path").alias("input"), F.regexp_extract(t.base(F.col("path")), r"^row_(\d+)_", 1).alias("id")).groupBy("task", "id").agg(F.min("input").alias("input"))
    asked = left.join(right, ["task", "id"], "left").withColumn("score", t.score(F.when(F.col("input").isNotNull(), reply("input", "path"))))
    label = F.concat(t.base(F.col("input")), F.lit(" vs "), F.col("method")).alias("image_pair")
    return asked.where("score is not null").select("task", "method", label, F.col("score").alias("removal_pct")), asked.where("score is null").select("task", "method", "path", "input")


def evaluation_tree(paths: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """files and inputs for evaluate() from the paths (column path) of root/task/method/file; only .png and .jpg count.

    A task without a folder `input`, and a method's folder without files, have no rows.
    """
    parts = F.split(t.relative(F.col("path"), F.lit(root.rstrip("/") + "/")), "/")
    found = paths.select("path", parts.alias("p")).where((F.size("p") == 3) & F.col("path").rlike(r"\.(png|jpg)$"))
    found = found.select(F.col("p")[0].alias("task"), F.col("p")[1].alias("method"), "path")
    inputs = found.where("method = 'input'").select("task", "path")
    return found.where("method <> 'input'").join(inputs.select("task").distinct(), "task", "left_semi"), inputs


def summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("task", "method").agg(F.avg("removal_pct").alias("removal_pct")).orderBy("task", "method")
