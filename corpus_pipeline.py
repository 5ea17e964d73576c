"""A training-data pipeline of five stages over the documents table.

Language ID (rejected documents go), line dedup, SimHash near-dedup (the smallest doc_id of each group stays), removal of
repeated passages, packing. Each stage works on all that the one before kept; all but the last return the columns of
documents, with n_chars as the text's length then. `run` writes each stage's result as Parquet to the folder that
spark.checkpoint.dir names and reads it again, so that each stage is computed once; a stage's result is deleted when the
next one is written, but for the packing's input, which stays for as long as its rows are read.

Cases, for each stage: null and empty texts (language ID rejects them, the others keep them as they are; packing gives
them their end token), a null doc_id, source or lang (kept), repeated rows and ids (each treated by itself), texts of
many megabytes, further columns (dropped), and empty tables (no rows).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm import common, language_id, line_dedup, packing, repeat_removal, simhash_dedup

#: Near copies of a line are those within so many edits.
LINE_EDITS = 2
#: Near copies of a document have fingerprints of shingles of so many words that differ in at most so many of 64 bits.
SHINGLE, BITS = 5, 4
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a wide enough margin, unchanged; a null text or one without letters goes."""
    found = language_id.classify(docs, language_id.fit(docs), COLUMNS, keep_text=True)
    return found.where("accepted").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that equal or nearly equal an earlier one; a null text stays null."""
    return _columns(line_dedup.dedup_lines(docs, ["lang", "source"], most=LINE_EDITS, exact_chars=1))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id; texts without words are copies of each other."""
    groups = simhash_dedup.near_duplicates(docs, SHINGLE, BITS)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes in strings of 200 bytes that occur again; a null text becomes the empty one."""
    return _columns(repeat_removal.remove_repeats(docs, carry=["lang", "source"]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_copies), ("suffix_array_dedup", repeats), ("packing", packed)]

#: Several stages have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{common.checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        common.release()
        if before:
            common.delete(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return STAGES[-1][1](spark, docs, sf_dir)
