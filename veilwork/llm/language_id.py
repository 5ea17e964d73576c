"""Language identification by compression.

Texts are lower-cased. For each language a raw-content zstandard dictionary is filled with sample texts of it. A text is cut into blocks of
equal length (at most `BLOCK` bytes, and four where they hold `SHORT` bytes each), each block is compressed once with each
dictionary and once without one, and the language whose blocks are smallest in sum wins. Its margin is what the next best
(another language, or no dictionary) needs more, less twice what single blocks save with their own best instead of the
winner, both relative to the winner's compressed size. The score is margin / (margin + `HALF`), 0 for none; a text whose
score stays under the limit is rejected. A limit of 0.3 is a margin of 3%, whatever the text's length and the number of
languages. Ties, junk (which no dictionary shortens) and texts of two languages (whose blocks disagree) have none or less.

The dictionaries are fitted on a bounded sample: at most `rows_per_language` labelled rows of each language, those whose
hash of doc_id is smallest, and `dictionary_bytes` of their text. Each row gives an equal share of that (at most
`most_chars`), in `slices` slices from hashed places of its whole text, so that neither starts of texts nor headers fill a
dictionary. `most_languages` can keep the most frequent languages only (ties by name); by default all are learned. Whole
texts are classified, block by block: a very long text needs memory for itself and its sizes.

Cases: a null text, or one without a letter, is "und" with score 0 and rejected. With no labelled row every text is
"und". Rows without doc_id, lang or text train nothing. Equal texts get equal results, each row its own. lang, source
and doc_id are not inputs of a prediction. Columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilwork.llm.common import documents, kept, text_batches

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
HALF = 0.07
BLOCK = 1024
SHORT = 100
LEVEL = 9


def remainder(doc_id: str = "doc_id", parts: int = 4):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def fit(docs: DataFrame, held_out: int = 2, rows_per_language: int = 240, most_languages: int | None = None, dictionary_bytes: int = 96_000, most_chars: int = 4000, slices: int = 4) -> dict[str, bytes]:
    """Raw dictionary contents by language, from rows whose crc32(doc_id) mod 4 is not `held_out`. All bounds are parameters."""
    known = docs.where("doc_id is not null and lang is not null and text is not null").where(remainder() != held_out).select("lang", "doc_id", "text")
    if most_languages is not None:
        known = known.join(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).select("lang"), "lang", "left_semi")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("lang", "doc_id").withColumn("k", F.row_number().over(first)).where(F.col("k") <= rows_per_language).select("lang", "doc_id").distinct()
    ids = ids.withColumn("rows", F.count("*").over(Window.partitionBy("lang")))
    low, size = F.col("low"), F.col("size")
    room = F.greatest(F.char_length("low") - size + 1, F.lit(1))
    places = [F.substring(low, (F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int"), size) for k in range(slices)]
    share = F.least(F.lit(most_chars), F.greatest(F.floor(F.lit(dictionary_bytes) / F.col("rows")), F.lit(64)))
    # the sample's ids, at most rows_per_language of each language, so that no text is shuffled
    rows = known.join(F.broadcast(ids), ["lang", "doc_id"]).withColumns({"low": F.lower("text"), "size": F.ceil(share / slices).cast("int")})
    taken = F.when(F.char_length("low") <= size * slices, F.array("low")).otherwise(F.array(*places))
    out: dict[str, list[bytes]] = {}
    for lang, _, parts in sorted((tuple(r) for r in rows.select("lang", "doc_id", taken).collect()), key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(lang, []).append("\n".join(parts).encode())
    return {k: b"\n".join(v)[:dictionary_bytes] for k, v in out.items()}


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        self.names = sorted(contents)
        self.coders = []
        for name in self.names:
            raw = zstandard.ZstdCompressionDict(contents[name] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False))

        self.coders.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[list[int]]:
        """For each block its compressed size by language, and last that without a dictionary."""
        n = max(-(-len(data) // BLOCK), min(4, len(data) // SHORT), 1)
        step = -(-len(data) // n)
        return [[len(coder.compress(data[k : k + step])) for coder in self.coders] for k in range(0, len(data), step)]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; of equal sizes the first name wins."""
        if not text or not self.names or not LETTER.search(text):
            return UNKNOWN, 0.0
        blocks = self.sizes(text.lower().encode())
        *sizes, plain = map(sum, zip(*blocks))
        best = min(sizes)
        won = sizes.index(best)
        against = sum(x[won] - min(x) for x in blocks)
        margin = max(min([*sizes[:won], *sizes[won + 1 :], plain]) - best - 2 * against, 0) / best
        return self.names[won], margin / (margin + HALF)


def classify(docs: DataFrame, contents: dict[str, bytes], carry: list[str], least_score: float = 0.3, keep_text: bool = False) -> DataFrame:
    """The carried columns of docs (with keep_text the text is one of them), and lang_pred, score, accepted. Null or letterless texts and narrow margins aren't accepted."""
    docs = text_batches(docs)
    key = hash(tuple(sorted(contents.items())))
    at = carry.index("text") if keep_text else len(carry)
    rows = docs.select(*carry) if keep_text else docs.select(*carry, F.col("text").alias("__text"))
    names = [*carry, "lang_pred", "score", "accepted"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(("language", key), lambda: Classifier(contents))
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(at)]
            added = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[0] != UNKNOWN and x[1] >= least_score for x in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], *added], names)

    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, accepted boolean")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = classify(docs, fit(docs), ["doc_id"])
    return found.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
