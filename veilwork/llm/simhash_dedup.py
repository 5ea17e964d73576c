"""SimHash near-dedup with a byte-position inverted index and count filtering.

A fingerprint has eight bytes at eight positions. Two that differ in at most four bits share at least four positional
bytes. Of the 56 sets of three positions, twenty meet every set of four in a subset (checked when the module loads), so
the index lists each distinct fingerprint under its bytes at each of these twenty, and every pair in question meets in
at least one list. For a pair in a list the shared positional bytes are tallied; pairs under the guaranteed minimum of
four go, the rest are verified by their differing bits. Equal texts and equal fingerprints are one entry of the index.
Lists with one entry go before any pair is looked at; long lists are dealt over pairs of tiles of bounded size. Tasks
emit a spanning forest of the links they find, never the pairs.

Cases: a null text is the empty one. A text without words has fingerprint zero and is linked like any other. Equal rows
are returned each by itself. A null doc_id gets its component from the others. An empty table gives no rows. Columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm.common import blocks, components, documents, forest, stored, text_batches

SEED = 42
LEAST_SHARED = 4


def cover(positions: int = 8, least: int = LEAST_SHARED, taken: int = 3) -> list[tuple[int, ...]]:
    """Sets of `taken` positions such that each set of `least` positions contains one.

    Positions are dealt into three classes around a circle; a set of three is taken if it lies in one class, or has two
    in one class and one in the next.
    """
    kind = [k % 3 for k in range(positions)]

    def fits(s: tuple[int, ...]) -> bool:
        n = [sum(kind[p] == c for p in s) for c in range(3)]
        return 3 in n or any(n[c] == 2 and n[(c + 1) % 3] == 1 for c in range(3))

    return [s for s in combinations(range(positions), taken) if fits(s)]


TRIPLES = cover()
assert all(any(set(t) <= set(s) for t in TRIPLES) for s in combinations(range(8), LEAST_SHARED))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash; a bit is set if it is in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    seen = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    count = np.zeros(64, np.int64)
    for at in range(0, len(seen), 1 << 15):
        count += np.unpackbits(seen[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return text_batches(docs).selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def near(a: np.ndarray, b: np.ndarray, most_bits: int) -> np.ndarray:
    """Count filter, then verification: which pairs share enough positional bytes and differ in few enough bits."""
    differ = a ^ b
    shared = np.zeros(len(differ), np.uint8)
    for p in range(8):
        shared += (differ >> np.uint64(8 * p)) & np.uint64(255) == 0
    left = np.flatnonzero(shared >= 8 - most_bits)
    out = np.zeros(len(differ), bool)
    out[left] = np.bitwise_count(differ[left]) <= most_bits
    return out


def list_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (rows a, b) of the links within groups of sorted rows. Side 0: all pairs; else only 1 against 2."""
    n = len(fp)
    root = np.arange(n)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    place = np.arange(n) - np.repeat(first, size)
    room = np.repeat(size, size) - place  # rows of the group from this one on
    for step in range(1, int(size.max(initial=0))):
        a = np.flatnonzero(room > step)
        b = a + step
        pick = (root[a] != root[b]) & ((side[a] == 0) | (side[a] != side[b]))
        a, b = a[pick], b[pick]
        hit = near(fp[a], fp[b], most_bits)
        if hit.any():
            rows = np.arange(n)
            root = forest(n, np.concatenate([a[hit], rows]), np.concatenate([b[hit], root]))
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def links(fps: DataFrame, most_bits: int = 4, tile: int = 2048) -> DataFrame:
    """a, b: a spanning forest of the links between the distinct fingerprints of column fp."""
    if most_bits > 8 - LEAST_SHARED:
        raise ValueError("the index guarantees matches for at most four bits")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [F.lit(k << 24) + byte[x] * 65536 + byte[y] * 256 + byte[z] for k, (x, y, z) in enumerate(TRIPLES)]
    index = fps.select("fp").select("fp", F.explode(F.array(*keys)).alias("key"))
    size = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = index.join(size, "key").withColumn("tiles", tiles).withColumn("own", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    part = dealt.select("fp", "own", "o", F.xxhash64("key", F.least("own", "o"), F.greatest("own", "o")).alias("g"))
    side = F.when(F.col("own") == F.col("o"), 0)
    # rows of tile pair (i, i) compare among themselves; of (i, j) those of i against those of j
    part = part.select("g", "fp", F.coalesce(side, F.when(F.col("own") < F.col("o"), 1).otherwise(2)).cast("int").alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "g"):
            g, fp, side = (table.column(k).to_numpy() for k in ("g", "fp", "side"))
            a, b = list_links(fp.view(np.uint64), g, side, most_bits)
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

    return part.repartition("g").sortWithinPartitions("g").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, most_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (smallest doc_id reachable by links)."""
    marked = stored(fingerprints(docs, shingle))
    entries = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(links(entries, most_bits), "a", "b").withColumnRenamed("node", "fp")
    known = entries.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    of = known.join(least, "component").select("fp", "component_id")
    return marked.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
