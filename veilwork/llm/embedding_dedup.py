"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Vectors of one label (and dimension) are scaled to unit length in double precision and quantised to int8 with a scale
of their own. For x = s*q + e the product of two vectors differs from s1*s2*(q1.q2) by at most
|e1|*|s2 q2| + |s1 q1|*|e2| + |e1|*|e2|; only pairs whose product plus that bound reaches the threshold are computed
again in double precision. Equal vectors are collapsed before any product. A label's vectors are dealt over tiles of
bounded size by a hash, and each pair of tiles is a task's group of its own, so that a hot label is spread over many
tasks; what a pair of tiles emits is linear in its rows (link counts and a spanning forest), never its pairs.

Cases: a null label, or a vector that is null, empty, zero or holds null or non-finite components, links with nothing
and is its own component. Vectors of different lengths don't link. A row repeated exactly counts once. A null vec_id
is returned with a null component and kept. Columns besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm.common import components, forest, stored

INF = float("inf")


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the lengths of the quantised vectors and of what they miss."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((unit - back) ** 2).sum(axis=1))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1)[:, None]
    return raw / np.sqrt((raw * raw).sum(axis=1))[:, None]


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float, slab: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of left, row of right) of unit vectors whose cosine reaches the threshold, slab by slab."""
    kind = np.float32 if left.shape[1] <= 1000 else np.float64  # sums of that many products of codes are exact
    lq, ls, ln, le = quantise(left)
    rq, rs, rn, re = quantise(right)
    turned = rq.astype(kind).T.copy()
    for at in range(0, len(left), slab):
        to = slice(at, at + slab)
        near = (lq[to].astype(kind) @ turned).astype(np.float64) * ls[to, None] * rs
        near += le[to, None] * rn + ln[to, None] * re + le[to, None] * re + 1e-9
        i, j = np.nonzero(near >= threshold)
        i += at
        for part in range(0, max(len(i), 1), 200_000):
            a, b = i[part : part + 200_000], j[part : part + 200_000]
            exact = np.einsum("ij,ij->i", left[a], right[b]) >= threshold
            yield a[exact], b[exact]


def _tile_pair(threshold: float):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        group = group.sort_values("rep", ignore_index=True)
        unit = unit_rows(np.array(group["embedding"].tolist(), dtype=np.float64))
        copies, reps, tile = group["n"].to_numpy(), group["rep"].to_numpy(), group["b"].to_numpy()
        count, root = np.zeros(len(reps), np.int64), np.arange(len(reps))
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        for a, b in tile_links(unit[left], unit[right], threshold):
            a, b = left[a], right[b]
            other = a != b
            a, b = a[other], b[other]
            count += np.bincount(a, copies[b], len(reps)).astype(np.int64)
            if i != j:
                count += np.bincount(b, copies[a], len(reps)).astype(np.int64)
            if len(a):
                ids = np.arange(len(reps))
                root = forest(len(reps), np.concatenate([a, ids]), np.concatenate([b, root]))
        hit = count > 0
        return pd.DataFrame({"rep": reps[hit], "links": count[hit], "root": reps[root[hit]]})

    return links


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tile: int = 2048) -> DataFrame:
    """vec_id, label, n_links, component_id, kept: links of cosine >= threshold between vectors of one label."""
    rows = vectors.select("vec_id", "embedding", "label").dropDuplicates()
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF)))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & whole & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    reps = rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("embedding"))
    tiles = reps.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    dealt = (
        reps.join(tiles, ["label", "dim"])
        .withColumn("b", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("label", "dim", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "rep", "n", "embedding")
    )
    found = stored(dealt.groupBy("label", "dim", "i", "j").applyInPandas(_tile_pair(threshold), "rep long, links long, root long"))
    joined = components(found, "rep", "root").withColumnRenamed("node", "rep")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = reps.join(counts, "rep", "left").join(joined, "rep", "left").select("label", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(known, ["label", "embedding"], "left")
    own = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("usable"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"), "label")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: The same rows without the operator: links within a label as a self-join, components as a recursive closure of the links.
OP1_SQL = """
with recursive r as (select distinct vec_id, embedding, label from embeddings),
v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from r
  where vec_id is not null and label is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
p as (select a.vec_id as a, b.vec_id as b from v as a join v as b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select a, b from p union select reach.a, p.b from reach join p on reach.b = p.a),
n as (select a, count(*) as n_links from p group by a),
c as (select a, min(b) as low from reach group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(least(low, vec_id), vec_id) as component_id, coalesce(least(low, vec_id), vec_id) is not distinct from vec_id as kept, label
from r left join n on n.a = vec_id left join c on c.a = vec_id
"""
