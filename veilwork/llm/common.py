"""What several operators share: checkpoints, connected components, batches of sorted groups."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_kept: dict = {}


def kept(key: tuple, make: Callable):
    """make(), kept in this worker process until something else is: a worker holds one operator's tables at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def text_batches(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """Whole texts go to Python in batches of at most so many rows, to keep both sides' buffers small."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return docs


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; one of its own only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="veilwork-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of what an exchange has made much smaller, in an eighth of the shuffle partitions."""
    checkpoint_dir(df.sparkSession)
    return df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)).checkpoint()


_stored: list[DataFrame] = []


def stored(df: DataFrame) -> DataFrame:
    """What is read more than once, kept on the executors' disks; parts that are lost with an executor are made again.

    For large results of short plans; `cut` is for small results of long ones.
    """
    _stored.append(df.persist(StorageLevel.DISK_ONLY))
    return df


def settled(df: DataFrame) -> DataFrame:
    """`stored`, and made at once: plans that read it hold a leaf in place of the plan that made it.

    The driver writes a plan's text anew with each adaptive stage, and a stored result's whole plan wherever it is read:
    where stored results are made from each other this grows as a power of their number, to megabytes for each stage.
    """
    session, kept = df.sparkSession, stored(df)
    kept.count()
    rows = kept.select("*")._jdf.queryExecution().toRdd()  # the cached rows; lost parts are made again from their lineage
    return DataFrame(session._jsparkSession.internalCreateDataFrame(rows, kept._jdf.schema(), False), session)


def release() -> None:
    """Frees what operators have stored so far; results that were not read yet are made anew when read."""
    while _stored:
        _stored.pop().unpersist()


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder by whichever file system its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def apart(column: str) -> Column:
    """A join key with the values of a hash column in another form: no aggregate is dealt by it already, so that both
    sides of the join get an exchange of their own and adaptive execution may split a hot key."""
    return F.col(column).bitwiseXOR(F.lit(1))


FILTER = 1 << 24  # bits


def maybe_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows without most of those whose 64-bit hash is not among the wanted ones (the same column there), by a bitmap in
    at most FILTER / 64 broadcast words (4 MB); a join is to tell the rest."""
    word = F.shiftright(F.col(column).bitwiseAND(F.lit(FILTER - 1)), 6)
    bits = F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))"))
    words = wanted.groupBy(word.alias("_word")).agg(bits.alias("_bits"))
    met = rows.withColumn("_word", word).join(F.broadcast(words), "_word")
    return met.where(F.getbit("_bits", F.col(column).bitwiseAND(F.lit(63)).cast("int")) == 1).drop("_word", "_bits")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n items' component under the links a[i]-b[i]."""
    root = np.arange(n, dtype=np.int64)
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if not (differ := low != high).any():
            return root
        a, b, low, high = a[differ], b[differ], low[differ], high[differ]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links u-v as links of each node to its component's smallest node."""
    links = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
    if links:
        u, v = (np.concatenate(x) for x in zip(*links))
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = forest(len(nodes), place[: len(u)], place[len(u) :])
        other = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], ["u", "v"])


def components(edges: DataFrame, a: str, b: str, per_task: int = 500_000) -> DataFrame:
    """Connected components of the links a-b: (node, component), the component being its smallest node.

    Rounds of a large star, a small star and a contraction, each cut by a reliable checkpoint, until nothing changes.
    The contraction gives each task about `per_task` links and returns at most as many; where one task holds all of
    them, they are done. Each round's minimum per node is a combinable aggregate, and the joins are plain equi-joins,
    so a node of very high degree is pre-aggregated or split by adaptive execution. Nodes without a link are absent;
    nulls are ignored.
    """
    checkpoint_dir(edges.sparkSession)

    def tidy(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")

    def star(df: DataFrame, large: bool) -> DataFrame:
        rows = df.union(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else df
        low = rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = rows.join(low, "u")
        if large:
            return tidy(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        return tidy(met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))))

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    def contracted(df: DataFrame, rows: int) -> DataFrame:
        return df.coalesce(1 + rows // per_task).mapInArrow(contract, "u long, v long").checkpoint()

    first = cut(tidy(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).na.drop()))
    rows = first.count()
    now = contracted(first, rows)
    before = None
    while rows >= per_task and (after := state(now)) != before:
        before, rows = after, after[0]
        now = contracted(star(star(now, True), False).distinct(), rows)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def blocks(batches: Iterator[pa.RecordBatch], key: str, least_rows: int = 50_000) -> Iterator[pa.Table]:
    """Joins record batches that are sorted by a key into tables that no group of the key straddles."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least_rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).combine_chunks().to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, rows = table.combine_chunks().to_batches(), 0  # a group longer than this is looked at again only after as many rows more
    if held:
        yield pa.Table.from_batches(held)
