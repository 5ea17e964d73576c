"""Removal of repeated byte strings by a sorted sample of suffixes (a difference cover that follows the content).

A difference cover is a sample of positions such that any two equal strings of a set length hold sampled positions at
equal places; sorting the sample and extending its order to the rest of the positions is what makes the suffix-array
construction of that name work. With fixed positions (modulo 3) all positions take part in several sorts; the README
has the figures. Here the cover follows the content: of each window of `length` bytes the position of its least hashed
k-gram is sampled, the first of equals. Equal windows sample equal places, and one position in about 85 is enough.

1. Each sampled suffix is named by the hash of its k-gram; names are counted over all texts (partial sums first).
2. Texts with names that occur again give, for each sampled position with such a name, the stretch of bytes that its
   windows cover; equal stretches of a text, and equal texts that meet, are given once, with their number.
3. Stretches are dealt and sorted by name. The windows in them - the remaining suffixes, each as its bytes to the
   sampled position and what follows - are sorted by two 64-bit hashes and compared with their neighbours: a window
   equal to one next to it, or given with a number over one, is a repeat.
4. Stretches of a hot name (more than `hot` occurrences) don't meet in one task. Equal ones are counted by two 64-bit
   hashes with partial sums; all windows of a stretch that occurs again are repeats. The windows of each different
   stretch go in blocks of STEP, by distance from the sampled position. Blocks are counted in the same way by all that
   their windows cover, and by what those have in common; only where neither tells are windows counted one by one.
5. Repeats go back to their texts as byte ranges, which are merged and cut out.

All joins on names, windows and texts have keys that adaptive execution can split.

Cases: a null text is the empty one. Texts under `length` bytes lose nothing. Equal rows each are other occurrences, so
that long equal texts are removed whole. A null doc_id is returned as it is. An empty table gives no rows. What is left
is bytes; `text` has them as UTF-8 without characters that were cut. Columns besides doc_id, text and the carried ones
are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm.common import apart, blocks, documents, kept, maybe_in, settled, text_batches

GRAM = 32
PIECE = 1 << 18
STEP = 16
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = np.uint64(0xFF51AFD7ED558CCD)
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)

def powers(base: int, n: int, inverse: bool) -> np.ndarray:
    """base**0 .. base**(n-1) or of its inverse, modulo 2**64."""
    step = pow(base, -1, 1 << 64) if inverse else base
    tables = kept(("powers",), dict)
    if len(tables.get((base, inverse), ())) < n:
        row = np.full(max(n, 1 << 16), step, np.uint64)
        row[0] = 1
        tables[base, inverse] = np.multiply.accumulate(row)
    return tables[base, inverse][:n]


def string_hashes(data: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """A mixed polynomial hash of each string of that length."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n, True), out=sums[1:])
    h = (sums[length:] - sums[: n + 1 - length]) * powers(base, n + 1 - length, False)
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Pieces:
    """Texts, long ones in overlapping parts, laid end to end up to a size."""

    def __init__(self, length: int):
        self.length, self.data, self.owner, self.base, self.size = length, [], [], [], 0

    def add(self, owner: int, text: bytes) -> None:
        for at in range(0, max(len(text) - self.length + 1, 0), PIECE):
            part = text[at : at + PIECE + self.length - 1]
            self.data.append(part)
            self.owner.append(owner)
            self.base.append(at)
            self.size += len(part)

    def sample(self) -> tuple[np.ndarray, ...]:
        """The bytes; and by sampled position: piece, name, and its windows' first and last start."""
        joined = np.frombuffer(b"".join(self.data), np.uint8)
        sizes = np.array([len(x) for x in self.data], np.int64)
        ends = np.cumsum(sizes)
        names = string_hashes(joined, GRAM)
        marked = (names & HIGH) | np.arange(len(names), dtype=np.uint64)
        at = (sliding_min(marked, self.length - GRAM + 1) & LOW).astype(np.int64)
        valid = np.ones(len(joined), np.int8)
        for k in range(1, self.length):
            valid[ends - k] = 0
        starts = np.flatnonzero(valid[: len(at)])
        chosen = at[starts]
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:], len(chosen)] - 1
        piece = np.searchsorted(ends, starts[first], "right")
        return joined, piece, names[chosen[first]].view(np.int64), starts[first], starts[last], ends - sizes


def _names(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, keys = Pieces(length), []

        def rows() -> pa.RecordBatch:
            _, piece, name, _, _, _ = pieces.sample()
            owner = np.array(pieces.owner)[piece]
            order = np.lexsort((name, owner))
            owner, name = owner[order], name[order]
            first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])])
            count = np.diff(np.r_[first, len(name)])
            r1, r2 = np.array(keys, np.int64)[owner[first]].T
            return pa.RecordBatch.from_arrays([pa.array(name[first]), pa.array(r1), pa.array(r2), pa.array(count, pa.int64())], ["h", "r1", "r2", "c"])

        for batch in batches:
            for text, *key in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if len(text := text.as_py()) >= length:
                    pieces.add(len(keys), text)
                    keys.append(key)
                if pieces.size >= PIECE:
                    yield rows()
                    pieces, keys = Pieces(length), []
        if keys:
            yield rows()

    return run


STRETCH = "h long, c1 long, c2 long, r1 long, r2 long, starts array<long>, sure boolean, stretch binary"


def _stretches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []  # r1, r2, text, names, whether it occurs again

        def rows(texts: list[list]) -> pa.RecordBatch:
            pieces = Pieces(length)
            for k, x in enumerate(texts):
                pieces.add(k, x[2])
            joined, piece, name, first, last, start = pieces.sample()
            known = np.unique(np.concatenate([np.array(x[3], np.int64) for x in texts]))
            raw, found = joined.tobytes(), {}
            for k in np.flatnonzero(np.isin(name, known)).tolist():
                p = piece[k]
                a, b = int(first[k]), int(last[k])
                found.setdefault((pieces.owner[p], int(name[k]), raw[a : b + length]), []).append(a - int(start[p]) + pieces.base[p])
            owner, h, stretch = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(h, pa.int64()),
                    *(pa.array([x[c] for x in map(two_hashes, stretch)], pa.int64()) for c in (0, 1)),
                    pa.array([texts[k][0] for k in owner], pa.int64()),
                    pa.array([texts[k][1] for k in owner], pa.int64()),
                    pa.array(list(found.values()), pa.list_(pa.int64())),
                    pa.array([texts[k][4] or len(v) > 1 for k, v in zip(owner, found.values())], pa.bool_()),
                    pa.array(stretch, pa.binary()),
                ],
                [x.split()[0] for x in STRETCH.split(", ")],
            )

        size, last = 0, None
        for batch in batches:
            for r1, r2, text, names, copies in zip(*(batch.column(k).to_pylist() for k in (0, 1)), *(batch.column(k) for k in (2, 3)), batch.column(4).to_pylist()):
                if last == (last := (r1, r2)) or not len(names):
                    continue
                if size >= PIECE:
                    yield rows(held)
                    held, size = [], 0
                held.append([r1, r2, text.as_py(), names.as_py(), copies > 1])
                size += len(held[-1][2])
        if held:
            yield rows(held)

    return run


def two_hashes(data: bytes) -> tuple[int, int]:
    """A signed 128-bit hash in two halves."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(data))


def equal_neighbours(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings that start at these places equal another one: sorted by hash, compared with neighbours."""
    one, two = (string_hashes(data, length, base)[places] for base in BASES)
    order = np.argsort(one)
    a, b = one[order], two[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        same = a[1:] == a[:-1]
    same &= b[1:] == b[:-1]
    out = np.zeros(len(places), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _repeats(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "h", 3_000):
            parts = table.column("stretch").to_pylist()
            sizes = np.array([len(x) for x in parts], np.int64)
            start = np.cumsum(sizes) - sizes
            windows = sizes - length + 1
            of = np.repeat(np.arange(len(parts)), windows)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            data = np.frombuffer(b"".join(parts), np.uint8)
            hit = equal_neighbours(data, start[of] + inside, length) | np.array(table.column("sure").to_pylist(), bool)[of]
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            new = np.r_[True, (np.diff(at) != 1) | (of[at][1:] != of[at][:-1])]
            low, high = at[new], at[np.r_[new[1:], True]]
            owner = of[low]
            lists = table.column("starts").combine_chunks()
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            many = np.diff(offsets)[owner]
            rows = np.repeat(np.arange(len(owner)), many)
            place = flat[np.repeat(offsets[owner] - (np.cumsum(many) - many), many) + np.arange(len(rows))]
            r1, r2 = (table.column(k).to_numpy()[owner][rows] for k in ("r1", "r2"))
            yield pa.RecordBatch.from_arrays([pa.array(r1), pa.array(r2), pa.array(place + inside[low][rows]), pa.array(place + inside[high][rows] + length)], ["r1", "r2", "low", "high"])

    return run


BLOCK = "c1 long, c2 long, again boolean, first int, g1 long, g2 long, e1 long, e2 long, hull binary"


def _blocks(length: int):
    """Of each stretch (c1, c2, again, stretch) its windows in blocks of STEP, told by their distance from the sampled
    position: where the block begins, hash and bytes of all that its windows cover, hash of what they have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                stretches = part.column(3).to_pylist()
                sizes = np.array([len(x) for x in stretches], np.int64)
                start = np.cumsum(sizes) - sizes
                names = string_hashes(np.frombuffer(b"".join(stretches), np.uint8), GRAM)
                marked = (names & HIGH) | np.arange(len(names), dtype=np.uint64)
                own = np.c_[start, start + sizes - GRAM + 1].reshape(-1)[:-1]  # the grams of each stretch, by turns with those over an end
                sampled = (np.minimum.reduceat(marked, own)[::2] & LOW).astype(np.int64) - start
                of, rows = [], []
                for k, (stretch, at) in enumerate(zip(stretches, sampled.tolist())):
                    least = at - len(stretch) + length  # the distance of the last window
                    for near in range(least - least % STEP, at + 1, STEP):
                        far = near + STEP - 1
                        first, last = at - min(at, far), at - max(least, near)
                        hull = stretch[first : last + length]
                        of.append(k)
                        rows.append((first, *two_hashes(hull), *two_hashes(stretch[at - near : at - far + length]), hull))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                told = [*part.columns[:3], *(pa.array(x, t) for x, t in zip(zip(*rows), kinds))]
                yield pa.RecordBatch.from_arrays([x.take(pa.array(of)) for x in told[:3]] + told[3:], [x.split()[0] for x in BLOCK.split(", ")])

    return run


WINDOW = "g1 long, g2 long, k int, w1 long, w2 long, again boolean"


def _windows(length: int):
    """Of each block (g1, g2, again, hull) its windows' places and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                hulls = part.column(3).to_pylist()
                sizes = np.array([len(x) for x in hulls], np.int64)
                windows = sizes - length + 1
                of = np.repeat(np.arange(len(hulls)), windows)
                inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
                data = np.frombuffer(b"".join(hulls), np.uint8)
                at = (np.cumsum(sizes) - sizes)[of] + inside
                g1, g2, again = (part.column(c).to_numpy(zero_copy_only=False)[of] for c in (0, 1, 2))
                w1, w2 = (string_hashes(data, length, base)[at].view(np.int64) for base in BASES)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g1, g2, inside.astype(np.int32), w1, w2, again)], [x.split()[0] for x in WINDOW.split(", ")])

    return run


def _ranges(length: int):
    """r1, r2, starts, windows (places in the stretch, sorted) to byte ranges of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for r1, r2, starts, windows in zip(*(batch.column(k).to_pylist() for k in range(4))):
                at = np.array(windows, np.int64)
                new = np.flatnonzero(np.r_[True, np.diff(at) != 1])
                for low, high in zip(at[new].tolist(), at[np.r_[new[1:], len(at)] - 1].tolist()):
                    for start in starts:
                        for column, value in zip(out, (r1, r2, start + low, start + high + length)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["r1", "r2", "low", "high"])

    return run


RANGE = "r1 long, r2 long, low long, high long"


def hot_repeats(stretches: DataFrame, length: int) -> DataFrame:
    """Ranges of repeats in stretches of hot names: counted by hashes, never gathered by name.

    Equal blocks of different stretches are repeats as a whole. A block whose common part is no other block's has none.
    Only the windows of the rest, where repeats begin or end, are counted one by one.
    """
    pair = lambda a, b: (apart(a).alias("k1"), F.col(b).alias("k2"))
    classes = settled(stretches.groupBy("c1", "c2").agg((F.max("sure") | (F.count("*") > 1)).alias("again"), F.first("stretch").alias("stretch")))
    blocks = classes.select("c1", "c2", "again", "stretch").mapInArrow(_blocks(length), BLOCK)
    hulls = settled(blocks.groupBy("g1", "g2").agg((F.max("again") | (F.count("*") > 1)).alias("again"), F.first("e1").alias("e1"), F.first("e2").alias("e2"), F.first("hull").alias("hull")))
    shared = hulls.groupBy("e1", "e2").agg(F.count("*").alias("n"), F.min("again").alias("told")).where("n > 1 and not told")
    split = hulls.select("g1", "g2", "again", "hull", *pair("e1", "e2")).join(shared.select(*pair("e1", "e2")), ["k1", "k2"])
    windows = split.select("g1", "g2", "again", "hull").mapInArrow(_windows(length), WINDOW)
    counted = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 or again")
    own = windows.where("not again").select("g1", "g2", "k", *pair("w1", "w2"))
    hit = own.join(counted.select(*pair("w1", "w2")), ["k1", "k2"]).groupBy("g1", "g2").agg(F.collect_list("k").alias("windows"))
    every = lambda data: F.sequence(F.lit(0), F.octet_length(data) - length)
    told = hit.union(hulls.where("again").select("g1", "g2", every("hull")))
    open_blocks = blocks.where("not again").select("c1", "c2", "first", *pair("g1", "g2"))
    placed = open_blocks.join(told.select(*pair("g1", "g2"), "windows"), ["k1", "k2"]).select("c1", "c2", F.transform("windows", lambda k: k + F.col("first")).alias("windows"))
    part = placed.groupBy("c1", "c2").agg(F.array_sort(F.flatten(F.collect_list("windows"))).alias("windows"))
    found = part.union(classes.where("again").select("c1", "c2", every("stretch")))
    places = stretches.select("r1", "r2", "starts", *pair("c1", "c2"))
    return places.join(found.select(*pair("c1", "c2"), "windows"), ["k1", "k2"]).select("r1", "r2", "starts", "windows").mapInArrow(_ranges(length), RANGE)


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left, and the number of maximal removed runs."""
    kept, at, spans, end = [], 0, 0, -1
    for low, high in sorted(ranges):
        if low > end:
            spans += 1
            if low > at:
                kept.append(text[at:low])
        end = max(end, high)
        at = end
    kept.append(text[at:])
    return b"".join(kept), spans


def remove_repeats(docs: DataFrame, length: int = 200, carry: list[str] | None = None, with_text: bool = True, hot: int = 1000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text also text; and the carried columns.

    hot: names that occur more often are counted by hashes; the result is the same for any number.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    carry = [c for c in carry or [] if c not in ("doc_id", "text")]
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = text_batches(docs).select("doc_id", data.alias("data"), *carry).withColumns({"r1": F.xxhash64("data"), "r2": F.xxhash64(F.lit(5), "data")})
    names = settled(rows.select("data", "r1", "r2").mapInArrow(_names(length), "h long, r1 long, r2 long, c long"))
    often = names.groupBy("h").agg(F.sum("c").alias("n")).where("n > 1").select(apart("h").alias("k"), "n")
    met = names.select(apart("h").alias("k"), "r1", "r2").join(often, "k").select(apart("k").alias("h"), "r1", "r2", "n")
    # each text gives a name once, so a name's rows of one text are the copies of that text
    once = met.groupBy("r1", "r2", "h").agg(F.count("*").alias("copies"), F.first("n").alias("n"))
    of = lambda is_hot: F.collect_list(F.when((F.col("n") > hot) == F.lit(is_hot), F.col("h")))
    wanted = settled(once.groupBy("r1", "r2").agg(of(False).alias("cold"), of(True).alias("hot"), F.max("copies").alias("copies")))
    keyed = rows.withColumn("k1", apart("r1"))  # one exchange of the texts for the cold names and the last join

    def stretches(texts: DataFrame, known: DataFrame, names: str) -> DataFrame:
        met = texts.join(known.select(apart("r1").alias("k1"), "r2", names, "copies"), ["k1", "r2"]).sortWithinPartitions("k1", "r2")
        # r1 is told from k1, so that the last join reads the same columns, and so the same exchange
        return met.select(apart("k1").alias("r1"), "r2", "data", names, "copies", "doc_id", *carry).mapInArrow(_stretches(length), STRETCH)

    hot_texts = wanted.where(F.size("hot") > 0)
    frequent = settled(stretches(maybe_in(keyed, "r1", hot_texts), hot_texts, "hot").drop("h"))
    cold = stretches(keyed, wanted, "cold")
    cold = cold.select("h", "r1", "r2", "starts", "sure", "stretch")
    found = cold.repartition("h").sortWithinPartitions("h").mapInArrow(_repeats(length), RANGE).union(hot_repeats(frequent, length))
    ranges = found.groupBy("r1", "r2").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    joined = keyed.join(ranges.select(apart("r1").alias("k1"), "r2", "ranges"), ["k1", "r2"], "left").select("doc_id", *carry, "data", "ranges")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *carry])
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text
    width = 1 + len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, found in zip(batch.column(width), batch.column(width + 1)):
                text = text.as_py()
                own = [(x["low"], x["high"]) for x in found.as_py()] if found.is_valid else []
                left, spans = cut(text, own)
                for column, value in zip(out, (len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text else None)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(x, k) for x, k in zip(out, kinds)][: 4 + with_text]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], [*batch.schema.names[:width], "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"][: width + 4 + with_text])

    return joined.mapInArrow(run, schema)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_text=False)


#: The same rows without the operator: every 200-byte window is listed by its MD5 and counted; runs of repeated windows are merged and cut.
OP8_SQL = """
with d as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b from documents),
w as (select r, pos, md5(b[pos + 1 : pos + 200]) as m from (select r, b, unnest(range(0, octet_length(b) - 199)) as pos from d)),
again as (select m from w group by m having count(*) > 1),
hit as (select r, pos, lag(pos) over (partition by r order by pos) as before from w where m in (select m from again)),
run as (select r, pos, sum((before is null or pos > before + 200)::int) over (partition by r order by pos) as k from hit),
span as (select r, min(pos) as low, max(pos) + 200 as high from run group by r, k),
gap as (select r, low, high, coalesce(lag(high) over (partition by r order by low), 0) as open from span),
cut as (select r, list({'a': open + 1, 'z': low} order by low) as gaps, max(high) as last, sum(high - low) as n_removed, count(*) as n_spans from gap group by r),
t as (select doc_id, b, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  case when gaps is null then b else unhex(array_to_string(list_transform(gaps, lambda x: case when x.z < x.a then '' else hex(b[x.a : x.z]) end), '') || case when last < octet_length(b) then hex(b[last + 1 : octet_length(b)]) else '' end) end as kept from d left join cut on cut.r = d.r)
select doc_id, octet_length(b)::bigint as n_bytes, n_removed, n_spans, sha256(kept) as kept_sha256 from t
"""
