"""Line dedup by a segment-partition edit join, with DataFrame functions only.

Lines (trimmed of spaces) are compared across all documents: for equality those of at least `exact_chars` characters (by
default as many as for edits; 1 takes all that aren't empty), for edits those of at least `min_chars`. A line goes if an equal
line stands earlier, or if its first occurrence comes after that of a line within `most` edits (one by default); order is that of
(doc_id, row, line number). So of each group of linked lines the earliest always stays.

With a threshold of one edit, one of two halves of a line is untouched, and the other half's edit lies in one of its two
quarters: a pair of lines agrees on all but one quarter of the shorter line, at equal distance from the ends. Each line
is listed under four keys (all but a quarter, with its length) and looked up under the four keys of the length one less.
With a threshold of k > 1 edits, one of k+1 segments of the shorter line is untouched. Lines are listed under their own
segments, and looked up under the pieces where a segment of a line up to k shorter can stand in them: shifted by at most
the edits left for either side of it.

Keys with one line are dropped after a single shuffle. With one edit, lists of up to `short` lines give their pairs as
they are; in longer ones (lines of one template, say) lines meet only under the differing quarter less one character,
where the earliest line stands for the others, so that rows are linear in the lines. With more edits pairs are kept only
if the parities of their characters (in 64 classes) differ in at most 2k, which each edit changes by at most two, and if
all but k of 16 pieces of the one line stand in the other, shifted by at most k, once equal ends are cut off. Each candidate pair is verified by a
banded bit-parallel edit distance (a word of 2k+1 bits, one step per character). No line text is shuffled except with its document, and that of lines in lists.

A line that makes up over a thousandth of all lines is hot; there are less than a thousand such, so they are broadcast,
give keys at their first occurrence only, and their occurrences are told by that broadcast. Documents are known by
128 bits of doc_id and text.

Cases: a null text stays null and has no lines; an empty text has one (empty) line. Lines shorter than both bounds always
stay. A row repeated exactly is treated like the first of its kind and returned as often. A null doc_id comes first in
the order. An empty table gives no rows. A text is split once for each of its uses and rebuilt in time linear in its
lines. Only doc_id, text and the carried columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilwork.llm.common import apart, cut, documents, maybe_in, stored

QUARTERS = 4


def within(left: Column, right: Column, most: int = 1) -> Column:
    """Whether the edit distance of two strings is at most `most`: Hyyro's banded bit-vector recurrence.

    Bit b of a word is row j - most + b of column j, so the word moves down a row per column.
    """
    chars = F.struct(F.split(left, "").alias("p"), F.split(right, "").alias("t"), F.char_length(left).alias("m"), F.char_length(right).alias("n"))
    return F.element_at(F.transform(F.array(chars), lambda x: _banded(x["p"], x["t"], x["m"], x["n"], most)), 1)


def _banded(p: Column, t: Column, m: Column, n: Column, most: int) -> Column:
    width = 2 * most + 1
    mask = (1 << width) - 1

    def step(acc: Column, j: Column) -> Column:
        c = F.get(t, j - 1)
        eq = None
        for b in range(width):
            row = j - most + b
            bit = F.when((row >= 1) & (row <= m) & (F.get(p, row - 1) == c), F.lit(1 << b)).otherwise(F.lit(0))
            eq = bit if eq is None else eq.bitwiseOR(bit)
        # named in steps: each lambda argument is computed once
        return F.element_at(F.transform(F.array(F.struct(acc.alias("s"), eq.cast("long").alias("eq"))), lambda x: advance(x, j)), 1)

    def advance(x: Column, j: Column) -> Column:
        vp, vn, eq = x["s"]["vp"], x["s"]["vn"], x["eq"]
        d0 = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(mask))
        return F.element_at(F.transform(F.array(F.struct(x["s"].alias("s"), d0.alias("d0"))), lambda y: settle(y, j)), 1)

    def settle(y: Column, j: Column) -> Column:
        vp, vn, d0, d = y["s"]["vp"], y["s"]["vn"], y["d0"], y["s"]["d"]
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(F.lit(mask)))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        last = (m - j + most).cast("int")  # bit of the last row
        diagonal = 1 - F.shiftright(d0, width - 1).bitwiseAND(F.lit(1))
        flat = F.getbit(hp, last).cast("long") - F.getbit(hn, last).cast("long")
        return F.struct(
            hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(mask))).alias("vp"),
            hp.bitwiseAND(down).alias("vn"),
            (d + F.when(j + most <= m, diagonal).otherwise(flat)).alias("d"),
        )

    begin = F.struct(F.lit(mask & ~((1 << most) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.least(F.lit(most), m).cast("long").alias("d"))
    distance = F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), begin, step)["d"]
    return F.when(F.abs(m - n) > most, F.lit(False)).otherwise(distance <= most)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """rid, rid2, doc_id, no, line, h1, h2 of each line that counts."""
    return (
        docs.select("rid", "rid2", "doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
        .withColumn("line", F.trim("line"))
        .where(F.char_length("line") >= min_chars)
        .withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(3), "line")})
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _segment_keys(most: int) -> list[Column]:
    """The keys of a line for more than one edit: its segments, and where those of lines up to `most` shorter can stand."""
    keys = []
    for less in range(most + 1):
        size = F.char_length("line") - less
        at = [F.floor(size * i / (most + 1)).cast("int") for i in range(most + 2)]
        for i in range(most + 1):
            left = most - i
            for shift in range(max(-i, less - left), min(i, less + left) + 1):
                part = F.substring(F.col("line"), at[i] + 1 + shift, at[i + 1] - at[i])
                key = F.xxhash64(size, F.lit(i), part).bitwiseAND(F.lit(-QUARTERS))
                keys.append(F.struct(key.alias("key"), F.lit(2 if less or shift else 1).alias("kind")))
    return keys


def _keys(lines: DataFrame, most: int = 1) -> DataFrame:
    """key, h1, kind (1 is listed, 2 looked up) of lines under what they share with near ones; for one edit the key's last bits are the quarter left out."""
    if most > 1:
        return lines.select("h1", F.explode(F.array(*_segment_keys(most))).alias("k")).select("k.key", "h1", "k.kind")
    n = F.char_length("line")
    hashes, keys = {}, []
    for less in (0, 1):
        at = [F.floor((n - less) * q / QUARTERS).cast("int") for q in range(QUARTERS + 1)]
        for q in range(QUARTERS):  # each quarter, counted from the start (h) and from the end (t) of the line
            hashes[f"h{less}{q}"] = F.xxhash64(F.substring(F.col("line"), at[q] + 1, at[q + 1] - at[q]))
            hashes[f"t{less}{q}"] = F.xxhash64(F.substring(F.col("line"), at[q] + 1 + less, at[q + 1] - at[q])) if less else F.lit(0)
        for q in range(QUARTERS):
            rest = [F.col(f"h{less}{k}" if k < q or not less else f"t{less}{k}") for k in range(QUARTERS) if k != q]
            key = F.xxhash64(F.col("size") - less, *rest).bitwiseAND(F.lit(-QUARTERS)).bitwiseOR(F.lit(q))
            keys.append(F.struct(key.alias("key"), F.lit(1 << less).alias("kind")))
    return lines.withColumns(hashes | {"size": n}).select("h1", F.explode(F.array(*keys)).alias("k")).select("k.key", "h1", "k.kind")


def _shared(keys: DataFrame) -> DataFrame:
    """key, h1, kind, n of lists with n > 1 lines."""
    once = keys.repartition("key").groupBy("key", "h1").agg(F.bit_or("kind").alias("kind"))
    return once.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")


def _quarter(key: Column) -> Column:
    return key.bitwiseAND(F.lit(QUARTERS - 1)).cast("int")


def _pairs(rows: DataFrame, most: int = 0) -> DataFrame:
    """a, b, q of lines that share a key, one of them listed; with most, only those whose parities (column sig) may be so near."""
    left = rows.withColumnRenamed("h1", "a")
    right = rows.select("key", F.col("h1").alias("b"), F.col("kind").alias("kind_b"), *([F.col("sig").alias("sig_b")] if most else []))
    met = left.join(right, "key").where("a < b and (kind | kind_b) & 1 = 1")
    if most:
        met = met.where(F.bit_count(F.col("sig").bitwiseXOR(F.col("sig_b"))) <= 2 * most)
    return met.select("a", "b", _quarter(F.col("key")).alias("q"))


PARITY = "aggregate(split(line, ''), 0L, (sum, c) -> sum ^ shiftleft(1L, ascii(c) & 63))"


def _stars(rows: DataFrame) -> DataFrame:
    """a, b, q of lines (key, h1, kind, first, line) of long lists that agree on their key's quarter but for one character.

    A listed line has its quarter less each character, by place (lines with another character there), and its whole
    quarter; a looked-up one, a character longer, its quarter less each character. Of the lines that agree the earliest
    listed one is paired with the others: it is near each of them.
    """
    q, n = _quarter(F.col("key")), F.char_length("line")

    def forms(shorter: int) -> Column:
        head = F.floor((n - shorter) * q / QUARTERS).cast("int")
        middle = F.substring(F.col("line"), head + 1, F.floor((n - shorter) * (q + 1) / QUARTERS).cast("int") - head + shorter)

        def without(m: Column) -> Column:
            at = F.when(F.char_length(m) > 0, F.sequence(F.lit(1), F.char_length(m))).otherwise(F.array().cast("array<int>"))
            rest = lambda i: F.concat(F.substring(m, F.lit(1), i - 1), F.substring(m, i + 1, F.char_length(m)))
            own = F.transform(at, lambda i: F.struct(F.lit(shorter).alias("late"), F.xxhash64("key", F.lit(0) if shorter else i, rest(i)).alias("v")))
            return own if shorter else F.concat(own, F.array(F.struct(F.lit(0).alias("late"), F.xxhash64("key", F.lit(0), m).alias("v"))))

        return _let(middle, without)

    empty = F.array().cast("array<struct<late:int,v:bigint>>")
    listed = F.when(F.col("kind").bitwiseAND(F.lit(1)) == 1, forms(0)).otherwise(empty)
    looked_up = F.when(F.col("kind").bitwiseAND(F.lit(2)) == 2, forms(1)).otherwise(empty)
    dealt = rows.select("h1", "first", q.alias("q"), F.explode(F.concat(listed, looked_up)).alias("f")).select("h1", "first", "q", "f.late", "f.v")
    centre = F.min(F.struct("late", "first", "h1")).over(Window.partitionBy("v"))
    met = dealt.withColumn("c", centre).where("c.late = 0 and c.h1 <> h1")
    return met.select(F.least("h1", "c.h1").alias("a"), F.greatest("h1", "c.h1").alias("b"), "q")


PIECES = 16


def _most_pieces(a: Column, b: Column, most: int) -> Column:
    """Whether all but `most` of a line's pieces stand in another, shifted by at most `most`: an edit touches one piece."""

    def told(x: Column) -> Column:
        at = [F.floor(x["m"] * i / PIECES).cast("int") for i in range(PIECES + 1)]
        found = []
        for low, high in zip(at, at[1:]):
            begin = F.greatest(low + 1 - most, F.lit(1))
            found.append(F.contains(F.substring(x["b"], begin, high + most - begin + 1), F.substring(x["a"], low + 1, high - low)).cast("int"))
        return sum(found[1:], found[0]) >= PIECES - most

    return _let(F.struct(a.alias("a"), b.alias("b"), F.char_length(a).alias("m")), told)


def _middles(a: Column, b: Column) -> Column:
    """Two lines without the whole pieces that they have in common at their ends, as a struct a, b: as far apart as the lines."""
    lines = F.struct(a.alias("a"), b.alias("b"), F.char_length(a).alias("m"), F.char_length(b).alias("n"))

    def ends(x: Column) -> Column:
        sizes = [F.floor(F.least(x["m"], x["n"]) * i / PIECES).cast("int") for i in range(PIECES + 1)]
        head = F.greatest(*(F.when(F.left(x["a"], k) == F.left(x["b"], k), k).otherwise(0) for k in sizes))
        tail = F.greatest(*(F.when(F.right(x["a"], k) == F.right(x["b"], k), k).otherwise(0) for k in sizes))
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), x["m"].alias("m"), x["n"].alias("n"), head.alias("head"), tail.alias("tail"))

    def middle(x: Column) -> Column:
        tail = F.least(x["tail"], F.least(x["m"], x["n"]) - x["head"])
        return F.struct(*(F.substring(x[c], x["head"] + 1, x[size] - x["head"] - tail).alias(c) for c, size in (("a", "m"), ("b", "n"))))

    return _let(_let(lines, ends), middle)


def _near(a: Column, b: Column, q: Column, most: int = 1) -> Column:
    """Whether two lines agree on all but the shorter one's quarter q, and there within one edit; for more edits, whether what their ends leave is within them."""
    if most > 1:
        return _let(_middles(a, b), lambda x: F.when(_most_pieces(x["a"], x["b"], most), within(x["a"], x["b"], most)).otherwise(F.lit(False)))
    m, n = F.char_length(a), F.char_length(b)
    size = F.least(m, n)
    head = F.floor(size * q / QUARTERS).cast("int")
    tail = (size - F.floor(size * (q + 1) / QUARTERS)).cast("int")
    middle = [F.substring(x, head + 1, k - head - tail) for x, k in ((a, m), (b, n))]
    ends = (F.substring(a, F.lit(1), head) == F.substring(b, F.lit(1), head)) & (F.substring(a, m - tail + 1, tail) == F.substring(b, n - tail + 1, tail))
    return F.when(ends, within(*middle)).otherwise(F.lit(False))


HOT = 1000


def dedup_lines(docs: DataFrame, carry: list[str] | None = None, min_chars: int = 24, most: int = 1, exact_chars: int | None = None, short: int = 16) -> DataFrame:
    """The carried columns, doc_id, text without the lines that go, n_lines, n_removed. most: edits between near copies, one or more."""
    if most < 1:
        raise ValueError("most must be at least 1")
    carry = [c for c in carry or [] if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", *carry).withColumns({"rid": F.xxhash64("doc_id", "text"), "rid2": F.xxhash64(F.lit(5), "text", "doc_id")})
    lines = _lines(rows, min_chars if exact_chars is None else min(exact_chars, min_chars))
    place = F.struct("doc_id", "rid", "rid2", "no")
    firsts = stored(lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT > F.lit(total)  # less than HOT lines
    hot = F.broadcast(firsts.where(is_hot).select("h1", "h2", F.col("first").alias("hot_first")))

    long = lines.where(F.char_length("line") >= min_chars)
    once = long.join(hot, ["h1", "h2"], "left").where(F.col("hot_first").isNull() | (place == F.col("hot_first")))
    shared = stored(_shared(_keys(once, most)))
    texts = cut(_texts(long, shared))
    pairs = _candidates(shared, texts, most, short)
    near = _near_lines(pairs, texts, most)

    gone = firsts.join(near, ["h1", "h2"], "left").where("n > 1 or near").select("h1", "h2", "first", "n", F.coalesce("near", F.lit(False)).alias("near"))
    gone = stored(gone)
    hot_gone = F.broadcast(gone.where(is_hot).select("h1", "h2", F.col("first").alias("hot_first"), F.col("near").alias("hot_near")))
    told = lines.drop("line").join(hot_gone, ["h1", "h2"], "left")
    known = F.col("hot_first").isNotNull()
    told = told.select(
        "rid", "rid2", "no", "h2",
        F.when(known, F.xxhash64("rid", "rid2", "no")).otherwise(apart("h1")).alias("k"),  # what is told already goes anywhere
        F.when(known, F.col("hot_near") | (place != F.col("hot_first"))).alias("told"),
    )
    cold = gone.where(~is_hot).select(apart("h1").alias("k"), "h2", F.struct("first.rid", "first.rid2", "first.no").alias("first"), "near")
    later = F.col("near") | (F.struct("rid", "rid2", "no") != F.col("first"))  # rid and rid2 stand for doc_id too
    drops = told.join(cold, ["k", "h2"], "left").select("rid", "rid2", "no", F.coalesce("told", later).alias("goes"))
    drops = drops.where("goes").groupBy("rid", "rid2").agg(F.collect_set("no").alias("gone"))

    joined = rows.join(drops, ["rid", "rid2"], "left")
    left = lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x["parts"]) - 1), x["gone"]), lambda i: F.get(x["parts"], i)), "\n")
    parts = F.split("text", "\n")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_let(F.struct(parts.alias("parts"), F.col("gone").alias("gone")), left))
    return joined.select("doc_id", kept.alias("text"), *carry, F.greatest(F.size(parts), F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def _texts(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """h1, h2, first, line of the lines in lists (column h1 of shared).

    A bitmap of their hashes holds back most other lines before the exchange; a join tells the rest.
    """
    wanted = shared.select("h1").distinct()
    met = maybe_in(lines, "h1", wanted)
    found = met.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "rid", "rid2", "no", "line")).alias("f")).join(wanted, "h1", "left_semi")
    return found.select("h1", "h2", F.struct("f.doc_id", "f.rid", "f.rid2", "f.no").alias("first"), F.col("f.line").alias("line"))


def _candidates(shared: DataFrame, texts: DataFrame, most: int, short: int) -> DataFrame:
    """a, b, q (line hashes, a < b, and for one edit a quarter) of lines that may be near."""
    if most > 1:
        return cut(_pairs(shared.drop("n").join(texts.select("h1", F.expr(PARITY).alias("sig")), "h1"), most).distinct())
    brief = _pairs(shared.where(F.col("n") <= short).drop("n"))
    more = _stars(shared.where(F.col("n") > short).drop("n").join(texts.select("h1", "first", "line"), "h1"))
    return cut(brief.union(more).distinct())


def _near_lines(pairs: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    """h1, h2, near (true) of lines within so many edits of an earlier one."""
    left = texts.select(F.col("h1").alias("a"), F.col("first").alias("first_a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("first").alias("first_b"), F.col("line").alias("line_b"))
    both = pairs.union(pairs.select("b", "a", "q")).join(left, "a").join(right, "b").where("first_a < first_b")
    both = both.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")  # few bytes, much work
    return both.where(_near(F.col("line_a"), F.col("line_b"), F.col("q"), most)).select(F.col("b").alias("h1"), F.col("b2").alias("h2"), F.lit(True).alias("near")).distinct()


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir), exact_chars=1)
    return found.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The same rows without the operator: lines of one half in common are joined and compared character by character.
OP3_SQL = """
with d as (select row_number() over () as r, doc_id, text, string_split(text, chr(10)) as parts from documents),
l as (select r, unnest(range(1, len(parts) + 1)) as no, trim(unnest(parts), ' ') as line, doc_id from d),
w as (select *, {'late': doc_id is not null, 'id': coalesce(doc_id, 0), 'no': no} as place from l where length(line) >= 1),
f as (select line, length(line) as n, min(place) as place from w group by line),
halves as (
  select line, n, place, less, (n - less) // 2 as h, n - less as m from f, (values (0), (1)) as x(less) where n >= 24
),
k as (
  select line, n, place, less, m, 'head' as side, left(line, h) as part from halves
  union all select line, n, place, less, m, 'tail', right(line, m - h) from halves
),
near as (
  select distinct unnest(case when a.place < b.place then [b.line] else [a.line] end) as line from k as a join k as b on a.less = 0 and a.m = b.m and a.side = b.side and a.part = b.part and (b.less = 1 or a.line < b.line)
  where case when a.n = b.n then list_sum(list_transform(range(1, a.n + 1), lambda i: (a.line[i] <> b.line[i])::int)) <= 1
    else list_bool_or(list_transform(range(0, a.n + 1), lambda i: left(b.line, i) || substr(b.line, i + 2) = a.line)) end
),
gone as (select w.r, w.no from w join f using (line) left join near on near.line = w.line where near.line is not null or w.place <> f.place),
g as (select r, list(no) as nos from gone group by r),
t as (select d.doc_id, parts, nos, case when nos is null then text else array_to_string(list_transform(list_filter(range(1, len(parts) + 1), lambda i: not list_contains(nos, i)), lambda i: parts[i]), chr(10)) end as kept from d left join g on g.r = d.r)
select doc_id, coalesce(len(parts), 0)::bigint as n_lines, coalesce(len(nos), 0)::bigint as n_removed, length(kept)::bigint as kept_chars, sha256(coalesce(kept, '')) as kept_sha256 from t
"""
