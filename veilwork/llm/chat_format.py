"""Chat formatting after a collapse of cumulative snapshots, with DataFrame functions only.

Logged conversations are often snapshots of one that went on. Each turn gets a 128-bit digest of its role and text; a
running sum of hashes of the digests and their places (three lanes of 40 bits) is a rolling hash of each prefix of
turns. A conversation whose whole hash is a proper prefix of another is dropped by an anti-join; of equal ones the
smallest conv_id stays. Only what stays is rendered. The first pass moves digests only, the second the text of the
conversations that stay.

Cases: a null role is the role "unknown", a null text the empty one, before anything is compared. Rows with a null
conv_id belong to no conversation and are left out. A turn repeated exactly counts once. A null turn number comes last;
turns of one number go by their digest. A conversation may have eight million turns (beyond that the sums overflow and
the query stops with an error); it is rendered into one string, so all its turns meet in one task. An empty table gives
no rows. Columns besides conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LANES = ("p", "q", "s")
LANE = (1 << 40) - 1


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest: each turn once, without nulls in role and text."""
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("digest", F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))


def lane(k: int) -> Column:
    return F.xxhash64(F.lit(k), "n", "digest").bitwiseAND(F.lit(LANE))


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """conv_id, n_copies of the maximal conversations: none is a prefix or a copy of another that stays."""
    turns = turns_of(conversations).select("conv_id", "turn", "digest").distinct()
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "digest")
    upto = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select("conv_id", "digest", F.row_number().over(order).alias("n"), F.lead(F.lit(1)).over(order).isNull().alias("last"))
    rolled = placed.select("conv_id", "n", "last", *(F.sum(lane(k)).over(upto).alias(name) for k, name in enumerate(LANES)))
    whole = rolled.where("last").groupBy("n", *LANES).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    prefixes = rolled.where("not last").select("n", *LANES).distinct()
    return whole.join(prefixes, ["n", *LANES], "left_anti").select("conv_id", "n_copies")


def render(conversations: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """conv_id, n_turns, rendered: each turn as start, role, line feed, text, end, line feed."""
    said = F.concat(F.lit(start), "role", F.lit("\n"), "text", F.lit(f"{end}\n"))
    turn = F.struct(F.col("turn").isNull().alias("late"), "turn", "digest", said.alias("said"))
    grouped = turns_of(conversations).groupBy("conv_id").agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    return grouped.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.col("turns.said"), "").alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, rendered of each maximal conversation."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    kept = collapse_snapshots(rows)
    return render(rows.join(kept.select("conv_id"), "conv_id", "left_semi")).join(kept, "conv_id").select("conv_id", "n_turns", "n_copies", "rendered")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: The same rows without the operator: conversations as lists of turns, compared with all proper prefixes of all of them.
OP2_SQL = """
with t as (select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations where conv_id is not null),
s as (select conv_id, list({'role': role, 'text': text} order by turn nulls last, md5(concat(length(role), ':', role, text))) as turns from t group by conv_id),
u as (select min(conv_id) as conv_id, turns, count(*) as n_copies from s group by turns),
p as (select distinct turns[1:k] as turns from (select turns, unnest(range(1, len(turns))) as k from u))
select conv_id, len(turns)::bigint as n_turns, n_copies,
  array_to_string(list_transform(turns, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), '') as rendered
from u where not exists (select 1 from p where p.turns = u.turns)
"""
