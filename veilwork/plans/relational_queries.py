"""Samples, joins, aggregates, windows and sampling, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilwork.functions.rand import shuffle_key, uniform
from veilwork.operators import sampling
from veilwork.plans.registry import query

ORDER = "md5('42|' || {})"


@query("select conv_id, count(*) as fields, list_aggregate(list(role order by turn), 'string_agg', ',') as roles from (select conv_id, turn, max(role) as role from conversations group by 1, 2) group by conv_id")
def sample_group(table, spark):
    members = table("conversations").groupBy("conv_id", "turn").agg(F.max("role").alias("role"))
    said = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return members.groupBy("conv_id").agg(F.count("*").alias("fields"), F.array_join(said, ",").alias("roles"))


@query("select conv_id from conversations group by conv_id having bool_or(role = 'user') and bool_or(role = 'assistant')")
def sample_complete(table, spark):
    return table("conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "user").alias("u"), F.bool_or(F.col("role") == "assistant").alias("a")).where("u and a").select("conv_id")


@query("select a.conv_id, a.turn, coalesce(b.role, '') as tag from conversations a left join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1")
def variant_tag_lookup(table, spark):
    c = table("conversations").select("conv_id", "turn", "role")
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("tag")), ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("tag", F.lit("")).alias("tag"))


@query("select conv_id, count(*) as variants, string_agg(role || ':' || length(text), ';' order by turn) as listed from conversations where role <> 'system' group by conv_id")
def decode_all(table, spark):
    one = F.struct("turn", F.concat("role", F.lit(":"), F.char_length("text").cast("string")).alias("s"))
    return table("conversations").where("role <> 'system'").groupBy("conv_id").agg(F.count("*").alias("variants"), F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]), ";").alias("listed"))


@query("select conv_id, arg_min(text, turn) filter (role = 'user') as first_user, arg_min(text, turn) filter (role = 'assistant') as first_reply from conversations group by conv_id having count(*) filter (role = 'user') > 0 and count(*) filter (role = 'assistant') > 0")
def decode_triplet(table, spark):
    first = lambda r: F.min_by(F.when(F.col("role") == r, F.col("text")), F.when(F.col("role") == r, F.col("turn")))
    return table("conversations").groupBy("conv_id").agg(first("user").alias("first_user"), first("assistant").alias("first_reply")).where("first_user is not null and first_reply is not null")


ONE = "select conv_id, arg_min(turn, md5('42|' || conv_id || '|' || turn)) as turn from conversations group by conv_id"


@query(ONE)
def one_of_many(table, spark):
    return table("conversations").groupBy("conv_id").agg(F.min_by("turn", shuffle_key(42, "conv_id", "turn")).alias("turn"))


@query(f"select o.conv_id, o.turn, coalesce(c.role, '') as tag from ({ONE}) o left join conversations c on c.conv_id = o.conv_id and c.turn = o.turn + 1")
def decode_one(table, spark):
    c = table("conversations").select("conv_id", "turn", "role")
    return one_of_many(table, spark).join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("tag")), ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("tag", F.lit("")).alias("tag"))


@query("select d.doc_id, d.source, l.quality from documents d join labels l on d.doc_id = l.doc_id")
def pair_inner(table, spark):
    return table("documents").select("doc_id", "source").join(table("labels").select("doc_id", "quality"), "doc_id")


@query("select doc_id from documents where doc_id in (select doc_id from labels)")
def pair_semi(table, spark):
    return table("documents").select("doc_id").join(table("labels"), "doc_id", "left_semi")


@query("select count(*) as total, count(l.doc_id) as matched, count(*) - count(l.doc_id) as missing from documents d left join labels l on d.doc_id = l.doc_id")
def match_left(table, spark):
    both = table("documents").select("doc_id").join(table("labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    return both.agg(F.count("*").alias("total"), F.count("hit").alias("matched"), (F.count("*") - F.count("hit")).alias("missing"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null) order by doc_id limit 10")
def missing_anti(table, spark):
    return table("documents").select("doc_id").join(table("labels"), "doc_id", "left_anti").orderBy("doc_id").limit(10)


@query(r"select lower(regexp_extract(url, '(\.[^./]+)$', 1)) as ext, count(*) as n from pages group by 1")
def ext_counter(table, spark):
    return table("pages").groupBy(F.lower(F.regexp_extract("url", r"(\.[^./]+)$", 1)).alias("ext")).agg(F.count("*").alias("n"))


@query("select md5(text) as stem, max(doc_id) as last from documents group by 1")
def index_last_wins(table, spark):
    return table("documents").groupBy(F.md5("text").alias("stem")).agg(F.max("doc_id").alias("last"))


@query("""select o.o_orderkey, min('row_' || l.l_orderkey || '_' || l.l_linenumber) as input from orders o left join lineitem l on regexp_extract('out_' || o.o_orderkey, '(\\d+)', 1) = regexp_extract('row_' || l.l_orderkey || '_x', '^row_(\\d+)_', 1) group by 1""".replace("\\\\", "\\"))
def eval_pair_first(table, spark):
    o = table("orders").select("o_orderkey", F.regexp_extract(F.concat(F.lit("out_"), F.col("o_orderkey").cast("string")), r"(\d+)", 1).alias("id"))
    name = F.concat(F.lit("row_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
    line = table("lineitem").select(name.alias("input")).select("input", F.regexp_extract("input", r"^row_(\d+)_", 1).alias("id")).groupBy("id").agg(F.min("input").alias("input"))
    return o.join(line, "id", "left").select("o_orderkey", "input")


ALLOC = """with n as (select lang, count(*) as n from documents group by lang), a as (select *, least(1, n) as f0, sqrt(n::double) as w from n),
b as (select *, greatest(0, 24 - sum(f0) over ()) as rest, sum(w) over () as sw from a), c as (select *, rest * w / sw as raw, floor(rest * w / sw)::bigint as f from b),
d as (select *, rest - sum(f) over () as lft, row_number() over (order by raw - f desc, lang) as k from c)
select lang, n, least(f0 + f + case when k <= lft then 1 else 0 end, n)::bigint as alloc from d"""


@query(ALLOC)
def stratified_alloc(table, spark):
    return sampling.allocation(table("documents").select("lang"), "lang", 24, 1)


@query(f"with al as ({ALLOC}) select lang, doc_id from (select d.lang, doc_id, alloc, row_number() over (partition by d.lang order by md5('42|' || doc_id), doc_id) as k from documents d join al on d.lang = al.lang) where k <= alloc")
def stratified_pick(table, spark):
    docs = table("documents").select("lang", "doc_id")
    return sampling.pick(docs, "lang", "doc_id", sampling.allocation(docs, "lang", 24, 1))


DIVERSE = """select user_id, event_type, event_id, place from (select *, row_number() over (partition by user_id order by (r > 1)::int, o, event_id)::int as place from
(select *, row_number() over (partition by user_id, event_type order by o, event_id) as r from (select user_id, event_type, event_id, md5('42|' || event_id) as o from events))) where place <= {}"""


@query(DIVERSE.format(3))
def diverse_pick(table, spark):
    return sampling.diverse(table("events").select("user_id", "event_type", "event_id"), "user_id", "event_type", "event_id", 3)


@query(DIVERSE.format(9))
def diverse_fill(table, spark):
    return sampling.diverse(table("events").select("user_id", "event_type", "event_id"), "user_id", "event_type", "event_id", 9)


@query("select o_orderkey from orders order by md5('42|' || o_orderkey), o_orderkey limit 20")
def seeded_shuffle(table, spark):
    return table("orders").select("o_orderkey").orderBy(shuffle_key(42, "o_orderkey"), "o_orderkey").limit(20)


@query("select event_id, ('0x' || left(md5('42|' || event_id || '|u'), 8))::bigint / 4294967296.0::double as u from events")
def uniform_draw(table, spark):
    return table("events").select("event_id", uniform(42, "event_id", F.lit("u")).alias("u"))


@query("select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by event_id) as k from events) where k <= 24")
def first_24(table, spark):
    return table("events").select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).alias("k")).where("k <= 24").select("user_id", "event_id")


def _numbered(df, key):
    """0-based position by an unbounded key without one task for all rows: counts of ranges first, then a window in each."""
    ranged = df.withColumn("b", F.floor(F.col(key) / 4096).cast("long"))
    before = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("b").agg(F.count("*").alias("n")).select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranged.withColumn("k", F.row_number().over(W.partitionBy("b").orderBy(key)) - 1).join(starts, "b").withColumn("i", F.col("start") + F.col("k")).drop("b", "k", "start")


@query("select o_orderkey, ((row_number() over (order by o_orderkey) - 1) % 4)::bigint as device from orders")
def round_robin(table, spark):
    return _numbered(table("orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", F.pmod("i", F.lit(4)).cast("long").alias("device"))


@query("select batch, count(*) as n from (select ((row_number() over (order by o_orderkey) - 1) // 8)::bigint as batch from orders) group by batch")
def io_batches(table, spark):
    return _numbered(table("orders").select("o_orderkey"), "o_orderkey").groupBy(F.floor(F.col("i") / 8).cast("long").alias("batch")).agg(F.count("*").alias("n"))


@query("select p_partkey, (row_number() over (order by p_partkey) - 1)::bigint as final_idx from part where p_size > 25")
def reindex_dense(table, spark):
    return _numbered(table("part").where("p_size > 25").select("p_partkey"), "p_partkey").select("p_partkey", F.col("i").cast("long").alias("final_idx"))


@query("select p_brand, p_partkey, coalesce(sum(p_size) over (partition by p_brand order by p_partkey rows between unbounded preceding and 1 preceding), 0)::bigint as x, (sum(p_size) over (partition by p_brand))::bigint as width from part")
def paste_offsets(table, spark):
    row = W.partitionBy("p_brand").orderBy("p_partkey").rowsBetween(W.unboundedPreceding, -1)
    return table("part").select("p_brand", "p_partkey", F.coalesce(F.sum("p_size").over(row), F.lit(0)).cast("long").alias("x"), F.sum("p_size").over(W.partitionBy("p_brand")).cast("long").alias("width"))


@query("select l_returnflag, count(*) filter (l_linestatus = 'O') as open, count(*) filter (l_linestatus = 'F') as done from lineitem group by 1")
def pivot_counts(table, spark):
    p = table("lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).count()
    return p.select("l_returnflag", F.coalesce("O", F.lit(0)).cast("long").alias("open"), F.coalesce("F", F.lit(0)).cast("long").alias("done"))


@query("select l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus)::bigint as gid, count(*) as n from lineitem group by rollup (l_returnflag, l_linestatus)")
def pivot_totals(table, spark):
    return table("lineitem").rollup("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("long").alias("gid"), F.count("*").alias("n"))


@query("select event_type, count(*) as n, count(*) * 100.0::double / sum(count(*)) over () as share from events group by 1")
def effect_share(table, spark):
    n = table("events").groupBy("event_type").agg(F.count("*").alias("n"))
    return n.select("event_type", "n", (F.col("n") * F.lit(100.0) / F.sum("n").over(W.partitionBy(F.lit(1)))).alias("share"))


@query("select md5(text) as hash, min(doc_id) as doc_id, count(*) as copies from documents group by 1")
def content_dedupe(table, spark):
    return table("documents").groupBy(F.md5("text").alias("hash")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("select lang, count(*) as base, count(*) * case lang when 'en' then 3 when 'fr' then 5 else 10 end as fields from documents group by lang")
def multiplicity(table, spark):
    factor = F.when(F.col("lang") == "en", 3).when(F.col("lang") == "fr", 5).otherwise(10)
    return table("documents").groupBy("lang").agg(F.count("*").alias("base")).select("lang", "base", (F.col("base") * factor).alias("fields"))


@query("select source, count(*) as n, sum(n_chars)::bigint as chars from documents group by source")
def shard_manifest(table, spark):
    return table("documents").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").cast("long").alias("chars"))


@query("select l_suppkey as id from lineitem union select s_suppkey from supplier")
def distinct_names(table, spark):
    return table("lineitem").select(F.col("l_suppkey").alias("id")).union(table("supplier").select("s_suppkey")).distinct()


@query("select p_partkey, 'png' as kind from part where p_type in ('PROMO', 'LARGE') union all select p_partkey, 'jpg' from part where p_type in ('PROMO', 'SMALL')")
def union_listing(table, spark):
    p = table("part")
    return p.where("p_type in ('PROMO', 'LARGE')").select("p_partkey", F.lit("png").alias("kind")).unionByName(p.where("p_type in ('PROMO', 'SMALL')").select("p_partkey", F.lit("jpg").alias("kind")))


@query("select distinct event_type from events where event_type <> 'error'")
def method_list(table, spark):
    return table("events").where("event_type <> 'error'").select("event_type").distinct()


@query("select event_id, case event_type when 'click' then 'glare' when 'view' then 'haze' else 'artifact' end as artifact from events")
def artifact_lookup(table, spark):
    names = spark.createDataFrame([("click", "glare"), ("view", "haze")], "event_type string, artifact string")
    return table("events").select("event_id", "event_type").join(F.broadcast(names), "event_type", "left").select("event_id", F.coalesce("artifact", F.lit("artifact")).alias("artifact"))


@query("select d.doc_id, l.quality, d.n_chars from (select distinct doc_id, n_chars from documents) d join (select distinct doc_id, quality from labels) l on d.doc_id = l.doc_id")
def gt_pairing(table, spark):
    return table("documents").select("doc_id", "n_chars").distinct().join(table("labels").select("doc_id", "quality").distinct(), "doc_id").select("doc_id", "quality", "n_chars")


@query("select lang, source, count(*) as n from documents group by 1, 2 order by n desc, lang, source")
def strata_report(table, spark):
    return table("documents").groupBy("lang", "source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang", "source")


@query("select p_partkey, floor(('0x' || left(md5('42|' || p_partkey || '|texture'), 8))::bigint / 4294967296.0::double * 8)::bigint as texture from part")
def texture_assign(table, spark):
    return table("part").select("p_partkey", F.floor(uniform(42, "p_partkey", F.lit("texture")) * 8).cast("long").alias("texture"))


@query("select i + 1 as number, 'smoke_' || lpad((i + 1)::varchar, 4, '0') || case when i < 10 then '_pathblur.png' else '_base.png' end as file, 180 + 320 * (('0x' || left(md5('42|' || i || '|base_scale'), 8))::bigint / 4294967296.0::double) as base_scale from range(20) t(i)")
def enumerate_names(table, spark):
    kind = F.when(F.col("id") < 10, "_pathblur.png").otherwise("_base.png")
    return spark.range(20).select((F.col("id") + 1).alias("number"), F.concat(F.format_string("smoke_%04d", F.col("id") + 1), kind).alias("file"), (F.lit(180.0) + 320 * uniform(42, "id", F.lit("base_scale"))).alias("base_scale"))
