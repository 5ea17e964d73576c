"""Names, tags, replies and paths, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilwork.functions import text as t
from veilwork.plans.registry import query

TOK = r"(\d+|[vhdbk][0-9.]*[0-9][0-9.]*)"
TAG = "'out_' || replace(lower(p_type), ' ', '-') || '_v' || p_size"
TYPE_SQL = f"case when regexp_full_match(substr(tag, 5), '{TOK}') then substr(tag, 5) else regexp_replace(substr(tag, 5), '_{TOK}$', '') end"


def _tags(table):
    return table("part").select("p_partkey", F.concat(F.lit("out_"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("-")), F.lit("_v"), F.col("p_size").cast("string")).alias("tag"))


@query(r"""select page_id, case when regexp_matches(url, '^(?:.*/)?[^/.]*\.[^/]*$') then regexp_extract(url, '^((?:.*/)?[^/.]*)\.', 1) end as key,
case when regexp_matches(url, '^(?:.*/)?[^/.]*\.[^/]*$') then regexp_extract(url, '^(?:.*/)?[^/.]*\.([^/]*)$', 1) end as field from pages""")
def member_key_field(table, spark):
    return table("pages").select("page_id", t.member_key(F.col("url")).alias("key"), t.member_field(F.col("url")).alias("field"))


@query(f"select p_partkey, tag, {TYPE_SQL} as tag_type from (select p_partkey, {TAG} as tag from part)")
def tag_type(table, spark):
    return _tags(table).withColumn("tag_type", t.tag_type(F.col("tag")))


@query(f"select {TYPE_SQL} as tag_type, count(*) as n from (select {TAG} as tag from part) group by 1")
def tag_type_counts(table, spark):
    return _tags(table).groupBy(t.tag_type(F.col("tag")).alias("tag_type")).agg(F.count("*").alias("n"))


@query(r"""select page_id, regexp_extract(url, '([^/]*)$', 1) as base, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\.[^.]+$', '') as stem,
lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '(\.[^.]+)$', 1)) as suffix, replace(url, '/', '__') as flat from pages""")
def path_parts(table, spark):
    url = F.col("url")
    return table("pages").select("page_id", t.base(url).alias("base"), t.stem(url).alias("stem"), t.suffix(url).alias("suffix"), F.replace(url, F.lit("/"), F.lit("__")).alias("flat"))


SCENE = "'Scene' || lpad(p_size::varchar, 3, '0') || '_' || split_part(p_type, ' ', 1) || lpad((p_partkey % 1000)::varchar, 3, '0') || '_camera01'"


@query(f"""select p_partkey, split_part(k, '_', 1) as scene, split_part(k, '_', 2) as effect_id, regexp_extract(split_part(k, '_', 2), '^([A-Za-z]+)', 1) as effect_type,
split_part(k, '_', 3) as camera from (select p_partkey, {SCENE} as k from part)""")
def scene_effect_parse(table, spark):
    kind = F.split_part("p_type", F.lit(" "), F.lit(1))
    k = F.concat(F.lit("Scene"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit("_"), kind, F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit("_camera01"))
    part = lambda n: F.split_part("k", F.lit("_"), F.lit(n))
    return table("part").select("p_partkey", k.alias("k")).select("p_partkey", part(1).alias("scene"), part(2).alias("effect_id"), F.regexp_extract(part(2), "^([A-Za-z]+)", 1).alias("effect_type"), part(3).alias("camera"))


@query("select page_id, regexp_extract('x/pano_s' || page_id || '_4K/light.png', '_([^_/]+)_4K/', 1) as slug from pages")
def slug_extract(table, spark):
    return table("pages").select("page_id", F.regexp_extract(F.concat(F.lit("x/pano_s"), F.col("page_id").cast("string"), F.lit("_4K/light.png")), "_([^_/]+)_4K/", 1).alias("slug"))


@query("""select p_partkey, list_aggregate(list_transform(string_split(p_name, ' '), lambda x: case x when 'part' then 'item' else x end), 'string_agg', ' ') as renamed from part""")
def token_rename(table, spark):
    names = F.create_map(F.lit("part"), F.lit("item"))
    return table("part").select("p_partkey", F.array_join(F.transform(F.split("p_name", " "), lambda x: F.coalesce(names[x], x)), " ").alias("renamed"))


@query("select p_partkey, 'smoke_' || lpad(p_size::varchar, 4, '0') || '_base.png' as file, rpad(left(p_name, 40), 40, ' ') as cell from part")
def pad_format(table, spark):
    return table("part").select("p_partkey", F.format_string("smoke_%04d_base.png", "p_size").alias("file"), F.rpad(F.left("p_name", F.lit(40)), 40, " ").alias("cell"))


REPLY = "case p_size % 4 when 0 then 'Score: ' || (p_partkey % 130) || '%' when 1 then '评分：' || (p_partkey % 100) || '.5%' when 2 then 'score:' || (p_partkey % 90) else 'none' end"
SCORE_SQL = r"try_cast(nullif(regexp_extract(reply, '(?i)(?:评分|Score)\s*[:：]\s*(\d+\.?\d*)\s*%?', 1), '') as double)"


def replies(table):
    p, n = F.col("p_partkey"), F.col("p_size") % 4
    said = F.when(n == 0, F.concat(F.lit("Score: "), (p % 130).cast("string"), F.lit("%"))).when(n == 1, F.concat(F.lit("评分："), (p % 100).cast("string"), F.lit(".5%")))
    return table("part").select("p_partkey", "p_type", "p_brand", said.when(n == 2, F.concat(F.lit("score:"), (p % 90).cast("string"))).otherwise("none").alias("reply"))


@query(f"select p_partkey, case when {SCORE_SQL} between 0 and 100 then {SCORE_SQL} end as score from (select p_partkey, {REPLY} as reply from part)")
def score_parse(table, spark):
    return replies(table).select("p_partkey", t.score(F.col("reply")).alias("score"))


@query(f"""select p_type as task, p_brand as method, avg(score) as mean_score, count(*) as n from (select p_type, p_brand, {SCORE_SQL} as score from (select p_type, p_brand, {REPLY} as reply from part))
where score between 0 and 100 group by p_type, p_brand order by 1, 2""")
def eval_mean(table, spark):
    scored = replies(table).select(F.col("p_type").alias("task"), F.col("p_brand").alias("method"), t.score(F.col("reply")).alias("score")).where("score is not null")
    return scored.groupBy("task", "method").agg(F.avg("score").alias("mean_score"), F.count("*").alias("n")).orderBy("task", "method")


@query("select conv_id, turn, trim(regexp_extract('Q? Q? ' || text, '^.*Q\\?((?s:.*))$', 1)) as tail from (select conv_id, turn, replace(text, 'Q?', '') as text from conversations)".replace("\\\\", "\\"))
def reply_tail(table, spark):
    said = F.concat(F.lit("Q? Q? "), F.replace("text", F.lit("Q?"), F.lit("")))
    return table("conversations").select("conv_id", "turn", t.reply_tail(said, "Q?").alias("tail"))


@query("""select doc_id, '<td>' || source || '</td><td>' || lang || '</td><td>' || n_chars || '</td>' as cell from documents""")
def html_cells(table, spark):
    return table("documents").select("doc_id", F.format_string("<td>%s</td><td>%s</td><td>%d</td>", "source", "lang", "n_chars").alias("cell"))


@query(r"""select doc_id, 'out/haze_v2/' || doc_id || '/' || source as uri, regexp_replace(substr('root//' || source || '/a.png', 5), '^/+', '') as rel, regexp_replace(source || '/x.' || lang || '.png', '\.[^./]*$', '') || '_depth.png' as depth,
starts_with('s3://b/' || source, 's3://') as remote, regexp_extract('s3://b/' || source, '^s3://([^/]*)/', 1) as bucket from documents""")
def path_compose(table, spark):
    source, key = F.col("source"), F.concat(F.lit("s3://b/"), F.col("source"))
    return table("documents").select(
        "doc_id", F.concat_ws("/", F.lit("out/haze_v2"), F.col("doc_id").cast("string"), source).alias("uri"), t.relative(F.concat(F.lit("root//"), source, F.lit("/a.png")), F.lit("root")).alias("rel"),
        t.depth_name(F.concat(source, F.lit("/x."), F.col("lang"), F.lit(".png"))).alias("depth"), key.startswith("s3://").alias("remote"), F.regexp_extract(key, "^s3://([^/]*)/", 1).alias("bucket"),
    )


@query("select o_orderkey, o_orderkey || ' vs ' || o_orderpriority as label, regexp_extract(o_orderpriority, '(\\d+)', 1) as id, regexp_full_match(o_orderpriority, '\\d+') as digits from orders".replace("\\\\", "\\"))
def result_label(table, spark):
    p = F.col("o_orderpriority")
    return table("orders").select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit(" vs "), p).alias("label"), t.first_digits(p).alias("id"), p.rlike(r"^\d+$").alias("digits"))


@query(r"select page_id, url from pages where not ends_with(url, '/') and lower(regexp_extract(url, '(\.[^./]+)$', 1)) not in ('.jpg', '.jpeg', '.png', '.bmp', '.webp') and starts_with(url, 'http') order by url")
def listing_filter(table, spark):
    url = F.col("url")
    return table("pages").where(~url.endswith("/") & ~t.is_image(url) & url.startswith("http")).select("page_id", "url").orderBy("url")


@query(r"select p_partkey, regexp_replace('haze_' || lpad((p_partkey % 1000)::varchar, 3, '0') || '.png', '\.png$', '') as tag, regexp_extract('haze_' || lpad((p_partkey % 1000)::varchar, 3, '0') || '.png', '^haze_(\d{3})', 1)::int as idx from part")
def variant_index(table, spark):
    name = F.concat(F.lit("haze_"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit(".png"))
    return table("part").select("p_partkey", F.regexp_replace(name, r"\.png$", "").alias("tag"), F.regexp_extract(name, r"^haze_(\d{3})", 1).cast("int").alias("idx"))


@query("select event_id, coalesce(json_extract_string(props, '$.k'), '-1') as k, coalesce(json_extract_string(props, '$.source'), 'UNKNOWN') as source from events")
def meta_json_default(table, spark):
    return table("events").select("event_id", F.coalesce(F.get_json_object("props", "$.k"), F.lit("-1")).alias("k"), F.coalesce(F.get_json_object("props", "$.source"), F.lit("UNKNOWN")).alias("source"))


@query("select event_id, json_extract_string(p, '$.k') as k from (select event_id, case when event_id % 7 = 0 then 'bad{' else props end as p from events) where json_valid(p)")
def json_guard(table, spark):
    p = F.when(F.col("event_id") % 7 == 0, "bad{").otherwise(F.col("props"))
    return table("events").select("event_id", p.alias("p")).where(F.try_parse_json("p").isNotNull()).select("event_id", F.get_json_object("p", "$.k").alias("k"))
