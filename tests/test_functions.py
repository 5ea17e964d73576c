import io
import os
import tarfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from veilwork.functions import atmosphere as at
from veilwork.functions import text as t
from veilwork.operators import kernels, reports, samples
from veilwork.operators.sampling import allocation
from veilwork.plans import registry
from veilwork.sources.image_files import ImageFiles
from veilwork.sources.tar_shards import TarShards

SF = "/root/testdata/sf0.001"


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "x string").select(*columns).first())


@pytest.mark.parametrize("name,key,field", [("hazespace/abc.haze_000.png", "hazespace/abc", "haze_000.png"), ("noext", None, None), ("a.b/c.json", "a.b/c", "json")])
def test_member_split(spark, name, key, field):
    assert one(spark, name, t.member_key(F.col("x")), t.member_field(F.col("x"))) == (key, field)


TAGS = {"out_fog_120": "fog", "out_fog_valley_h30": "fog_valley", "out_smoke_coolgray_1000": "smoke_coolgray", "out_haze_brownish-dust_v100": "haze_brownish-dust", "out_": "", "out__5": "", "out_120": "120", "out_1_2": "1", "plain_x_1": "plain", "out_a_v1.5": "a", "out_a_v.": "a_v."}


def test_tag_types(spark):
    got = spark.createDataFrame([(k,) for k in TAGS], "x string").select("x", t.tag_type(F.col("x"))).collect()
    assert dict(map(tuple, got)) == TAGS


@pytest.mark.parametrize("reply,score", [("评分：85%", 85.0), ("Score: 85%", 85.0), ("score:7.5", 7.5), ("Score: 101%", None), ("Score: 101% Score: 50%", None), ("none", None)])
def test_scores(spark, reply, score):
    assert one(spark, reply, t.score(F.col("x"))) == (score,)


@pytest.mark.parametrize("sizes,total,least,want", [({"a": 1, "b": 100}, 10, 1, {"a": 1, "b": 8}), ({"a": 5, "b": 5, "c": 5}, 2, 1, {"a": 1, "b": 1, "c": 1}), ({"S": 1656, "R": 1655, "G": 817, "H": 817}, 24, 2, {"S": 7, "R": 7, "G": 5, "H": 5})])
def test_allocation(spark, sizes, total, least, want):
    rows = spark.createDataFrame([(k,) for k, n in sizes.items() for _ in range(n)], "s string")
    assert {r["s"]: r["alloc"] for r in allocation(rows, "s", total, least).collect()} == want


@pytest.mark.parametrize("config,i,z,h,want", [("out_fog_120.png", 0.5, 1, 0, 238), ("out_fog_120.png", 0.5, 0, 0, 128), ("out_fog_120.png", 0.5, 1, 100, 201), ("out_fog_valley_h30.png", 0.5, 1, 120, 144), ("out_haze_pale-gray_v100.png", 0.2, 0.5, 0, 203), ("out_smoke_heavy.png", 0.2, 0.5, 30, 113)])
def test_atmosphere(spark, config, i, z, h, want):
    row = at.resolved(spark).where(F.col("filename") == config).select(at.compose(F.lit(i), F.lit(float(z)), F.lit(float(h)), 0)).first()
    assert abs(row[0] - want) <= 1 and len(at.config_rows()) == 37


def test_tar_source_and_file_sink(spark, tmp_path):
    spark.dataSource.register(TarShards)
    spark.dataSource.register(ImageFiles)
    with tarfile.open(tmp_path / "shard-0.tar", "w") as tar:
        for name, data in {"ots/a.json": b'{"source": "OTS"}', "ots/a.gt.png": b"x", "ots/b.json": b"bad{", "ots/b.gt.png": b"y", "noext": b"z"}.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    rows = spark.read.format("tar_shards").load(str(tmp_path))
    assert rows.count() == 5 and spark.read.format("tar_shards").option("prefix", "ots/").option("suffix", ".json").load(str(tmp_path)).count() == 2
    kept = samples.samples(rows, ["gt.png"])
    assert [r["key"] for r in kept.collect()] == ["ots/a"]
    kept.select(F.concat("key", F.lit(".png")).alias("path"), F.col("fields")["gt.png"].alias("data")).write.format("image_files").mode("append").save(str(tmp_path / "out"))
    assert open(os.path.join(tmp_path, "out/ots/a.png"), "rb").read() == b"x"


def test_png_is_read_by_spark(spark, tmp_path):
    pixels = np.arange(4 * 5 * 3, dtype=np.uint8).reshape(4, 5, 3)
    (tmp_path / "a.png").write_bytes(kernels.png(pixels))
    image = spark.read.format("image").load(str(tmp_path)).first()["image"]
    assert (image["height"], image["width"]) == (4, 5)
    assert bytes(image["data"]) == pixels[:, :, ::-1].tobytes()


def test_kernels():
    flat = np.full((8, 8), 3.0)
    assert (kernels.normalise(flat) == 0).all() and np.allclose(kernels.gaussian_blur(flat, 7), 3) and np.allclose(kernels.resize(flat, 5, 9), 3)
    dx, dy = kernels.vector_field(8, 8, 5.0, 3, 1)
    size = np.hypot(dx, dy)
    assert (np.isclose(size, 1) | (size == 0)).all() and np.allclose(kernels.advect(flat, dx, dy, 4, 1.0), 3)


def test_evaluation(spark):
    files = spark.createDataFrame([("t", "m", "o/out_12.png"), ("t", "m", "o/out_7.png"), ("t", "input", "i/x.png")], "task string, method string, path string")
    inputs = spark.createDataFrame([("t", "i/row_12_x.png"), ("t", "i/row_012_x.png")], "task string, path string")
    scored, lost = samples.evaluate(files, inputs, _say)
    assert [tuple(r) for r in samples.summary(scored).collect()] == [("t", "m", 80.0)] and lost.count() == 1


def _say(a, b):
    return "Score: 80%" + a.str.slice(0, 0)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def tidy(v):
    return f"{v:.9g}" if isinstance(v, float) else tuple(map(tidy, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_against_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(registry.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(tidy(r[names.index(c)]) for c in columns)) for r in result.fetchall())
    assert sorted(repr(tuple(tidy(r[c]) for c in columns)) for r in df.collect()) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_gallery_image_names(spark):
    cells = spark.createDataFrame([("d/a", None, 1, "gt", None)], "key string, title string, place int, field string, caption string")
    assert ["images/d__a__gt" in reports.sections(cells).first()["html"], "images/d__a.gt" in reports.sections(cells, ".").first()["html"]] == [True, True]


def test_gallery_sections_with_nulls(spark, tmp_path):
    rows = [(1, 2, "user", 'a "b" & <c>'), (1, None, "user", "last"), (1, 1, None, "x"), (1, 0, "user", None), (2, 1, None, None), (None, 1, "user", "y"), (3, 1, "a/b", "same"), (3, 1, "a/b", "same"), (3, 1, "a", "z")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = sorted(map(repr, con.execute(registry.SQL["gallery_sections"]).fetchall()))
    assert sorted(repr((r["key"], r["html"])) for r in registry.QUERIES["gallery_sections"](spark, str(tmp_path)).collect()) == want
