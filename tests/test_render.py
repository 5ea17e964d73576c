import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilwork.functions import atmosphere as at
from veilwork.functions.rand import uniform
from veilwork.operators import kernels, render, reports, samples, textures
from veilwork.sources.image_files import ImageFiles

draw = np.random.default_rng(4)


def read(path):
    return kernels.unpng(path.read_bytes())


def test_draws_are_those_of_the_column(spark):
    row = spark.range(1).select(uniform(7, F.lit("a"), F.lit("b"), F.lit(3)).alias("u")).first()
    assert row["u"] == render.drawn(7, "a", "b", 3)


def test_planes_agree_with_columns(spark):
    image, depth, mask = draw.random((5, 4, 3)), draw.random((5, 4)), draw.random((5, 4))
    want = {c[0]: render.composed(image, depth, c, c[5] and tuple(c[5]), 0.1, mask, 0.4).astype(int) for c in at.config_rows()}
    rows = [(y, x, *map(float, image[y, x]), float(depth[y, x]), float(mask[y, x])) for y in range(5) for x in range(4)]
    px = spark.createDataFrame(rows, "y int, x int, c0 double, c1 double, c2 double, z double, m double").crossJoin(at.resolved(spark))
    h = at.height(F.col("y"), F.lit(5.0), F.col("hmax"))
    found = px.select("filename", "y", "x", *[at.compose(F.col(f"c{c}"), F.col("z"), h, c, F.lit(0.1), F.col("m"), 0.4).alias(f"o{c}") for c in range(3)]).collect()
    assert len(found) == 37 * 20 and all(abs(np.array(r[3:]) - want[r["filename"]][r["y"], r["x"]]).max() <= 1 for r in found)


def test_blur_sides_agree_with_column(spark):
    cases = [(v, u) for v in (30.0, 40.0, 50.0, 70.0, 100.0, 120.0) for u in (0.2, 0.7)]
    got = spark.createDataFrame(cases, "v double, u double").select("v", "u", at.blur_size(F.col("v"), F.col("u")).alias("k")).collect()
    assert all((r["k"] or 0) == render.blur_side("fog", r["v"], r["u"]) for r in got) and render.blur_side("haze", 40, 0) == 0


def test_variants_from_files_to_files(spark, tmp_path):
    spark.dataSource.register(ImageFiles)
    for side in ("img", "depth", "tex"):
        (tmp_path / side).mkdir()
    for name, shape in {"a": (9, 7), "b": (6, 8), "odd": (5, 5)}.items():
        (tmp_path / "img" / f"{name}.png").write_bytes(kernels.png(draw.integers(0, 256, (*shape, 3)).astype(np.uint8)))
        (tmp_path / "depth" / f"{name}_depth.png").write_bytes(kernels.png(draw.integers(0, 256, (4, 4) if name == "odd" else shape).astype(np.uint8)))
    (tmp_path / "img" / "alone.png").write_bytes(kernels.png(np.zeros((3, 3, 3), np.uint8)))
    (tmp_path / "img" / "broken.png").write_bytes(b"no image")
    textures.render(textures.tasks(spark, 4), 16, 12).write.format("image_files").mode("append").save(str(tmp_path / "tex"))
    names = sorted(str(x) for x in (tmp_path / "tex").iterdir())
    assert len(names) == 4 and sum("pathblur" in x for x in names) == 2 and read(tmp_path / "tex" / names[0].split("/")[-1]).shape == (12, 16)
    pairs = render.pixel_pairs(render.decoded(spark, str(tmp_path / "img")), render.decoded(spark, str(tmp_path / "depth")))
    for mask in (None, names):
        out = render.variants(pairs, mask, dither=bool(mask))
        done = out.where("error is null").drop("error")
        got = {r["path"]: bytes(r["data"]) for r in done.collect()}
        assert len(got) == 2 * 37 and got == {r["path"]: bytes(r["data"]) for r in done.repartition(3).collect()}
        assert [(r["path"], r["error"][:10]) for r in out.where("error is not null").collect()] == [("odd", "ValueError")]
    done.write.format("image_files").mode("append").save(str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.png"))) == 74 and read(tmp_path / "out/haze_v2/a/out_fog_120.png").shape == (9, 7, 3)


def test_depth_maps(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    pixels = draw.integers(0, 256, (4, 6, 3)).astype(np.uint8)
    (tmp_path / "in/sub/p.png").write_bytes(kernels.png(pixels))
    root = f"file://{tmp_path}/in"
    row = render.depth_maps(render.decoded(spark, str(tmp_path / "in")), root, lambda: lambda x: x[:, :, 0].astype(float)).first()
    assert row["path"] == "depth/sub/p_depth.png" and row["error"] is None
    assert (kernels.unpng(bytes(row["data"])) == kernels.normalise(pixels[:, :, 0].astype(float), invert=True)).all()
    bad = render.depth_maps(render.decoded(spark, str(tmp_path / "in")), root, lambda: lambda x: x.missing).first()
    assert bad["data"] is None and bad["error"].startswith("AttributeError")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "in"))
    assert [r["path"] for r in render.copies(files.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///")), root).collect()] == ["img/sub/p.png"]


def filtered(pixels, kind):
    """A PNG whose rows all have one filter, by its definition."""
    h, w, n = pixels.shape
    x = np.zeros((h + 1, w + 1, n), int)
    x[1:, 1:] = pixels
    a, b, c = x[1:, :-1], x[:-1, 1:], x[:-1, :-1]
    p = a + b - c
    paeth = np.where((abs(p - a) <= abs(p - b)) & (abs(p - a) <= abs(p - c)), a, np.where(abs(p - b) <= abs(p - c), b, c))
    lines = (x[1:, 1:] - [np.zeros_like(a), a, b, (a + b) // 2, paeth][kind]) % 256
    raw = b"".join(bytes([kind]) + lines[y].astype(np.uint8).tobytes() for y in range(h))
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[n], 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("n", [1, 3, 4])
def test_png_filters(kind, n):
    pixels = draw.integers(0, 256, (5, 6, n)).astype(np.uint8)
    assert (kernels.unpng(filtered(pixels, kind)).reshape(pixels.shape) == pixels).all()


def test_texture_tasks(spark):
    rows = textures.tasks(spark, 41, seed=3).collect()
    assert sum(r["blurred"] for r in rows) == 20 and len({r["path"] for r in rows}) == 41
    assert all(a <= r[k] <= b for r in rows for k, (a, b) in (textures.REAL | textures.WHOLE).items())
    assert rows == textures.tasks(spark, 41, seed=3).collect()


def test_reports(spark, tmp_path):
    cells = spark.createDataFrame([("d/a", "T <1>", 1, "gt.png", "clean & bright"), ("d/a", "T <1>", 2, None, None), ("b", None, 1, "x.png", None)], "key string, title string, place int, field string, caption string")
    page = open(reports.write_gallery(cells, str(tmp_path / "page"), "A & B", "seed 42")).read()
    assert page.count("<section>") == 2 and "T &lt;1&gt;" in page and "images/d__a__gt.png" in page and "clean &amp; bright" in page and page.index("images/b__x.png") < page.index("d__a")
    sheet = reports.contact_sheet([[np.full((4, 8, 3), 9.0)], [np.full((2, 2, 3), 7.0), np.full((2, 2, 3), 7.0)], []], height=4)
    assert sheet.shape == (8, 8, 3) and (sheet[:4] == 9).all() and (sheet[4:] == 7).all() and reports.contact_sheet([]).shape == (1, 1, 3)
    reports.write_sheet([[np.zeros((3, 3, 3))]], str(tmp_path / "sheet.png"), 8)
    assert read(tmp_path / "sheet.png").shape == (8, 8, 3)
    matched = samples.match_originals(spark.createDataFrame([("x",), ("y",), ("z",)], "base string"), spark.createDataFrame([("r/y.png",), ("q/y.png",)], "path string"))
    assert tuple(reports.match_counts(matched).first()) == (3, 1, 2)
    reports.write_missing(matched, str(tmp_path / "missing"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "missing")).collect()] == ["x", "z"]
    reports.write_summary(spark.createDataFrame([("t", "m", 1.5)], "task string, method string, removal_pct double"), str(tmp_path / "summary"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "summary")).collect()] == [("t", "m", "1.5")]


def test_render_queries_against_files(spark):
    """The queries without SQL, recomputed plane by plane on the driver."""
    import hashlib

    from veilwork.plans import registry

    sf = "/root/testdata/sf0.001"
    planes = {r["vec_id"]: np.floor(np.clip(np.array(r["embedding"], np.float32).astype(float) + 0.5, 0, 1) * 255).astype(np.uint8).reshape(8, 8) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    sha = lambda x: hashlib.sha256(kernels.png(x)).hexdigest()
    depths = {r["path"]: r["sha256"] for r in registry.QUERIES["depth_maps"](spark, sf).collect()}
    assert depths == {f"depth/{k}_depth.png": sha(kernels.normalise(v.astype(float), invert=True)) for k, v in planes.items()}
    got = {r["path"]: r["sha256"] for r in registry.QUERIES["render_variants"](spark, sf).collect()}
    assert len(got) == 37 * sum(k + 1 in planes for k in planes)
    u = render.drawn
    for k in [k for k in planes if k + 1 in planes]:
        for c in at.config_rows():
            key = (42, k, c[0])
            air = c[5] and tuple(min(max(x + int(u(*key, "air", i) * 11) - 5, 0), 255) for i, x in enumerate(c[5]))
            near, side = (255 - planes[k + 1].astype(float)) / 255, render.blur_side(c[1], c[4], u(*key, "coin"))
            want = render.composed(np.repeat(planes[k][:, :, None], 3, 2) / 255, kernels.gaussian_blur(near, side) if side else near, c, air, 0.2 * u(*key, "baseline"))
            assert got[f"haze_v2/{k}/{c[0]}"] == sha(want)
    made = {r["path"]: r["sha256"] for r in registry.QUERIES["texture_render"](spark, sf).collect()}
    assert made == {r["path"]: sha(textures.texture(r.asDict(), 64, 48)) for r in textures.tasks(spark, 16).collect()}
