"""Decoding of samples, trees of evaluation files, manifests and plans."""

import json
import os

import pytest

from veilwork.operators import decode, manifests, samples

MEMBERS = [
    ("s0", 0, "ots/a.json", b'{"source": "OTS", "base_name": "b1", "final_idx": 7}'), ("s0", 1, "ots/a.gt.png", b"old"), ("s0", 2, "ots/a.gt.jpg", b"jpg"), ("s0", 3, "ots/a.haze_001.png", b"one"),
    ("s0", 4, "ots/a.haze_001.txt", b"out_fog_\xff120"), ("s0", 5, "ots/a.haze_000.png", b"zero"), ("s1", 0, "ots/a.gt.png", b"new"), ("s1", 1, "noext", b"z"),
    ("s1", 2, "c.json", b"{}"), ("s1", 3, "c.gt.png", b"x"), ("s1", 4, "d.json", b"bad{"), ("s1", 5, "d.haze_000.png", b"x"),
    ("s1", 6, "t/e.json", b'{"effect_type": "Glare"}'), ("s1", 7, "t/e.gt.png", b"g"), ("s1", 8, "t/e.flare.png", b"f"), ("s1", 9, "t/e.separate.png", b"s"),
]


@pytest.fixture(scope="module")
def found(spark):
    return samples.samples(spark.createDataFrame(MEMBERS, "shard string, ordinal int, member string, content binary"), [])


def test_variants_with_tags_and_defaults(found):
    (r,) = decode.variants(found).collect()
    assert (r["key"], r["source"], r["base_name"], r["gt_field"], bytes(r["gt"])) == ("ots/a", "OTS", "b1", "gt.png", b"new")
    assert [(v["field"], v["tag"], bytes(v["data"])) for v in r["variants"]] == [("haze_000.png", "", b"zero"), ("haze_001.png", "out_fog_120", b"one")]
    assert decode.exploded(decode.variants(found)).count() == 2
    one = {decode.one_variant(decode.variants(found), seed).first()["field"] for seed in range(8)}
    assert one == {"haze_000.png", "haze_001.png"}


def test_triplets(found):
    (r,) = decode.triplets(found).collect()
    assert (r["key"], r["effect_type"], r["scene"], r["base_name"], bytes(r["flare"])) == ("t/e", "Glare", "Unknown", "e", b"f")
    assert decode.triplets(found, complete=False).count() == found.count() == 3
    assert sorted(x["key"] for x in decode.shuffled(found).collect()) == ["c", "ots/a", "t/e"]


def test_manifest_and_its_join(spark, found, tmp_path):
    (tmp_path / "finalist.json").write_text(json.dumps([{"final_idx": 7, "scene": "s", "more": 1}, {"final_idx": 8}]))
    records = manifests.manifest(spark, str(tmp_path / "finalist.json"), "final_idx long, scene string")
    assert records.count() == 2 and [(r["key"], r["scene"]) for r in manifests.with_finalists(found, records).collect()] == [("ots/a", "s")]


def test_evaluation_tree(spark):
    paths = ["r/t1/input/row_1_a.png", "r/t1/m1/1.png", "r/t1/m1/2.jpg", "r/t1/m1/3.PNG", "r/t1/m1/deep/1.png", "r/t2/m1/1.png", "r/x.png"]
    files, inputs = samples.evaluation_tree(spark.createDataFrame([(p,) for p in paths], "path string"), "r")
    assert sorted(map(tuple, files.collect())) == [("t1", "m1", "r/t1/m1/1.png"), ("t1", "m1", "r/t1/m1/2.jpg")] and [tuple(r) for r in inputs.collect()] == [("t1", paths[0])]


def test_originals_textures_and_plans(spark, tmp_path):
    archive = spark.createDataFrame([("r/y.png",), ("s/y.bmp",), ("q/z.JPG",)], "path string")
    matched = samples.match_originals(spark.createDataFrame([("x",), ("y",), ("z",)], "base string"), archive)
    assert {r["base"]: r["path"] for r in matched.collect()} == {"x": None, "y": "r/y.png", "z": "q/z.JPG"}
    assert [r["path"] for r in manifests.textures(archive.union(spark.createDataFrame([("r/a.txt",), ("r/d/b.png",)], "path string")), "r/").collect()] == ["r/y.png"]
    with pytest.raises(ValueError):
        manifests.link_plan(matched, "o", "move")
    (tmp_path / "y.png").write_bytes(b"pixels")
    own = spark.createDataFrame([("y", str(tmp_path / "y.png")), ("n", str(tmp_path / "none.png")), ("x", None)], "base string, path string")
    for mode in manifests.MODES:
        done = {os.path.basename(r["dst"]): r["error"] for r in manifests.put_in_place(manifests.link_plan(own, str(tmp_path / "out"), mode)).collect()}
        assert done["y.png"] is None and (tmp_path / "out/y.png").read_bytes() == b"pixels" and (tmp_path / "out/y.png").is_symlink() == (mode == "symlink")
        assert set(done) == {"y.png", "n.png"} and (mode == "symlink" or done["n.png"])
