"""Operators without SQL against plain restatements of their contracts, on whole small tables and on odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

import corpus_pipeline
from veilwork.llm import chat_format, language_id, line_dedup, packing, repeat_removal, simhash_dedup

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
rng = random.Random(3)
WORDS = ["".join(rng.choice("aeinortsh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
PASSAGE = " ".join(rng.choice(WORDS) for _ in range(90))
LONG = "\n".join(" ".join(rng.choice(WORDS) for _ in range(12)) for _ in range(2500))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n", "en", "a", 3), (4, LONG, "en", "hot", 9), (5, LONG, "de", "hot", 9), (6, f"{PASSAGE}\none", None, "hot", 1),
    (7, f"before it {PASSAGE}", "en", None, 1), (8, "123 456 ...", "fr", "b", 1), (9, "É漢字 " * 400, "fr", "b", 1), (None, "a row without an id", "en", "b", 1), (10, "twice the same row", "en", "c", 1), (10, "twice the same row", "en", "c", 1),
]


def encode():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: lib.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_simhash_fingerprints_and_groups(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(-k, x) for k, x in enumerate(["", " ", None, "one two", "A b C d", "a B c D"], 1)]
    items = [(k, brute.fingerprint(t)) for k, t in rows]
    want = [(k, f"{fp:016x}", c) for (k, fp), c in zip(items, brute.groups(items, lambda x, y: (x ^ y).bit_count() <= 4))]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("tile", [8, 2048])
def test_simhash_links_in_hot_lists(spark, tile):
    draw = np.random.default_rng(tile)
    base = [int(x) for x in draw.integers(0, 1 << 63, 12)]
    fps = {b ^ sum(1 << int(k) for k in set(draw.integers(0, 64, draw.integers(0, 8)).tolist())) for b in base for _ in range(40)}
    fps |= {(f & ~(0xFFFFFF << 8)) | (0xABCDEF << 8) for f in fps}  # many that share three bytes
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    found = simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tile=tile).collect()
    edges = {(r["a"], r["b"]) for r in found}
    items = [(k, x) for k, x in enumerate(signed)]
    place = {x: k for k, x in items}
    parent = list(range(len(items)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = sorted((find(place[a]), find(place[b])))
        parent[y] = x
    want = brute.groups(items, lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= 4)
    assert [find(k) for k in range(len(items))] == want and len(set(want)) > 1


def test_line_dedup_on_whole_table(documents):
    rows = list(texts_of(documents).items())
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(documents).collect()}
    want = brute.lines(rows)
    assert {k: t for k, (t, _) in got.items()} == want and any(n for _, n in got.values())


def test_packing_on_whole_table(documents):
    brute.check_packing(packing.pack(documents.repartition(3), public_tokenizers.path("word_bpe_49k.json")).collect(), texts_of(documents), 2048, encode())


def test_language_on_held_out_rows(documents):
    rows = {r["doc_id"]: r["lang"] for r in documents.collect()}
    found = language_id.classify(documents, language_id.fit(documents), ["doc_id"]).collect()
    held = [(r["lang_pred"], rows[r["doc_id"]]) for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and rows[r["doc_id"]]]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_training_is_bounded(documents):
    small = language_id.fit(documents, rows_per_language=2, most_languages=2, dictionary_bytes=500, most_chars=100)
    assert len(small) == 2 and all(len(x) <= 500 for x in small.values())


def test_chats_with_clashing_columns_nulls_and_ties(spark):
    said = [(1, 0, "user", "hi"), (2, 0, None, None), (2, 0, "user", "a"), (2, 0, "user", "b"), (3, 0, "user", "b"), (3, 0, None, None), (3, 0, "user", "a"), (4, None, "user", ""), (5, 0, "user", "hi"), (5, 1, "user", "x" * 200_000)]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumns({"n": F.lit(1), "p": F.lit("q"), "n_turns": F.lit(None)})
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"]) for r in chat_format.format_chats(df).collect()}
    assert got == {2: (3, 2), 4: (1, 1), 5: (2, 1)}


def test_pipeline_against_brute_force(spark, documents):
    docs = {r["doc_id"]: r["text"] for r in documents.collect()}
    model = language_id.Classifier(language_id.fit(documents))
    docs = {k: t for k, t in docs.items() if model.predict(t)[0] != language_id.UNKNOWN and model.predict(t)[1] >= 0.3}
    stages, now = dict(corpus_pipeline.STAGES), documents
    now = stages["language_id"](spark, now, SF)
    assert texts_of(now) == docs and now.columns == corpus_pipeline.COLUMNS
    now, docs = stages["line_dedup"](spark, now, SF), brute.lines(list(docs.items()), exact=1, most=corpus_pipeline.LINE_EDITS)
    assert texts_of(now) == docs and now.columns == corpus_pipeline.COLUMNS
    items = [(k, brute.fingerprint(t, corpus_pipeline.SHINGLE)) for k, t in docs.items()]
    docs = {k: docs[k] for (k, _), c in zip(items, brute.groups(items, lambda x, y: (x ^ y).bit_count() <= 4)) if k == c}
    now = stages["simhash_near_dedup"](spark, now, SF)
    assert texts_of(now) == docs and now.columns == corpus_pipeline.COLUMNS
    docs = dict(zip(docs, (b.decode("utf-8", "ignore") for b in brute.repeats(docs.values()))))
    now = stages["suffix_array_dedup"](spark, now, SF)
    assert texts_of(now) == docs and now.columns == corpus_pipeline.COLUMNS
    assert all(r["n_chars"] == len(docs[r["doc_id"]]) for r in now.collect())
    brute.check_packing(corpus_pipeline.run(spark, SF).collect(), docs, 2048, encode())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_documents(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    odd = spark.createDataFrame(ODD, COLUMNS).withColumns({"rid": F.lit(1), "fp": F.lit("x"), "accepted": F.lit(False), "component_id": F.lit(None)})
    rows = stage(spark, odd, SF).collect()
    assert stage(spark, odd.limit(0), SF).count() == 0
    ids = sorted(r["doc_id"] or 0 for r in rows)
    if name == "language_id":
        assert {r["doc_id"] for r in rows} <= {4, 5, 6, 7, 9, 10, None}
    elif name == "simhash_near_dedup":  # of two copies the first stays; texts without words are copies of each other
        assert ids == [0, 1, 4, 6, 7, 8, 9, 10, 10]
    elif name == "packing":
        assert set(ids) == {0, *range(1, 11)}
    else:
        assert ids == sorted(r[0] or 0 for r in ODD)
        texts = {r["doc_id"]: r["text"] for r in rows}
        assert texts[8] == ODD[7][1] and not texts[1]
        if name == "suffix_array_dedup":
            assert texts[4] == texts[5] == "" and PASSAGE[50:150] not in texts[6]
            assert [r["text"] or "" for r in rows if r["doc_id"] == 10] == ["twice the same row"] * 2
        if name == "line_dedup":
            assert texts[4] == LONG and texts[5] == ""
