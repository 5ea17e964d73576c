import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilwork.llm import bpe_codec, chat_format, embedding_dedup, language_id, line_dedup, packing, repeat_removal, simhash_dedup, telephony_audio, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
rng = random.Random(9)
LONG = " ".join("".join(rng.choice("aeinortsh") for _ in range(rng.randint(1, 9))) for _ in range(3000))
SHARED = LONG[500:900]
ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, LONG), (5, LONG), (6, "Don't <|endoftext|> x é 漢字 12"), (None, "a null id"), (7, "start " + SHARED + " end"), (8, "other " + SHARED + " tail"), (9, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({"n_tokens": F.lit("clash"), "fp": F.lit(1.5), "r1": F.lit(None).cast("string"), "lang": F.when(F.col("doc_id") > 3, "en"), "rid": F.lit(0)})


def test_bpe_against_library(docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t in ROWS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in bpe_codec.encode_documents(docs, WORD).collect())
    bpe = bpe_codec.WordBpe(WORD)
    back = bpe_codec.BytesToText(bpe.plain())
    assert "".join(back.feed([i]) for i in bpe.ids("漢字café")) + back.close() == "漢字café "
    word = ("abre" * 2000).encode()
    assert [i for part in bpe.stream(word) for i in part] == bpe._merge([*(bpe.inner[b] for b in word[:-1]), bpe.final[word[-1]]])


def test_counts_against_library(docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = token_counts.count_tokens(docs, PIECE, limit=10).collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or "")), len(lib.encode(t or "")) > 10) for i, t in ROWS]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:4]) for r in got)
    counter = token_counts.PrefixCounter(PIECE)
    for text in ("Hello  world.\nNext, é漢", " lead", "a\n b"):
        assert counter.prefixes(text) == [len(lib.encode(text[:k])) for k in range(len(text) + 1)]


def test_packing_is_whole(docs):
    rows = packing.pack(docs, WORD, size=256, with_ids=True).collect()
    fill, pieces = {}, {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 256 or at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(n * (2 if i == 5 else 1) for i, n in pieces)


def test_media_round_trip(docs):
    for r in telephony_audio.media_columns(docs, media=True).collect():
        data = telephony_audio.parse(bytes(r["media"]))[3]
        assert len(data) == r["payload_bytes"] and len(data) % 64 == 0 and hashlib.sha256(data).hexdigest() == r["payload_sha256"]
        assert data[: r["n_bytes"]] in {(t or "").encode() for _, t in ROWS} and len(r["pcm"]) == 4 * len(data)
    x = (np.sin(np.arange(2000) / 15) * 6000).astype(np.int16)
    y = telephony_audio.decode_adpcm(np.frombuffer(telephony_audio.encode_adpcm(x), np.uint8), 256).reshape(-1)[:2000]
    assert np.abs(x[300:] - y[300:].astype(int)).mean() < 400


def test_repeats_against_brute_force(docs):
    texts = [(t or "").encode() for _, t in ROWS]
    seen = {}
    for b in texts:
        for i in range(len(b) - 199):
            seen[b[i : i + 200]] = seen.get(b[i : i + 200], 0) + 1
    want = []
    for (i, _), b in zip(ROWS, texts):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            gone[k : k + 200] |= seen[b[k : k + 200]] > 1
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in repeat_removal.remove_repeats(docs, with_text=False).collect())


def test_simhash_links(docs):
    rows = {(r["doc_id"], r["component_id"]) for r in simhash_dedup.near_duplicates(docs).collect()}
    assert {(4, 4), (5, 4), (1, 1), (2, 1), (3, 1)} <= rows and len(rows) == len({i for i, _ in ROWS})


def test_line_dedup(spark):
    base = "a line that is long enough to be compared with othersé"
    rows = [(1, f"{base}\nshort\n{base}"), (2, f"{base[:20]}X{base[21:]}\nkept line number two is another one"), (3, base[:-1] + "\nshort"), (4, None), (5, ""), (None, base + "!"), (6, base[:-2] + "??")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rid", F.lit("clash"))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(df).collect()}
    # the null id comes first; "base" is one edit from it and goes, and what is one edit from "base" goes too
    assert got == {1: ("short", 2), 2: ("kept line number two is another one", 1), 3: ("short", 1), 4: (None, 0), 5: ("", 0), None: (base + "!", 0), 6: (base[:-2] + "??", 0)}


def test_bit_parallel_distance(spark):
    words = [("".join(rng.choice("abé") for _ in range(rng.randint(0, 8))), "".join(rng.choice("abé") for _ in range(rng.randint(0, 8)))) for _ in range(400)]
    df = spark.createDataFrame(words, "a string, b string")
    for k in (1, 2):
        assert df.where(line_dedup.within(F.col("a"), F.col("b"), k) != (F.levenshtein("a", "b") <= k)).count() == 0


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, [0.0, 0.0], 1), (7, [None, 1.0], 1), (8, None, 1), (9, [float("nan"), 1.0], 1), (10, [1.0, 0.3], 1), (2, [2.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit("clash"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df, tile=2).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (3, 1, False) and got[10] == (1, 1, False)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 11)) and len(got) == 11


def test_chats(spark):
    said = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, None, None, None), (None, 0, "user", "x"), (2, 1, "assistant", "yo")]
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"]) for r in chat_format.format_chats(spark.createDataFrame(said, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {2: (2, 2), 4: (1, 1)}


def test_language(docs, spark):
    model = language_id.fit(docs)
    got = language_id.classify(docs, model, ["doc_id"]).collect()
    assert len(got) == len(ROWS) and all(r["lang_pred"] == "und" and not r["accepted"] for r in got if r["doc_id"] in (1, 2, 3))
    assert language_id.fit(docs.limit(0)) == {}


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    for df in (bpe_codec.encode_documents(none, WORD), token_counts.count_tokens(none, PIECE), packing.pack(none, WORD), telephony_audio.media_columns(none), repeat_removal.remove_repeats(none), simhash_dedup.near_duplicates(none), line_dedup.dedup_lines(none), language_id.classify(none, {}, ["doc_id"])):
        assert df.count() == 0
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
