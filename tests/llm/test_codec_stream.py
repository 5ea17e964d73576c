"""The streaming transducer and decoder against the library: odd texts, long runs and words, bounded memory."""

import hashlib
import random
import tracemalloc

import pytest

from veilwork.llm import bpe_codec

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = public_tokenizers.path("word_bpe_49k.json")
rng = random.Random(21)
PARTS = ["a", "Don't", "we'll", "'s", "<|endoftext|>", "<|startoftext|>", "<|", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "é", "漢字", "Σς", "İ", "ß", "12", "½", "...", "!?", "x" * 70, "\U0001f600", "‍", "\0", "ab" * 500]


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(WORD)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("segment", [7, 64, 1 << 16])
def test_odd_texts_against_the_library(codec, library, segment, monkeypatch):
    monkeypatch.setattr(bpe_codec, "SEGMENT", segment)
    monkeypatch.setattr(bpe_codec.segments, "__defaults__", (segment,))
    monkeypatch.setattr(bpe_codec.WordBpe.long_run, "__defaults__", (segment,))
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))
        assert codec.run(text) == want(library, text), repr(text)


def test_long_words_and_runs_against_the_library(codec, library):
    letters = "".join(rng.choice("etaoinshr") for _ in range(200_000))
    for text in (letters, "abre" * 40_000, "漢字" * 50_000, letters + "1" * 70_000 + "!" * 70_000, f"{letters}<|endoftext|>{letters}", "é" * 140_000):
        assert codec.run(text) == want(library, text)


def test_transducer_emits_the_same_at_any_cut(codec):
    bpe = codec.bpe
    for _ in range(30):
        data = "".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 3000))).encode()
        assert [i for part in bpe.stream(data) for i in part] == bpe._merge([*(bpe.inner[b] for b in data[:-1]), bpe.final[data[-1]]])


def test_plain_text_comes_back(codec):
    rows = []
    codec.run("Hello, wörld 漢字!", lambda *x: rows.append(x))
    assert "".join(x[2] for x in rows) == "hello , wörld 漢字 ! "
    back = bpe_codec.BytesToText(codec.plain)
    cut = [i for i, x in enumerate(codec.plain) if x == "é".encode()[:1]]
    assert back.feed(cut) == "" and back.close() == "�"


def test_memory_does_not_grow_with_the_text(codec):
    line = " ".join(rng.choice(["stream", "of", "words", "1999", "Ünicode"]) for _ in range(20)) + "\n"
    peaks = []
    for copies in (20_000, 80_000):
        text = line * copies
        codec.run(line)
        tracemalloc.start()
        codec.run(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] + 1e6 and peaks[1] < 30e6
