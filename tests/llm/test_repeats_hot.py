"""Repeat removal with hot names, hot texts and repeats that only windows share, for several bounds of hot names."""

import random

import numpy as np
import pytest
from tests.llm import brute

from veilwork.llm import repeat_removal

rng = random.Random(4)
TEXT = lambda n: "".join(rng.choice("abcdefgh \né") for _ in range(n))
PASSAGE, OTHER, COPY = TEXT(430), TEXT(205), TEXT(900)


def rows():
    texts = [TEXT(rng.randint(0, 300)) + PASSAGE[rng.randint(0, 40) : 430 - rng.randint(0, 40)] + TEXT(rng.randint(0, 300)) for _ in range(60)]
    texts += [COPY] * 40 + [COPY[:500] + TEXT(50), TEXT(30) + COPY[200:], None, "", OTHER, OTHER + "!", TEXT(1) + OTHER[1:], "a" * 1200, "ab" * 300, "x" * 199, TEXT(700)]
    texts += [TEXT(100) + PASSAGE + TEXT(20) + PASSAGE]
    return list(enumerate(texts))


ROWS = rows()
LEFT = brute.repeats([t for _, t in ROWS])


@pytest.mark.parametrize("hot", [1, 5, 30, 1000])
def test_hot_names_against_brute_force(spark, hot):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["text"]) for r in repeat_removal.remove_repeats(docs, hot=hot).collect()}
    want = {k: (len((t or "").encode()), len((t or "").encode()) - len(b), b.decode("utf-8", "ignore")) for (k, t), b in zip(ROWS, LEFT)}
    assert got == want and sum(r[1] > 0 for r in got.values()) > 90


@pytest.mark.parametrize("length", [64, 120])
def test_other_lengths(spark, length):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    want = dict(zip([k for k, _ in ROWS], map(len, brute.repeats([t for _, t in ROWS], length))))
    assert {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in repeat_removal.remove_repeats(docs, length, hot=7).collect()} == want


def test_equal_texts_over_many_tasks_are_removed_whole(spark):
    copies = spark.createDataFrame([(k, COPY) for k in range(300)], "doc_id long, text string").repartition(16)
    for hot in (10, 10_000):
        assert {(r["n_removed"], r["n_spans"]) for r in repeat_removal.remove_repeats(copies, hot=hot).collect()} == {(len(COPY.encode()), 1)}


def test_window_hashes_tell_windows_apart():
    data = np.frombuffer(TEXT(5000).encode(), np.uint8)
    raw = data.tobytes()
    for base in repeat_removal.BASES:
        h = repeat_removal.string_hashes(data, 200, base)
        assert len(set(h.tolist())) == len({raw[k : k + 200] for k in range(len(raw) - 199)})
