"""Rejection by margin: ties, junk and texts of two languages go, clean short texts stay, for any number of languages."""

import random

import pytest

from veilwork.llm import language_id

rng = random.Random(11)
NAMES = ["aa", "bb", "cc", "dd"]
WORDS = {k: ["".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(rng.randint(3, 9))) for _ in range(80)] for k in NAMES}


def text(lang, words):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(words))


@pytest.fixture(scope="module")
def models():
    contents = {k: "\n".join(text(k, 60) for _ in range(60)).encode() for k in NAMES}
    return {n: language_id.Classifier({k: contents[k] for k in NAMES[:n]}) for n in (1, 2, 3, 4)}


def accepted(spark, contents, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["accepted"] for r in sorted(language_id.classify(rows, contents, ["doc_id"]).collect())]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_junk_goes_and_clean_texts_stay(models, n):
    junk = ["".join(rng.choice("qxzjfc0123456789") for _ in range(k)) for k in (12, 100, 1000, 20_000)]
    assert all(models[n].predict(x)[1] < 0.3 for x in junk)
    for lang in NAMES[:n]:
        for words in (15, 40, 400, 4000):
            found, score = models[n].predict(text(lang, words))
            assert found == lang and score >= 0.3


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("words", [40, 400, 4000])
def test_half_and_half_goes(models, n, words):
    assert models[n].predict(f"{text('aa', words)} {text('bb', words)}")[1] < 0.3


def test_ties_go_through_the_operator(spark):
    same = "\n".join(text("aa", 60) for _ in range(40)).encode()
    clean = text("aa", 40)
    assert accepted(spark, {"aa": same, "bb": same}, [clean]) == [False]
    other = "\n".join(text("bb", 60) for _ in range(40)).encode()
    assert accepted(spark, {"aa": same, "bb": other}, [clean, "QZXJ " * 3, None, ""]) == [True, False, False, False]
