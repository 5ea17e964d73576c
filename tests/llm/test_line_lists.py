"""Line dedup with long lists of one template, hot lines and long texts."""

import random
import time

import pytest
from pyspark.sql import functions as F
from tests.llm.test_line_edits import brute

from veilwork.llm import common, line_dedup

rng = random.Random(8)


def template(n, digits):
    return [f"Posted on page {rng.randrange(10**digits):0{digits}d} by the editors of this site, all rights reserved" for _ in range(n)]


@pytest.mark.parametrize(("most", "short"), [(1, 1), (1, 16), (2, 1), (2, 16)])
def test_template_lines_against_all_pairs(spark, most, short):
    lines = template(150, 3) + [x.replace("page ", "page") for x in template(40, 3)] + [x + "!" for x in template(30, 4)]
    lines += ["é" + x[1:] for x in template(30, 3)]
    rng.shuffle(lines)
    rows = list(enumerate(lines))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), most=most, short=short).collect()}
    assert got == brute(rows, most) and "" in got.values()


def test_pairs_of_a_template_are_linear(spark):
    counts = []
    for n in (500, 1000, 2000):
        rows = [(k, x) for k, x in enumerate(template(n, 8))]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rid": F.col("doc_id"), "rid2": F.lit(0)})
        lines = line_dedup._lines(docs, 24)
        shared = line_dedup._shared(line_dedup._keys(lines))
        texts = line_dedup._texts(lines, shared)
        counts.append(line_dedup._candidates(shared, texts, 1, 16).count())
        common.release()
    assert counts[2] <= 4 * 2000 and counts[2] < 4 * counts[1]  # all pairs of a quarter's lists would be about 200,000


def test_hot_lines_over_many_documents(spark):
    hot = ["All rights reserved.", "Share this page with your friends, neighbours and pets", "Share this page with your friends, neighbours and pet"]
    rows = [(k, "\n".join([rng.choice(hot), f"line of document {k}, which has words of its own: {k * k}", rng.choice(hot)])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(docs, exact_chars=1).collect()}
    left = [x for lines in got.values() for x in lines if x in hot]
    assert left.count(hot[0]) == 1 and len(left) == 2


def test_repeated_rows_and_shared_ids(spark):
    rows = [(1, "a line that is long enough to be compared"), (1, "a line that is long enough to be compared"), (1, "another one, also long enough to be compared"), (2, "a line that is long enough to be compared")]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([rows[0], rows[1], rows[2], (2, "")])


def test_time_is_linear_in_a_text_s_lines(spark):
    took = []
    for n in (1000, 40_000, 160_000):
        text = "\n".join(f"line {k % (n // 2)} of a very long document, twice" for k in range(n))
        docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
        start = time.time()
        r = next(r for r in line_dedup.dedup_lines(docs, min_chars=10**6, exact_chars=1).collect() if r["doc_id"] == 1)
        took.append(time.time() - start)
        assert (r["n_lines"], r["n_removed"]) == (n, n // 2) and r["text"] == "\n".join(text.split("\n")[: n // 2])
        common.release()
    assert took[2] < took[0] + 6 * max(took[1] - took[0], 3)


def test_pieces_never_reject_near_lines(spark):
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(24, 60)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.choice([0, 1])] = rng.choice(["", "x", "a", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for most in (2, 3):
        told = df.select((F.levenshtein("a", "b") <= most).alias("near"), line_dedup._most_pieces(F.col("a"), F.col("b"), most).alias("may"), line_dedup._near(F.col("a"), F.col("b"), F.lit(0), most).alias("got")).collect()
        assert all(r["near"] == r["got"] and (r["may"] or not r["near"]) for r in told) and any(r["near"] for r in told)


def test_near_copies_of_one_long_line(spark):
    words = ["".join(rng.choice("etaoinshrd") for _ in range(rng.randint(2, 8))) for _ in range(60)]
    lines = []
    for k in range(120):
        line = list(words)
        if k % 3:
            line.insert(rng.randrange(60), "".join(rng.choice("klmbegh") for _ in range(4)))
        else:
            line[rng.randrange(60)] += rng.choice(["s", "", "ed"])
        lines.append(" ".join(line))
    rows = list(enumerate(lines))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), most=2).collect()}
    assert got == brute(rows, 2) and "" in got.values()
