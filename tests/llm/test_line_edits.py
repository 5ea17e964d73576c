"""Line dedup with more than one edit against all pairs of lines."""

import random

import pytest

from veilwork.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, most, least=24):
    first = {}
    for doc_id, line in rows:
        if len(line) >= least:
            first.setdefault(line, doc_id)
    order = list(first)
    near = {b for k, b in enumerate(order) if any(abs(len(a) - len(b)) <= most and distance(a, b) <= most for a in order[:k])}
    return {d: "" if len(x) >= least and (x in near or first[x] != d) else x for d, x in rows}


@pytest.mark.parametrize("most", [1, 2, 3])
def test_lines_within_more_edits(spark, most):
    rng = random.Random(most)
    lines = []
    for size in (24, 25, 27, 40, 90, 150):
        base = "".join(rng.choice("abcdé ") for _ in range(size - 2))
        for edits in (0, 1, 2, 2, 3, 3, 4, 5):
            line = list(f"x{base}y")
            for _ in range(edits):
                k = rng.randrange(len(line) + 1)
                line[k : k + rng.choice([0, 0, 1, 1, 2])] = rng.choice(["", "q", "w", "é"])
            lines.append("".join(line).strip(" "))
    base = "Posted on the 14th of May 2024 by the editors of this page. All rights are reserved."
    lines += [base, base.replace("14", "27"), base.replace("14", "9").replace("May", "Mai")]
    rng.shuffle(lines)
    rows = list(enumerate(lines))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect()}
    want = brute(rows, most)
    assert got == want and "" in want.values()
