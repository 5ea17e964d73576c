"""Sum-of-squares packing against a plain restatement, piece by piece, and bounds of what stays open."""

import random

import pytest

from veilwork.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = public_tokenizers.path("word_bpe_49k.json")


def squares(count):
    return sum(x * x for x in count.values())


def moved(count, size, h, to):
    """Counts of open windows by level after one goes from level h (0: a new one) to a level (the size: full)."""
    count = dict(count)
    if h:
        count[h] -= 1
    if to < size:
        count[to] = count.get(to, 0) + 1
    return count


def restated(rests, size, cost):
    """rests: lengths. Closed windows as lists of (rest, start, length), and which rests were cut before the end."""
    windows, closed = [], []  # open: [level, pieces]
    for k, n in enumerate(rests):
        start = 0
        while n:
            count = {}
            for h, _ in windows:
                count[h] = count.get(h, 0) + 1
            options = []
            for h in [0, *count]:
                part = min(n, size - h)
                after = moved(count, size, h, h + part)
                change = squares(after) - squares(count)
                if part < n:
                    change += (squares(moved(after, size, 0, n - part)) - squares(after)) + cost
                options.append((change, part < n, -h))
            _, _, h = min(options)
            part = min(n, size + h)
            if h:
                at = max(i for i, w in enumerate(windows) if w[0] == -h)  # the one that came to this level last
                level, pieces = windows.pop(at)
            else:
                level, pieces = 0, []
            pieces.append((k, start, part))
            if level + part == size:
                closed.append(pieces)
            else:
                windows.append([level + part, pieces])
            start, n = start + part, n - part
    # from the fullest on, windows are filled with the tokens of the emptiest
    by_level = {}
    for h, pieces in windows:
        by_level.setdefault(h, []).append(pieces)
    left = [[h, pieces] for h in sorted(by_level, reverse=True) for pieces in by_level[h]]
    queue = [(w, t) for w in range(len(left)) for t in left[w][1]]
    total = sum(h for h, _ in left)
    return closed, [pieces for _, pieces in left], total, len(queue)


@pytest.mark.parametrize(("size", "cost"), [(16, 0), (16, 8), (64, 2), (64, 8), (7, 3)])
def test_levels_against_a_restatement(size, cost):
    rng = random.Random(size * 10 + cost)
    for kind in (lambda: rng.randint(1, size - 1), lambda: rng.choice([size * 3 // 4, size // 3 + 1]), lambda: size - 2, lambda: min(size - 1, 1 + int(rng.expovariate(4 / size)))):
        rests = [kind() for _ in range(250)]
        packer = packing.Packer(size, 0, cost)
        for k, n in enumerate(rests):
            packer.rest(k, 0, b"".join(i.to_bytes(4, "little") for i in range(n)))
        got = {}
        for doc, start, ids, sequence, _ in packer.out:
            got.setdefault(sequence, []).append((doc, start, len(ids) // 4))
        closed, still, total, _ = restated(rests, size, cost)
        assert [got[k] for k in sorted(got)] == closed
        held = sorted([(d, s, len(i) // 4) for d, s, i in pieces] for at in packer.open for pieces in at)
        assert held == sorted(still)
        packer.finish()
        check_end(packer, rests, size, closed, still, total)


def check_end(packer, rests, size, closed, still, total):
    fill, of = {}, {}
    for doc, start, ids, sequence, offset in packer.out:
        assert offset == fill.get(sequence, 0)
        fill[sequence] = offset + len(ids) // 4
        of.setdefault(doc, []).append((start, ids))
    short = [n for n in fill.values() if n < size]
    assert all(n & (n - 1) == 0 for n in short) and len(fill) == len(closed) + total // size + bin(total % size).count("1")
    for k, n in enumerate(rests):
        ids = b"".join(x for _, x in sorted(of[k]))
        assert ids == b"".join(i.to_bytes(4, "little") for i in range(n))
    # what stood in the fullest windows still stands there together
    whole = {(doc, start, len(ids) // 4): sequence for doc, start, ids, sequence, _ in packer.out}
    for pieces in sorted(still, key=lambda p: -sum(n for _, _, n in p))[: total // size * 2 // 3]:
        assert len({whole[p] for p in pieces}) == 1


@pytest.mark.parametrize("sizes", [[1500], [1025, 1400, 1222], [600, 900, 1300], [1], [2047], list(range(1, 2048, 7))])
def test_open_windows_are_bounded(sizes):
    packer, most = packing.Packer(2048), 0
    rng = random.Random(1)
    for k in range(6000):
        packer.rest(k, 0, bytes(4 * rng.choice(sizes)))
        most = max(most, int(packer.level.max()))
        packer.out.clear()
    assert most <= 200 and packer.level.sum() == sum(map(len, packer.open))


def test_most_rests_stay_whole(spark):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1), WORD).collect()
    rests = {}
    for r in rows:
        if r["length"] < 2048:
            rests[r["doc_id"]] = rests.get(r["doc_id"], 0) + 1
    assert len(rests) > 900 and sum(n == 1 for n in rests.values()) >= 0.95 * len(rests)


def test_long_text_and_odd_rows(spark):
    text = " ".join(f"word{k}" for k in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "no id"), (4, "twice"), (4, "twice")], "doc_id long, text string")
    rows = packing.pack(docs.coalesce(1), WORD, with_ids=True).collect()
    ids = [i for r in sorted((r for r in rows if r["doc_id"] == 1), key=lambda r: r["start"]) for i in r["ids"]]
    from tokenizers import Tokenizer

    assert ids == [*Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids, 1]
    assert {r["doc_tokens"] for r in rows if r["doc_id"] == 1} == {len(ids)} and sum(r["doc_id"] in (2, 3) for r in rows) == 2
