"""Plain restatements of what operators must return, quadratic where that is simplest."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=4):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + shingle]) for k in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """items: list of (key, value); the smallest key reachable by links of values, by key order of items."""
    root = list(range(len(items)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(items)):
        for b in range(a):
            if find(a) != find(b) and linked(items[a][1], items[b][1]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    keys = {}
    for k, (key, _) in enumerate(items):
        if key is not None:
            keys[find(k)] = min(key, keys.get(find(k), key))
    return [keys.get(find(k)) for k in range(len(items))]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def within(a, b, most):
    """Whether two strings are within so many edits, by the full table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def lines(rows, least=24, exact=24, most=1):
    """rows: (doc_id, text), distinct ids; text by doc_id after line dedup."""
    first, at = {}, []
    for doc_id, text in sorted(rows):
        for no, line in enumerate((text or "").split("\n")):
            line = line.strip(" ")
            if len(line) >= min(least, exact):
                first.setdefault(line, (doc_id, no))
                at.append((doc_id, no, line))
    by_size, near = {}, set()
    for line in first:  # in order of first occurrence
        if len(line) < least:
            continue
        count = Counter(line)
        others = (x for n in range(len(line) - most, len(line) + most + 1) for x in by_size.get(n, ()))
        if any(one_edit(line, x) if most == 1 else (count - c).total() <= most and (c - count).total() <= most and within(line, x, most) for x, c in others):
            near.add(line)
        by_size.setdefault(len(line), []).append((line, count))
    gone = {(d, no) for d, no, line in at if line in near or first[line] != (d, no)}
    return {d: None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (d, no) not in gone) for d, t in rows}


def repeats(texts, length=200):
    """What is left of each text's bytes."""
    data, seen = [(t or "").encode() for t in texts], {}
    for b in data:
        for k in range(len(b) - length + 1):
            seen[b[k : k + length]] = seen.get(b[k : k + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append(np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


def check_packing(rows, texts, size, encode):
    """Each id in one piece, sequences gapless and full or a power of two. texts: by doc_id; encode: text to ids."""
    import zlib

    fill, pieces = {}, {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == size or at < size and at & (at - 1) == 0
    assert pieces.keys() == texts.keys()
    for doc_id, parts in pieces.items():
        ids, at = [*encode(texts[doc_id] or ""), 1], 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
