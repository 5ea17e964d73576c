"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

For a BPE vocabulary, t1 t2 ... tk is the encoding of a text exactly if each pair of neighbours stays a pair when its two
texts are encoded together. So the encoding of a prefix is that of a shorter prefix plus one token: among the vocabulary's
tokens that end there, the one that is a pair with the shorter prefix's last token. The table of counts and last tokens,
one entry per prefix, then answers how many tokens any truncation has and how much text a budget holds, with nothing
encoded again. Pairs are tested once each and remembered.

A segment is a run of the space mark with what follows up to the next such run, or a single character outside the
vocabulary; no token crosses segments, so tables are made per segment and added up. Tables of recent segments are kept
in a memo of bounded size.

Cases: a null text counts as the empty one: no bytes, no tokens. Equal rows give equal results, each row its own. An
empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from veilwork.llm.bpe_codec import Memo
from veilwork.llm.common import documents, kept, text_batches

MARK = "▁"
SEGMENTS = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PrefixCounter:
    """Prefix tables for a sentencepiece BPE model with byte fallback, no normalisation and a leading space mark."""

    def __init__(self, path: str, memo: int = 400_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usual = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in usual}
        self.piece = list(self.score)
        self.trie: dict = {}  # by character; under "" the piece's number
        for k, piece in enumerate(self.piece):
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = k
        self.met = {x[k : k + 2] for x in self.piece for k in range(len(x) - 1)}  # characters that meet in a piece
        self.line_feed = 1 if "\n" not in self.trie else None  # outside the vocabulary it is one byte, a segment of its own
        self.pair = Memo(lambda ab: self._pair(ab >> 20, ab & 0xFFFFF), 300_000)
        self.total = Memo(self._total, memo)

    def _pair(self, a: int, b: int) -> bool:
        """Whether two pieces stay a pair; a past the last piece: whether b stays whole."""
        left = [self.piece[a]] if a < len(self.piece) else []
        return self._merge("".join([*left, self.piece[b]])) == [*left, self.piece[b]]

    def _total(self, segment: str) -> int:
        if len(segment) > 1 and segment[-1] in ".," and segment[-2:] not in self.met:  # no token crosses there
            return self.total[segment[:-1]] + self.total[segment[-1]]
        return self.table(segment)[0][-1]

    def _merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best-scored pair, the leftmost of equals, until none is a piece."""
        parts, score, none = list(text), self.score.get, float("-inf")
        while len(parts) > 1:
            best = max(ranks := [score(a + b, none) for a, b in zip(parts, parts[1:])])
            if best == none:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def table(self, segment: str) -> tuple[list[int], list[int]]:
        """Token count and last piece of each prefix of a segment; entry 0 is the empty prefix, -1 a character in bytes."""
        size, none, pair = len(segment), len(self.piece), self.pair
        counts, last = [0] * (size + 1), [None] * (size + 1)
        last[0] = -1
        for start in range(size):
            before = last[start]
            if before is None:  # no piece ends here: a character outside the vocabulary, one token per byte
                before = last[start] = -1
                counts[start] = counts[start - 1] + len(segment[start - 1].encode())
            before = (none if before < 0 else before) << 20
            node, base = self.trie, counts[start] + 1
            for end in range(start, size):
                node = node.get(segment[end])
                if node is None:
                    break
                piece = node.get("")
                if piece is not None and last[end + 1] is None and pair[before | piece]:
                    last[end + 1] = piece
                    counts[end + 1] = base
        if size and last[size] is None:
            last[size] = -1
            counts[size] = counts[size - 1] + len(segment[-1].encode())
        return counts, last

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return SEGMENTS.findall(marked)
        return [MARK + x for x in text.split(" ")]

    def count(self, text: str) -> int:
        known = self.total
        if self.line_feed and not (MARK in text or "  " in text or "\n " in text or " \n" in text or text[:1] in ("", " ", "\n") or text[-1] in " \n"):
            lines = [line.split(" ") for line in text.split("\n")]  # a line's first word has no mark, but for the first line's
            lines[0][0] = MARK + lines[0][0]
            if "" not in lines[0]:
                return len(lines) - 1 + sum(known[line[0]] if line[0] else 0 for line in lines) + sum(map(known.__getitem__, [MARK + x for line in lines for x in line[1:]]))
        return sum(map(known.__getitem__, self.segments(text)))

    def prefixes(self, text: str) -> list[int]:
        """Token count of text[:k] for each k; a prefix that ends in the middle of a space run counts that run's part."""
        out, base = [0], 0
        for k, part in enumerate(self.segments(text)):
            counts = self.table(part)[0]
            out.extend(base + x for x in counts[(2 if k == 0 else 1) :])
            base += counts[-1]
        return out

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most so many tokens."""
        base, at, best = 0, -1, 0
        for part in self.segments(text):
            if base > budget:
                break
            total = self.total[part]
            if base + total <= budget:
                best = at + len(part)
            else:
                best = max([best, *(at + k for k, x in enumerate(self.table(part)[0]) if base + x <= budget)])
            base, at = base + total, at + len(part)
        return max(best, 0)


def loaded(path: str) -> PrefixCounter:
    return kept(("counts", path), lambda: PrefixCounter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (characters of the longest prefix within the limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            sizes, counts, fits = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n = counter.count(text)
                sizes.append(len(text.encode()))
                counts.append(n)
                fits.append(len(text) if n <= limit else counter.fit(text, limit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_()), pa.array(fits, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    return text_batches(docs).selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
