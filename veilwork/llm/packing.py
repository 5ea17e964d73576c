"""Sum-of-squares online packing of token sequences.

Each document is cut into full windows and a rest. An array holds how many open (partially filled) windows stand at each
fill level. A rest of n tokens goes where the sum of the squared counts changes least: into a window at level h, which
moves to level h + n (or gets full and leaves the array), or into a new window. It may also be cut to fill a window
exactly, its remainder being placed next in the same way; a cut counts as `cut_cost` more. Of equal changes a rest that
stays whole comes before a cut, an open window before a new one, and the fuller window before the emptier. As the count
of a level grows, closing its windows by cuts becomes the least change, so open windows are bounded by the levels, not
by the rows.

Each task packs the rows of its own partition in their order, so packing needs no shuffle and a retried task repeats its
result; sequence ids are the partition's number shifted left plus a running number. At the end of a task the emptiest
open windows are taken apart to fill up the fullest, from the fullest on, and the last one's tokens are cut into windows
whose lengths are powers of two, which need no padding. So rests in all but the emptiest windows stay where they were.

Cases: a null text is the empty one, a document of one token (the end token). Equal rows are packed each by itself. A
null doc_id is returned as it is. An empty table gives no rows. A very long text is encoded in parts, and its full
windows are given up at once; rows of its pieces wait for its number of tokens. Columns besides doc_id and text are
ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from veilwork.llm.bpe_codec import SEGMENT, Memo, WordBpe, chunks, segments, simple_words
from veilwork.llm.common import documents, kept, text_batches

PER_PARTITION = 36  # bits of a sequence id below the partition's number
SHUT = 1 << 40  # no window stands there


class Document:
    """What the pieces of one document share; its number of tokens is known last."""

    __slots__ = ("doc_id", "tokens")

    def __init__(self, doc_id: int | None):
        self.doc_id, self.tokens = doc_id, 0


class Packer:
    """rest() takes each document's rest; `out` gets pieces (document, start, ids, sequence, offset)."""

    def __init__(self, size: int, first: int = 0, cut_cost: int = 8):
        self.size, self.next, self.cut_cost = size, first, cut_cost
        self.level = np.zeros(size + 1, np.int64)  # level 0 and the full level stay 0
        self.shut = np.full(size + 1, SHUT, np.int64)
        self.shut[0] = 0
        self.open: list[list[list]] = [[] for _ in range(size)]
        self.out: list[tuple] = []

    def whole(self, doc: Document, start: int, ids: bytes) -> None:
        self.out.append((doc, start, ids, self.next, 0))
        self.next += 1

    def rest(self, doc: Document, start: int, ids: bytes) -> None:
        while ids:
            n = len(ids) // 4
            h = self.choose(n)
            part = min(n, self.size - h)
            self._move(h, (doc, start, ids[: 4 * part]), part)
            start, ids = start + part, ids[4 * part :]

    def choose(self, n: int) -> int:
        """The level to place n tokens at (0: a new window); above size - n they are cut to fill the window there."""
        size, level = self.size, self.level
        here = level[: size - n + 1]
        change = 2 * (level[n:] - here) + self.shut[: size - n + 1] + 2
        change[0] -= 1  # only one count changes where a window begins,
        change[-1] -= 1  # or gets full
        back = int(change[::-1].argmin())
        h, least = size - n - back, change[size - n - back]
        if n > 1 and self.cut_cost + 2 - 2 * level.max() < least:
            cut = 2 * (level[1:n] - level[size - n + 1 : size]) + self.shut[size - n + 1 : size] + 2 + self.cut_cost
            back = int(cut[::-1].argmin())
            if cut[n - 2 - back] < least:
                h = size - 1 - back
        return h

    def _count(self, h: int, more: int) -> None:
        self.level[h] += more
        self.shut[h] = 0 if self.level[h] else SHUT

    def _move(self, h: int, piece: tuple, n: int) -> None:
        pieces = []
        if h:
            pieces = self.open[h].pop()
            self._count(h, -1)
        pieces.append(piece)
        if h + n == self.size:
            self._close(pieces)
        else:
            self._count(h + n, 1)
            self.open[h + n].append(pieces)

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids in pieces:
            self.out.append((doc, start, ids, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def finish(self) -> None:
        """Fills the fullest open windows with the tokens of the emptiest; what is left over goes to powers of two."""
        left = [(h, pieces) for h in range(self.size - 1, 0, -1) for pieces in self.open[h]]
        self._reset()
        spare: list[tuple] = []  # pieces of the windows taken apart, the next one last
        i, j = 0, len(left) - 1
        while i < j or (i == j and spare):
            h, pieces = left[i]
            need = self.size - h
            while need and (spare or i < j):
                if not spare:
                    spare = left[j][1][::-1]
                    j -= 1
                doc, start, ids = spare.pop()
                n = min(need, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n]))
                need -= n
                if len(ids) > 4 * n:
                    spare.append((doc, start + n, ids[4 * n :]))
            i += 1
            if need:
                spare = pieces[::-1]
            else:
                self._close(pieces)
        if i == j:
            spare = left[i][1][::-1]
        self._powers(spare[::-1])

    def _reset(self) -> None:
        self.level[:], self.shut[1:] = 0, SHUT
        self.open = [[] for _ in range(self.size)]

    def _powers(self, pieces: list[tuple]) -> None:
        left = sum(len(ids) for _, _, ids in pieces) // 4
        room = used = 0
        for doc, start, ids in pieces:
            while ids:
                if used == room:
                    room, used = 1 << (min(left, self.size).bit_length() - 1), 0
                    left -= room
                n = min(room - used, len(ids) // 4)
                self.out.append((doc, start, ids[: 4 * n], self.next, used))
                start, ids, used = start + n, ids[4 * n :], used + n
                self.next += used == room


class Encoder:
    """Text to its ids as 32-bit bytes, little-endian on the machines Spark runs on."""

    def __init__(self, path: str):
        bpe = self.bpe = WordBpe(path, memo=1000)
        self.word = Memo(lambda x: array("I", bpe._word(x)).tobytes(), 300_000)
        self.chunk = Memo(lambda x: array("I", bpe.ids(x)).tobytes(), 20_000)

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids of a text, a bounded number at a time."""
        for segment in segments(text):
            if len(segment) > 2 * SEGMENT:
                for ids in self.bpe.parts(segment):
                    yield array("I", ids).tobytes()
            elif (words := simple_words(segment)) is not None:
                yield b"".join(map(self.word.__getitem__, words))
            else:
                yield b"".join(map(self.chunk.__getitem__, chunks(segment)))


def loaded(path: str) -> Encoder:
    return kept(("packing", path), lambda: Encoder(path))


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document; with_ids adds the piece's token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = loaded(path), np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(size, TaskContext.get().partitionId() << PER_PARTITION)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc, held = Document(doc_id), b""
                first = len(packer.out)
                for part in encoder.parts(text.as_py() or ""):
                    held += part
                    full = len(held) // (4 * size)
                    for k in range(full):
                        packer.whole(doc, doc.tokens + k * size, held[4 * k * size : 4 * (k + 1) * size])
                    doc.tokens += full * size
                    held = held[4 * full * size :]
                    if not with_ids:
                        first = digest(packer.out, first)
                held += end
                packer.rest(doc, doc.tokens, held) if len(held) < 4 * size else packer.whole(doc, doc.tokens, held)
                doc.tokens += len(held) // 4
            if len(packer.out) > 4096:
                yield rows(packer)
        packer.finish()
        yield rows(packer)

    def digest(out: list[tuple], first: int) -> int:
        """Full windows keep their length and checksum only."""
        for k in range(first, len(out)):
            doc, start, ids, sequence, offset = out[k]
            out[k] = (doc, start, (len(ids) // 4, zlib.crc32(ids)), sequence, offset)
        return len(out)

    def rows(packer: Packer) -> pa.RecordBatch:
        out, packer.out = packer.out, []
        told = [x[2] if isinstance(x[2], tuple) else (len(x[2]) // 4, zlib.crc32(x[2])) for x in out]
        columns = [
            pa.array([x[0].doc_id for x in out], pa.int64()),
            pa.array([x[1] for x in out], pa.int64()),
            pa.array([x[0] for x in told], pa.int64()),
            pa.array([x[1] for x in told], pa.int64()),
            pa.array([x[0].tokens for x in out], pa.int64()),
            pa.array([x[3] for x in out], pa.int64()),
            pa.array([x[4] for x in out], pa.int64()),
        ]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        if with_ids:
            columns.append(pa.array([array("I", x[2]).tolist() for x in out], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return text_batches(docs).selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
