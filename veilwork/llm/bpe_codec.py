"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

A merge list fixes how far ahead a tokenizer must look. Let a rule (u, v) -> w have rank r. Whether it fires where u
and v stand depends on what follows only by way of rules of higher priority that take away w's right edge: (v, y), or
(u, y) in v's place, or what takes v's or u's own right edge. `lookahead` bounds this over all rules in rank order. The
longest token plus that bound is enough: a token boundary that far from the end of the buffer can't change any more, so
the tokens before it are emitted and forgotten. Memory stays constant, however long a word is; ordinary words end
within the buffer. Encodings of recent words are kept in a memo of bounded size.

A text is read in segments of bounded length that end before white space; words shorter than the buffer are one step of
the transducer (remembered in a memo of bounded size), longer ones pass through it in parts. What comes out is a bounded
list of ids at a time, which goes on to the digests and, id by id, to the decoder, and is forgotten. A run without white
space that is longer than a segment is normalised as a whole (a few copies of that run), its words still pass one by one.

The decoder is an incremental state machine from ids to bytes to text, which holds at most an unfinished character. The
file decides which bytes a token stands for: `joined` are those of the tokenizers library for a file without a decoder
(tokens joined by one space), `plain` those of the text itself (byte symbols as bytes, a space after a word's end).

Cases: a null text is encoded as the empty one (no tokens, empty decoded text). Equal rows give equal results, each row
its own. A null doc_id is returned as it is. An empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from veilwork.llm.common import documents, kept, text_batches

#: Python's str.split() also splits at these four, which the tokenizer's white space lacks.
SEPARATORS = regex.compile("[\x1c-\x1f]")
#: The white space that the tokenizer file's patterns know (fixed value).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = regex.compile(f"[^{WHITE}]+")
GAP = regex.compile(f"[{WHITE}]")
SEGMENT = 1 << 16  # characters
#: The pre-tokenizer's pattern in the tokenizer file (fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SIMPLE = regex.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ž]+")
SIMPLE_TEXT = re.compile("[\\t-\\r -~À-ÖØ-öø-įı-ž]*")
#: PIECES for lower-cased simple texts.
SIMPLE_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^\\s0-9a-zß-öø-ž]+")
END = "</w>"
NONE = 1 << 30


class Memo(dict):
    """make(key), remembered for the last keys of up to 256 characters: at most twice `most` of them."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, str) and len(key) > 256:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def simple_words(text: str) -> list[str] | None:
    """The pre-tokenizer's pieces of a text of ASCII and Latin letters without special tokens; None for any other text."""
    if "<|" in text or not SIMPLE_TEXT.fullmatch(text):
        return None
    return SIMPLE_PIECES.findall(text.lower())


def chunks(text: str) -> list[str]:
    """Runs without the tokenizer's white space."""
    return CHUNK.findall(text) if SEPARATORS.search(text) else text.split()


def segments(text: str, most: int = SEGMENT) -> Iterator[str]:
    """A text in parts of about `most` characters that begin with white space, but for the first."""
    at = 0
    while len(text) - at > most:
        gap = GAP.search(text, at + most)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shift = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(shift)) for b in range(256)]


def lookahead(rules: Iterable[tuple[str, str]], width: Callable[[str], int] = len) -> int:
    """Symbols after a token's end that can decide whether it is formed: an upper bound for any text."""
    ahead: dict[str, int] = {}  # of the rules that give a symbol
    steal: dict[str, int] = {}  # of the rules so far with this symbol on the left: what is right of it, and ahead of that
    most = 0
    for u, v in rules:
        by_right = max(ahead.get(v, 0), steal.get(v, 0))
        by_left = max(ahead.get(u, 0), steal.get(u, 0)) - width(v)
        e = max(by_right, by_left, 0)
        ahead[u + v] = max(ahead.get(u + v, 0), e)
        steal[u] = max(steal.get(u, 0), width(v) + e)
        most = max(most, e)
    return most


class WordBpe:
    """A tokenizer file with word ends, encoded and decoded here; its normaliser is the library's."""

    def __init__(self, path: str, memo: int = 400_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        rules = [tuple(x) if not isinstance(x, str) else tuple(x.split(" ")) for x in spec["model"]["merges"]]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.at_special = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")")
        width = lambda x: len(x.removesuffix(END))
        self.reach = lookahead(rules, width) + max(width(t) for t in self.vocab)
        self.window = 4 * self.reach + 64
        self.rank = {(self.vocab[u] << 17) | self.vocab[v]: k for k, (u, v) in enumerate(rules)}
        self.made = [self.vocab[u + v] for u, v in rules]
        symbols = byte_symbols()
        self.inner, self.final = [self.vocab[x] for x in symbols], [self.vocab[x + END] for x in symbols]
        self.width = {i: width(t) for t, i in self.vocab.items()}
        self.word = Memo(self._word, memo)
        self.chunk = Memo(lambda x: tuple(self.ids(x)), memo // 8)

    def _merge(self, ids: list[int]) -> list[int]:
        get, none, made = self.rank.get, NONE, self.made
        ranks = [get((a << 17) | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            ids[k] = made[low]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1] << 17) | ids[k], none)
            if k < len(ranks):
                ranks[k] = get((ids[k] << 17) | ids[k + 1], none)
        return ids

    def stream(self, data: Iterable[int]) -> Iterator[list[int]]:
        """Token ids of one word, given as its bytes, as soon as they are stable; buffers at most `window` symbols."""
        held: list[int] = []
        last = None
        for byte in data:
            if last is not None:
                held.append(self.inner[last])
            last = byte
            if len(held) >= self.window:
                done, size, k = self._merge(list(held)), 0, 0
                while size + self.width[done[k]] <= len(held) - self.reach:
                    size += self.width[done[k]]
                    k += 1
                yield done[:k]
                held = held[size:]
        if last is not None:
            yield self._merge([*held, self.final[last]])

    def _word(self, word: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(self.stream(word.encode())))

    def words(self, chunk: str) -> Iterator[int | str]:
        """A run without white space as ids of special tokens and words."""
        for part in self.at_special.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                yield self.special[part]
            elif part:
                low = part.lower() if SIMPLE.fullmatch(part) else self.normalise(part)
                yield from (x.group() for x in PIECES.finditer(low))

    def ids(self, chunk: str) -> list[int]:
        """Ids of a run without white space."""
        out: list[int] = []
        for word in self.words(chunk):
            out += (word,) if isinstance(word, int) else self.word[word]
        return out

    def long_run(self, chunk: str, most: int = SEGMENT) -> Iterator[list[int]]:
        """Ids of a run without white space, a bounded number at a time."""
        out: list[int] = []
        for word in self.words(chunk):
            for part in ((word,),) if isinstance(word, int) else (self.word[word],) if len(word) <= self.window else self.stream(word.encode()):
                out += part
                if len(out) >= most:
                    yield out
                    out = []
        yield out

    def parts(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, a bounded number at a time."""
        for segment in segments(text):
            if (words := simple_words(segment)) is not None and len(segment) <= 2 * SEGMENT:
                yield list(chain.from_iterable(map(self.word.__getitem__, words)))
            elif len(segment) <= 2 * SEGMENT:
                yield list(chain.from_iterable(map(self.chunk.__getitem__, chunks(segment))))
            else:
                for run in CHUNK.finditer(segment):
                    yield from self.long_run(run.group())

    def joined(self) -> list[bytes]:
        """By id, what a token adds to the library's decoded text: a space and itself."""
        return [b" " + self.token.get(i, "").encode() for i in range(max(self.token) + 1)]

    def plain(self) -> list[bytes]:
        """By id, the bytes that a token stands for; a word's end gives a space."""
        byte = {x: bytes([k]) for k, x in enumerate(byte_symbols())}

        def told(token: str) -> bytes:
            if token in self.special:
                return token.encode()
            return b"".join(byte[x] for x in token.removesuffix(END)) + b" " * token.endswith(END)

        return [told(self.token.get(i, "")) for i in range(max(self.token) + 1)]


class BytesToText:
    """Ids to text, some at a time: holds an unfinished character; bytes that are no UTF-8 give a replacement."""

    def __init__(self, pieces: list[bytes], skip: int = 0):
        """pieces: by id. skip: bytes to leave out at the start."""
        self.pieces, self.skip = pieces, skip
        self.decoder = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.pieces.__getitem__, ids))
        if self.skip and data:
            data, self.skip = data[self.skip :], 0
        return self.decoder.decode(data)

    def close(self) -> str:
        return self.decoder.decode(b"", True)


class Codec:
    """Encodes texts and decodes what it emitted, with running digests."""

    def __init__(self, path: str):
        self.bpe = WordBpe(path)
        self.joined, self.plain = self.bpe.joined(), self.bpe.plain()
        self.decimal = [f" {i}" for i in range(len(self.joined))]

    def run(self, text: str, keep: Callable[[list[int], str, str], None] | None = None) -> tuple[int, str, str]:
        """Number of tokens, and SHA-256 of the decimal ids joined by one space and of the decoded text; keep gets each part's ids, decoded and plain text."""
        count, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
        back, own = BytesToText(self.joined, skip=1), BytesToText(self.plain)
        for ids in self.bpe.parts(text):
            told = "".join(map(self.decimal.__getitem__, ids))
            ids_sha.update((told if count else told[1:]).encode())
            decoded = back.feed(ids)
            text_sha.update(decoded.encode())
            count += len(ids)
            if keep:
                keep(ids, decoded, own.feed(ids))
        end = back.close()
        text_sha.update(end.encode())
        if keep:
            keep([], end, own.close())
        return count, ids_sha.hexdigest(), text_sha.hexdigest()


def loaded(path: str) -> Codec:
    """One per worker process."""
    return kept(("bpe", path), lambda: Codec(path))


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, texts: bool = False) -> DataFrame:
    """Per document its number of tokens and digests of ids and decoded text; with texts also ids, decoded and plain text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        for batch in batches:
            found, ids, decoded, plain = [], [], [], []
            for text in batch.column(1):
                rows: list[tuple] = []
                found.append(codec.run(text.as_py() or "", (lambda *x: rows.append(x)) if texts else None))
                if texts:
                    ids.append([i for x in rows for i in x[0]])
                    decoded.append("".join(x[1] for x in rows))
                    plain.append("".join(x[2] for x in rows))
            columns = [batch.column(0), *(pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string())))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if texts:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(plain, pa.string())]
                names += ["ids", "decoded", "plain"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return text_batches(docs).selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>, decoded string, plain string" if texts else ""))


def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
