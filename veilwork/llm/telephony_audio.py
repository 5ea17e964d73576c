"""Telephony audio columns: G.711 mu-law and A-law by lookup tables, IMA ADPCM by numpy across blocks, resampled PCM.

`media_columns` stores a payload losslessly as 8-bit mu-law samples in a WAV file, and the sound they stand for as A-law
samples and as IMA ADPCM blocks in two more. All three are read back from what is stored: mu-law and A-law by lookup
tables, ADPCM blocks of 4 + n bytes step by step in time, all blocks of a batch at once. The PCM of the first is resampled
by linear interpolation at exact rational positions and stored as a column. `decode_media` does the same for a column of
files; one that can't be read gives a row with an error.

Cases: a null text is the empty one, so a payload of 64 zero bytes. Equal texts give equal values, each row its own. A
null doc_id is returned as it is. An empty table gives no rows. A very long text needs memory for its samples (about 16
bytes a byte). Columns besides doc_id and text (or the file column and those carried) are ignored. A null file, one that
is no WAV file, cut off, of another coding or of several channels has null rate and samples and says why.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.llm.common import documents, text_batches

RATE, WIDE = 8000, 16000
PCM, ALAW, MULAW, IMA = 1, 6, 7, 17
UNIT = 64

#: Fixed values of the IMA ADPCM standard: the change of the step index by a code's low three bits.
INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, dtype=np.int32)
#: Fixed values of the IMA ADPCM standard: the step sizes.
STEP = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], dtype=np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    part, low = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(part == 0, low, (low + 256) << np.maximum(part - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


MULAW_TABLE, ALAW_TABLE = mulaw_table(), alaw_table()


def _delta_table() -> np.ndarray:
    """Signed change of the predictor by step index and code."""
    code = np.arange(16, dtype=np.int32)
    s = STEP[:, None]
    size = (s >> 3) + np.where(code & 1, s >> 2, 0) + np.where(code & 2, s >> 1, 0) + np.where(code & 4, s, 0)
    return np.where(code & 8, -size, size).astype(np.int32).reshape(-1)


DELTA = _delta_table()
NEXT = np.clip(np.arange(89, dtype=np.int32)[:, None] + INDEX, 0, 88).astype(np.int32).reshape(-1)


def decode_adpcm(data: np.ndarray, block: int) -> np.ndarray:
    """PCM of mono IMA blocks, (blocks, 1 + 2 * (block - 4)): one step in time over all blocks at once."""
    rows = data.reshape(-1, block)
    value = np.ascontiguousarray(rows[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(rows[:, 2], 88).astype(np.int32)
    codes = np.ascontiguousarray(rows[:, 4:].T)
    out = np.empty((1 + 2 * (block - 4), len(rows)), np.int16)
    out[0] = value
    for t, byte in enumerate(codes):
        for half, code in enumerate((byte & 15, byte >> 4)):
            at = (index << 4) + code
            value += DELTA[at]
            np.clip(value, -32768, 32767, out=value)
            index = NEXT[at]
            out[1 + 2 * t + half] = value
    return out.T


def encode_adpcm(pcm: np.ndarray, block: int = 256) -> bytes:
    """Mono IMA blocks, the last filled with its last sample; for round trips and tests."""
    per = 1 + 2 * (block - 4)
    rows = np.resize(np.append(pcm, np.repeat(pcm[-1:], -len(pcm) % per)), (-(-len(pcm) // per), per)).astype(np.int32)
    value, index = rows[:, 0].copy(), np.zeros(len(rows), np.int32)
    out = np.zeros((len(rows), block), np.uint8)
    out[:, :2] = value.astype("<i2").reshape(-1, 1).view(np.uint8)
    for t in range(1, per):
        want = rows[:, t] - value
        left, step, code = np.abs(want), STEP[index], np.where(want < 0, 8, 0)
        for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
            on = left >= part
            code, left = code | np.where(on, bit, 0), left - np.where(on, part, 0)
        at = (index << 4) + code
        value, index = np.clip(value + DELTA[at], -32768, 32767), NEXT[at]
        out[:, 4 + (t - 1) // 2] |= (code << (4 * ((t - 1) % 2))).astype(np.uint8)
    return out.tobytes()


def alaw_codes() -> np.ndarray:
    """A-law code by 16-bit sample + 32768: the nearest level, of two the lower."""
    order = np.argsort(ALAW_TABLE, kind="stable")
    levels = ALAW_TABLE[order].astype(np.int32)
    return order[np.searchsorted((levels[1:] + levels[:-1]) / 2, np.arange(-32768, 32768))].astype(np.uint8)


ALAW_CODES = alaw_codes()


def wav(coding: int, data: bytes, rate: int = RATE, block: int = 1, bits: int = 8) -> bytes:
    """A mono WAV file."""
    extra = struct.pack("<HH", 2, 1 + 2 * (block - 4)) if coding == IMA else b"" if coding == PCM else b"\0\0"
    form = struct.pack("<HHIIHH", coding, 1, rate, rate * block if coding != IMA else rate * block // (1 + 2 * (block - 4)), block, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse(media: bytes) -> tuple[int, int, int, bytes]:
    """Coding, rate, block size and the data of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, data = 12, b"", None
    while at + 8 <= len(media) and data is None:
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            form = media[at + 8 : at + 8 + size]
        elif name == b"data":
            data = media[at + 8 : at + 8 + size]
            if len(data) < size:
                raise ValueError("the WAV file is cut off")
        at += 8 + size + size % 2
    if len(form) < 16 or data is None:
        raise ValueError("no format or no data in the WAV file")
    coding, channels, rate, _, block, bits = struct.unpack_from("<HHIIHH", form)
    if coding not in (PCM, ALAW, MULAW, IMA) or channels != 1 or rate == 0 or (coding == PCM and bits != 16):
        raise ValueError(f"coding {coding} with {channels} channels and {bits} bits at {rate} Hz isn't read")
    return coding, rate, block, data


def decode(media: bytes) -> tuple[int, np.ndarray]:
    """Rate and 16-bit samples of a mono WAV file of any of the codings; ValueError for any other file."""
    coding, rate, block, data = parse(media)
    raw = np.frombuffer(data, np.uint8)
    if coding == PCM:
        return rate, raw[: len(raw) // 2 * 2].view("<i2")
    if coding == IMA:
        if block < 5:
            raise ValueError("ADPCM blocks are too short")
        return rate, decode_adpcm(raw[: len(raw) // block * block], block).reshape(-1)
    return rate, (MULAW_TABLE if coding == MULAW else ALAW_TABLE)[raw]


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation at the exact positions k * rate / to, rounded half up."""
    if rate == to or not len(pcm):
        return pcm
    g = np.gcd(rate, to)
    up, down = int(to // g), int(rate // g)
    place = np.arange(len(pcm) * up // down, dtype=np.int64) * down
    at, part = place // up, (place % up).astype(np.int32)
    wide = np.append(pcm, pcm[-1:]).astype(np.int32)
    a, b = wide[at], wide[at + 1]
    return ((2 * (a * (up - part) + b * part) + up) // (2 * up)).astype(np.int16)


def payload(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + b"\0" * (-len(data) % UNIT or (UNIT if not data else 0))


def features(pcm: np.ndarray, wide: np.ndarray) -> str:
    """Samples, peak, sum of sizes, sign changes, and a checksum of the resampled PCM."""
    size = np.abs(pcm.astype(np.int32))
    turns = np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0))
    return f"n={len(pcm)};peak={int(size.max())};abs={int(size.sum(dtype=np.int64))};turns={turns};pcm={WIDE}/{len(wide)}/{zlib.crc32(wide.tobytes()):08x}"


def adpcm_files(sounds: list[np.ndarray], block: int = 256) -> tuple[list[bytes], list[np.ndarray]]:
    """Each sound as a WAV file of IMA blocks, and its samples read back; all blocks of all sounds at once."""
    per = 1 + 2 * (block - 4)
    counts = [-(-len(x) // per) for x in sounds]
    data = encode_adpcm(np.concatenate([np.pad(x, (0, n * per - len(x)), "edge") for x, n in zip(sounds, counts)]), block)
    ends = np.cumsum(counts) * block
    files = [wav(IMA, data[end - n * block : end], block=block, bits=4) for end, n in zip(ends.tolist(), counts)]
    stored = b"".join(parse(x)[3] for x in files)
    back = decode_adpcm(np.frombuffer(stored, np.uint8), block)
    rows = np.cumsum(counts)
    return files, [back[end - n : end].reshape(-1)[: len(x)] for end, n, x in zip(rows.tolist(), counts, sounds)]


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
MEDIA = ", media binary, alaw binary, adpcm binary, pcm binary"


def media_columns(docs: DataFrame, media: bool = False, batch_bytes: int = 4 << 20) -> DataFrame:
    """Stores each text as telephony audio and reads it back: digests and features; with media also the files and resampled PCM.

    The feature has figures of the mu-law sound, checksums of the A-law and ADPCM sounds read back, the sum of what ADPCM
    misses, and the checksum of the resampled PCM.
    """
    names = [x.split()[0] for x in (SCHEMA + MEDIA * media).split(", ")]
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def rows(held: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        files = [wav(MULAW, data) for _, _, data in held]
        sounds = [decode(x)[1] for x in files]
        flat = [wav(ALAW, ALAW_CODES[x.astype(np.int32) + 32768].tobytes()) for x in sounds]
        coded, heard = adpcm_files(sounds)
        for (doc_id, n, _), file, pcm, alaw, adpcm, ima in zip(held, files, sounds, flat, coded, heard):
            data = parse(file)[3]
            wide = resample(pcm, RATE, WIDE)
            missed = int(np.abs(ima.astype(np.int32) - pcm).sum(dtype=np.int64))
            feature = f"{features(pcm, wide)};alaw={zlib.crc32(decode(alaw)[1].tobytes()):08x};adpcm={zlib.crc32(ima.tobytes()):08x}/{missed}"
            row = [doc_id, n, len(data), sha(data), zlib.crc32(data[-UNIT:]), len(file), sha(file), feature]
            for column, value in zip(out, row + ([file, alaw, adpcm, wide.astype("<i2").tobytes()] if media else [])):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * (4 * media)
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                data = payload(text)
                held.append((doc_id, len((text or "").encode()), data))
                size += len(data)
                if size >= batch_bytes:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return text_batches(docs).selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, SCHEMA + MEDIA * media)


def decode_media(files: DataFrame, column: str = "media", carry: list[str] | None = None, to: int = WIDE) -> DataFrame:
    """The carried columns, rate, n_samples and pcm (16-bit samples at rate `to`) of a column of WAV files, and error."""
    carry = [c for c in carry or [] if c != column]
    names = [*carry, "rate", "n_samples", "pcm", "error"]
    rows = files.select(*carry, F.col(column).cast("binary").alias("__media"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def told(media: bytes | None) -> tuple:
        try:
            rate, pcm = decode(media or b"")
            return rate, len(pcm), resample(pcm, rate, to).astype("<i2").tobytes(), None
        except (ValueError, struct.error) as failure:
            return None, None, None, str(failure)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [told(x.as_py()) for x in batch.column(len(carry))]
            added = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names)

    return rows.mapInArrow(run, f"{schema}rate long, n_samples long, pcm binary, error string")


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))
