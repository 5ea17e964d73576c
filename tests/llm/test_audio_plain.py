"""Telephony audio against plain restatements: tables, ADPCM, resampling, digests and features, and files that can't be read."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from veilwork.llm import telephony_audio as audio

rng = random.Random(2)
TEXTS = [None, "", "a", "x" * 64, "y" * 65, "Hällo 漢字 " * 60, "".join(rng.choice("etaoin shrdlu\n") for _ in range(3000))]


def mulaw(code):
    code = 255 - code
    sign, part, step = code // 128, code // 16 % 8, code % 16
    size = (2 * step + 33) * 2**part - 33
    return (-1 if sign else 1) * size * 4


def alaw(code):
    code ^= 0x55
    sign, part, step = code // 128, code // 16 % 8, code % 16
    size = 2 * step + 1 if part == 0 else (2 * step + 33) * 2 ** (part - 1)
    return (1 if sign else -1) * size * 8


def adpcm(data, block):
    out = []
    for at in range(0, len(data), block):
        value, index = int.from_bytes(data[at : at + 2], "little", signed=True), min(data[at + 2], 88)
        out.append(value)
        for byte in data[at + 4 : at + block]:
            for code in (byte % 16, byte // 16):
                step = int(audio.STEP[index])
                change = step // 8 + (step // 4 if code & 1 else 0) + (step // 2 if code & 2 else 0) + (step if code & 4 else 0)
                value = max(-32768, min(32767, value - change if code & 8 else value + change))
                index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[code % 8]))
                out.append(value)
    return out


def resampled(pcm, rate, to):
    out = []
    for k in range(len(pcm) * to // rate):
        place = Fraction(k * rate, to)
        at = place.numerator // place.denominator
        a, b = pcm[at], pcm[min(at + 1, len(pcm) - 1)]
        value = a + (b - a) * (place - at) + Fraction(1, 2)
        out.append(value.numerator // value.denominator)
    return out


def test_tables():
    assert audio.MULAW_TABLE.tolist() == [mulaw(c) for c in range(256)]
    assert audio.ALAW_TABLE.tolist() == [alaw(c) for c in range(256)]
    levels = [alaw(c) for c in range(256)]
    for x in [-32768, -1, 0, 1, 32767, *(rng.randint(-32768, 32767) for _ in range(500))]:
        assert abs(levels[audio.ALAW_CODES[x + 32768]] - x) == min(abs(v - x) for v in levels)


def test_adpcm_and_resampling():
    data = bytes(rng.randrange(256) for _ in range(64 * 5))
    assert audio.decode_adpcm(np.frombuffer(data, np.uint8), 64).reshape(-1).tolist() == adpcm(data, 64)
    pcm = [rng.randint(-32768, 32767) for _ in range(301)]
    for rate, to in ((8000, 16000), (16000, 8000), (11025, 16000), (8000, 8000), (44100, 8000)):
        assert audio.resample(np.array(pcm, np.int16), rate, to).tolist() == resampled(pcm, rate, to)


def test_stored_forms_and_features(spark):
    rows = audio.media_columns(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), media=True).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        raw = (TEXTS[r["doc_id"]] or "").encode()
        data = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        pcm, media = [mulaw(c) for c in data], bytes(r["media"])
        assert media[:4] == b"RIFF" and media[8:16] == b"WAVEfmt " and media[20:22] == b"\x07\0" and media.endswith(data)
        flat, ima = bytes(r["alaw"]), bytes(r["adpcm"])
        sound = [alaw(c) for c in flat[-len(data) :]]
        levels = sorted(set(map(alaw, range(256))))
        assert flat[20:22] == b"\x06\0" and all(abs(s - x) == min(abs(v - x) for v in levels) for s, x in list(zip(sound, pcm))[:100])
        blocks = ima[ima.index(b"data") + 8 :]
        heard = adpcm(blocks, 256)[: len(pcm)]
        wide = np.array(resampled(pcm, 8000, 16000), "<i2").tobytes()
        turns = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:]))
        feature = f"n={len(pcm)};peak={max(map(abs, pcm))};abs={sum(map(abs, pcm))};turns={turns};pcm=16000/{2 * len(pcm)}/{zlib.crc32(wide):08x}"
        feature += f";alaw={zlib.crc32(np.array(sound, '<i2').tobytes()):08x};adpcm={zlib.crc32(np.array(heard, '<i2').tobytes()):08x}/{sum(abs(a - b) for a, b in zip(heard, pcm))}"
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert (r["media_bytes"], r["media_sha256"], r["feature"], bytes(r["pcm"])) == (len(media), hashlib.sha256(media).hexdigest(), feature, wide)


def test_files_that_cannot_be_read_give_errors(spark):
    good = audio.wav(audio.ALAW, bytes(range(256)))
    stereo = good[:22] + b"\x02\0" + good[24:]
    files = [(1, good), (2, None), (3, b""), (4, b"RIFFxxxxWAVE"), (5, good[:100]), (6, stereo), (7, audio.wav(85, b"mp3")), (8, audio.wav(audio.PCM, b"\1\0\2", block=2, bits=16)), (9, audio.wav(audio.IMA, b"\0" * 8, block=4))]
    got = {r["k"]: r for r in audio.decode_media(spark.createDataFrame(files, "k long, media binary"), carry=["k"]).collect()}
    assert {k for k, r in got.items() if r["error"] is None} == {1, 8} and got[1]["n_samples"] == 256 and len(got[1]["pcm"]) == 1024
    assert all(r["pcm"] is None and r["rate"] is None for r in got.values() if r["error"])
