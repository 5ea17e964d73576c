"""Array kernels on planes in numpy: gradient noise, vector fields, path advection, blur, crop, PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def _lattice(seed: int, size: int = 256) -> np.ndarray:
    order = np.random.default_rng(seed).permutation(size)
    return np.concatenate([order, order])


def gradient_noise(width: int, height: int, scale: float, octaves: int, seed: int, persistence: float = 0.5, lacunarity: float = 2.0) -> np.ndarray:
    """Fractal improved gradient noise after the published algorithm; no bit parity with any library."""
    table = _lattice(seed)
    y, x = np.mgrid[0:height, 0:width].astype(float) / scale
    total, weight, power, step = np.zeros((height, width)), 0.0, 1.0, 1.0
    angles = np.arange(8) * np.pi / 4
    for _ in range(octaves):
        px, py = x * step, y * step
        ix, iy = np.floor(px).astype(int), np.floor(py).astype(int)
        fx, fy = px - ix, py - iy
        u, v = (f * f * f * (f * (f * 6 - 15) + 10) for f in (fx, fy))
        corner = {}
        for dx in (0, 1):
            for dy in (0, 1):
                a = angles[table[table[(ix + dx) & 255] + ((iy + dy) & 255)] & 7]
                corner[dx, dy] = np.cos(a) * (fx - dx) + np.sin(a) * (fy - dy)
        low = corner[0, 0] + u * (corner[1, 0] - corner[0, 0])
        high = corner[0, 1] + u * (corner[1, 1] - corner[0, 1])
        total += power * (low + v * (high - low))
        weight += power
        power, step = power * persistence, step * lacunarity
    return total / weight


def vector_field(width: int, height: int, scale: float, octaves: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors from two noises."""
    dx, dy = (gradient_noise(width, height, scale, octaves, s) for s in (seed, seed + 1))
    size = np.hypot(dx, dy)
    size[size == 0] = np.finfo(float).eps
    return dx / size, dy / size


def bilinear(plane: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    h, w = plane.shape
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = y - y0, x - x0
    top = plane[y0, x0] * (1 - fx) + plane[y0, x1] * fx
    return top * (1 - fy) + (plane[y1, x0] * (1 - fx) + plane[y1, x1] * fx) * fy


def advect(plane: np.ndarray, dx: np.ndarray, dy: np.ndarray, steps: int, length: float) -> np.ndarray:
    """Repeated half-and-half average with the plane sampled one step along the field."""
    y, x = np.mgrid[0 : plane.shape[0], 0 : plane.shape[1]].astype(float)
    now = plane.astype(float)
    for _ in range(steps):
        now = 0.5 * now + 0.5 * bilinear(now, y + dy * length, x + dx * length)
    return now


def gaussian_blur(plane: np.ndarray, size: int) -> np.ndarray:
    """Separable, edges mirrored without repeating the edge, sigma from the size."""
    sigma, r = 0.3 * ((size - 1) / 2 - 1) + 0.8, size // 2
    k = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    k /= k.sum()
    out = plane.astype(float)
    for axis in (0, 1):
        pad = [(r, r) if a == axis else (0, 0) for a in (0, 1)]
        wide = np.pad(out, pad, mode="reflect" if out.shape[axis] > r else "edge")
        out = sum(w * np.take(wide, np.arange(i, i + out.shape[axis]), axis=axis) for i, w in enumerate(k))
    return out


def resize(plane: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    h, w = plane.shape
    y, x = (np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5
    return bilinear(plane, np.repeat(y[:, None], width, 1), np.repeat(x[None], height, 0))


def normalise(plane: np.ndarray, invert: bool = False) -> np.ndarray:
    """Min-max to 8 bit, truncated; a flat plane gives zeros."""
    low, high = float(plane.min()), float(plane.max())
    v = np.zeros_like(plane, dtype=float) if high == low else (plane - low) / (high - low)
    return ((1 - v if invert and high != low else v) * 255).astype(np.uint8)


def png(pixels: np.ndarray) -> bytes:
    """8-bit PNG of (h, w), (h, w, 3) or (h, w, 4)."""
    h, w = pixels.shape[:2]
    kind = {1: 0, 3: 2, 4: 6}[1 if pixels.ndim == 2 else pixels.shape[2]]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1).astype(np.uint8)], axis=1)
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows.tobytes())) + part(b"IEND", b"")


def unpng(data: bytes) -> np.ndarray:
    """Pixels of an 8-bit gray, RGB or RGBA PNG without interlace."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, parts = 8, []
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        if name == b"IHDR":
            w, h, depth, kind, _, _, interlace = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + size])
        elif name == b"IDAT":
            parts.append(data[at + 8 : at + 8 + size])
        at += size + 12
    if depth != 8 or interlace or kind not in (0, 2, 6):
        raise ValueError("only 8-bit gray, RGB and RGBA without interlace")
    n = {0: 1, 2: 3, 6: 4}[kind]
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(h, 1 + w * n)
    out, above = np.empty((h, w, n), np.uint8), np.zeros((w, n), np.uint8)
    for y in range(h):
        line = rows[y, 1:].reshape(w, n)
        above = out[y] = _unfiltered(int(rows[y, 0]), line, above)
    return out[:, :, 0] if n == 1 else out


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray) -> np.ndarray:
    """A row without its filter: none, sub and up at once, average and Paeth pixel by pixel."""
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line, axis=0, dtype=np.uint8)
    if kind == 2:
        return line + above
    out, left, corner = np.empty_like(line), np.zeros(line.shape[1], int), np.zeros(line.shape[1], int)
    for x in range(len(line)):
        up = above[x].astype(int)
        if kind == 3:
            guess = (left + up) >> 1
        else:
            a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        left = (line[x] + guess) & 255
        out[x], corner = left, up
    return out
