"""Rendering of all configured variants of image and depth pairs, and depth maps by a given predictor.

A pair's variants are made where its pixels are, so an image is moved once and not once per configuration. Draws are
keyed by (seed, image, configuration, name): a retried task writes the same files. What can't be rendered comes out as
a row with an error and no data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions import atmosphere, text
from veilwork.operators import kernels
from veilwork.sources.storage import opened

SCHEMA = "path string, data binary, error string"


def drawn(seed: int, *keys) -> float:
    """The number that functions.rand.uniform draws for these keys."""
    return int(hashlib.md5("|".join(map(str, (seed, *keys))).encode()).hexdigest()[:8], 16) / 4294967296.0


def decoded(spark: SparkSession, pattern: str) -> DataFrame:
    """path, height, width, channels, pixels (blue, green, red) of readable images."""
    image = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(pattern)
    return image.select(F.col("image.origin").alias("path"), *[F.col(f"image.{a}").alias(b) for a, b in (("height", "height"), ("width", "width"), ("nChannels", "channels"), ("data", "pixels"))])


def pixel_pairs(images: DataFrame, depths: DataFrame) -> DataFrame:
    """base and both sides' pixels, joined on the expected depth name."""
    side = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in ("path", "height", "width", "channels", "pixels")])
    left = side(images, "i_").withColumn("base", text.stem(F.col("i_path")))
    right = side(depths, "d_").withColumn("name", text.base(F.col("d_path")))
    return left.join(right, F.concat("base", F.lit("_depth.png")) == F.col("name")).drop("name", "i_path", "d_path")


def gray(pixels: np.ndarray) -> np.ndarray:
    """Rec. 601 luma of (h, w, channels) in blue, green, red order."""
    return pixels[:, :, 0].astype(float) if pixels.shape[2] == 1 else np.rint(pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299]))


def composed(image: np.ndarray, depth: np.ndarray, config: tuple, air: tuple | None, baseline: float = 0.0, mask: np.ndarray | None = None, strength: float = 0.5, noise: np.ndarray | None = None) -> np.ndarray:
    """8-bit variant of an image (h, w, 3; red first, in [0, 1]): functions.atmosphere.compose on planes."""
    _, mode, dmax, zgamma, visibility, _, eta, h_scale, hmax, omega0 = config
    p_omega, p_eta, p_scale, p_air, spectral = atmosphere.PRESETS[mode]
    rows = len(image)
    eta, scale, top = eta or p_eta, h_scale or p_scale, hmax or p_scale
    omega = np.full(3, omega0) if omega0 else np.array(p_omega)
    light = np.clip(np.array(air) / 255 if air else np.array(p_air), 0, 1)
    up = top * (1 - np.arange(rows)[:, None] / max(rows - 1, 1))
    tau = 3.912 / visibility * np.exp(-np.maximum(up, 0) / max(1e-6, scale)) * np.clip(depth, 0, 1) ** zgamma * dmax
    tau = tau[:, :, None] * np.array(spectral) + baseline
    if mask is not None:
        tau *= ((1 - strength) + strength * mask)[:, :, None]
    through = np.exp(-tau)
    linear = lambda v: np.where(v <= 0.04045, v / 12.92, ((v + 0.055) / 1.055) ** 2.4)
    out = np.clip(linear(np.clip(image, 0, 1)) * through + linear(light) * omega * (1 - through**eta), 0, 1)
    out = np.where(out <= 0.0031308, out * 12.92, 1.055 * out ** (1 / 2.4) - 0.055)
    if noise is not None:
        out = out + noise
    return np.floor(np.clip(out, 0, 1) * 255 + 0.5).astype(np.uint8)


def blur_side(mode: str, visibility: float, coin: float) -> int:
    """Side of the depth blur; 0 for none."""
    if mode != "fog" or visibility > 100 and coin >= 0.5:
        return 0
    return 7 if 30 <= visibility < 50 else 11 if 50 <= visibility < 70 else 3


@lru_cache(maxsize=8)
def texture(path: str) -> np.ndarray:
    files, at = opened(path)
    with files.open_input_stream(at, compression=None) as raw:
        found = kernels.unpng(raw.read())
    return found.astype(float) if found.ndim == 2 else gray(found[:, :, 2::-1])


def mask_of(plane: np.ndarray, height: int, width: int, u: float, v: float) -> np.ndarray:
    """A crop in [0, 1]; a texture that is too small is enlarged first."""
    h, w = plane.shape
    if h < height or w < width:
        plane = kernels.resize(plane, max(h, height), max(w, width))
        h, w = plane.shape
    y, x = int(u * (h - height + 1)), int(v * (w - width + 1))
    return plane[y : y + height, x : x + width] / 255


def variants(pairs: DataFrame, textures: list[str] | None = None, strength: float = 0.5, dither: bool = False, seed: int = 42) -> DataFrame:
    """path (haze_v2/<base>/<file>), data (PNG) and error of all configured variants of `pixel_pairs`.

    textures: paths that every executor can read; names only travel with the plan, pixels are read where they are used.
    """
    configs, names = atmosphere.config_rows(), sorted(textures or [])

    def one(row: dict) -> Iterator[tuple]:
        base = row["base"]
        shape = lambda p: (row[f"{p}_height"], row[f"{p}_width"], row[f"{p}_channels"])
        image, depth = (np.frombuffer(row[f"{p}_pixels"], np.uint8).reshape(shape(p)) for p in ("i", "d"))
        if image.shape[:2] != depth.shape[:2]:
            raise ValueError(f"image {image.shape[:2]} and depth {depth.shape[:2]} differ in size")
        image = (image[:, :, 2::-1] if image.shape[2] >= 3 else np.repeat(image, 3, axis=2)) / 255
        near = (255 - gray(depth)) / 255
        for config in configs:
            u = lambda *name: drawn(seed, base, config[0], *name)  # noqa: B023, E731
            air = config[5] and tuple(min(max(c + int(u("air", k) * 11) - 5, 0), 255) for k, c in enumerate(config[5]))
            side = blur_side(config[1], config[4], u("coin"))
            mask = mask_of(texture(names[int(u("texture") * len(names))]), *image.shape[:2], u("y"), u("x")) if names else None
            noise = np.random.default_rng(int(u("dither") * 2**32)).uniform(-5 / 255, 5 / 255, image.shape) if dither else None
            out = composed(image, kernels.gaussian_blur(near, side) if side else near, config, air, 0.2 * u("baseline"), mask, strength, noise)
            yield f"haze_v2/{base}/{config[0]}", kernels.png(out), None

    return pairs.mapInArrow(_rows(one, "base"), SCHEMA)


def _rows(one: Callable[[dict], Iterator[tuple]], name: str):
    """Row by row, a record batch per result; an exception becomes the row's error."""

    def batch(x: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0]], pa.string()), pa.array([x[1]], pa.binary()), pa.array([x[2]], pa.string())], ["path", "data", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                row = rows.slice(k, 1).to_pylist()[0]
                try:
                    for x in one(row):
                        yield batch(x)
                except Exception as problem:  # logged as a row, the rest goes on
                    yield batch((row[name], None, f"{type(problem).__name__}: {problem}"))

    return run


def depth_maps(images: DataFrame, root: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """path (depth/<name>_depth.png), data and error; load() is called once a task and gives a predictor of (h, w, 3) to (h, w)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()

        def one(row: dict) -> Iterator[tuple]:
            pixels = np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], row["channels"])
            pixels = pixels[:, :, 2::-1] if pixels.shape[2] >= 3 else np.repeat(pixels, 3, axis=2)
            yield row["name"], kernels.png(kernels.normalise(np.asarray(predict(pixels), float), invert=True)), None

        yield from _rows(one, "name")(rows)

    name = F.concat(F.lit("depth/"), text.depth_name(text.relative(F.col("path"), F.lit(root))))
    return images.select(name.alias("name"), "height", "width", "channels", "pixels").mapInArrow(batches, SCHEMA)


def copies(files: DataFrame, root: str) -> DataFrame:
    """path (img/<name>) and data of binaryFile rows."""
    return files.select(F.concat(F.lit("img/"), text.relative(F.col("path"), F.lit(root))).alias("path"), F.col("content").alias("data"))
