"""Colour and quantising expressions on doubles in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(v: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(v, F.lit(high)), F.lit(low))


def to_linear(v: Column) -> Column:
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def to_srgb(v: Column) -> Column:
    return F.when(v <= 0.0031308, v * 12.92).otherwise(F.pow(v, F.lit(1 / 2.4)) * 1.055 - 0.055)


def half_up(v: Column) -> Column:
    return F.floor(v * 255.0 + 0.5).cast("long")


def cut_off(v: Column) -> Column:
    return F.floor(v * 255.0).cast("long")


def desaturate(rgb: tuple[int, int, int], factor: float) -> tuple[int, int, int]:
    """8-bit HSV with a truncated saturation; used on constants only."""
    import colorsys

    h, s, v = colorsys.rgb_to_hsv(*(x / 255 for x in rgb))
    s8 = int(round(s * 255) * factor)
    h2 = round(h * 180) / 180
    return tuple(round(x * 255) for x in colorsys.hsv_to_rgb(h2, s8 / 255, v))
