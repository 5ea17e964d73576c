"""Presets, render configurations and the scattering formula as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilwork.functions.color import clamp, desaturate, half_up, to_linear, to_srgb

#: Presets by mode: omega0, eta, scale height, airlight, spectral weights.
PRESETS = {
    "fog": ((1.0, 1.0, 1.0), 0.7, 100.0, (1.0, 1.0, 1.0), (1.0, 1.0, 1.0)),
    "haze": ((1.0, 1.0, 1.0), 1.0, 1200.0, (0.6, 0.75, 1.0), (1.1, 1.0, 0.9)),
    "smoke": ((0.8, 0.8, 0.8), 0.9, 50.0, (0.75, 0.65, 0.55), (0.9, 1.0, 1.1)),
}
#: Haze airlights (8 bit) and visibilities; fog by visibility; valley fog; smoke.
HAZE_AIR = {"sky-blue": desaturate((153, 174, 215), 0.7), "warm-urban": (200, 180, 140), "pale-gray": (210, 210, 220), "brownish-dust": (190, 170, 150)}
HAZE_VIS = [100, 200, 300, 500, 1000]
FOG = [(1000, 1.0), (500, 0.95), (300, 1.0), (200, 0.95), (120, 0.9), (80, 0.85), (40, 0.5)]
VALLEY = [(30, 30, 120), (50, 45, 120), (70, 60, 120)]
SMOKE = [
    ("light", 250, (200, 180, 160), 0.95, 0.85, None, None), ("medium", 150, (180, 150, 120), 0.9, 0.8, None, None), ("heavy", 80, (160, 120, 90), 0.85, 0.75, 40, 60),
    *[(f"coolgray_{v}", v, (180, 180, 190), 0.92, 0.85, None, None) for v in (120, 200, 500, 1000)],
]

SCHEMA = "filename string, mode string, dmax double, zgamma double, visibility double, airlight array<int>, eta double, h_scale double, hmax double, omega0 double"


def config_rows() -> list[tuple]:
    haze = [(f"out_haze_{n}_v{v}.png", "haze", 120.0, 1.0, float(v), list(a), None, None, None, None) for n, a in HAZE_AIR.items() for v in HAZE_VIS]
    fog = [(f"out_fog_{v}.png", "fog", 60.0, 1.0, float(v), None, eta, None, None, None) for v, eta in FOG]
    fog += [(f"out_fog_valley_h{h}.png", "fog", 60.0, 1.0, float(v), None, None, float(h), float(m), None) for v, h, m in VALLEY]
    smoke = [(f"out_smoke_{n}.png", "smoke", 100.0, 1.0, float(v), list(a), eta, float(h) if h else None, float(m) if m else None, om) for n, v, a, eta, om, h, m in SMOKE]
    return haze + fog + smoke


def configs(spark: SparkSession) -> DataFrame:
    """The 37 render configurations; a null takes the preset's value."""
    return spark.createDataFrame(config_rows(), SCHEMA)


def presets(spark: SparkSession) -> DataFrame:
    rows = [(m, o[0], e, h, [float(x) for x in a], [float(x) for x in s]) for m, (o, e, h, a, s) in PRESETS.items()]
    return spark.createDataFrame(rows, "mode string, p_omega0 double, p_eta double, p_h double, p_air array<double>, spectral array<double>")


def resolved(spark: SparkSession) -> DataFrame:
    """Configurations with presets filled in; the highest point defaults to the preset's scale height, not an overridden one."""
    air = F.coalesce(F.transform("airlight", lambda x: x / F.lit(255.0)), F.col("p_air"))
    return configs(spark).join(F.broadcast(presets(spark)), "mode").select(
        "filename", "mode", "dmax", "zgamma", "visibility", "spectral", air.alias("air"),
        F.coalesce("eta", "p_eta").alias("eta"), F.coalesce("h_scale", "p_h").alias("h_scale"), F.coalesce("hmax", "p_h").alias("hmax"), F.coalesce("omega0", "p_omega0").alias("omega0"),
    )


def height(y: Column, rows: Column, hmax: Column) -> Column:
    return hmax * (1 - F.when(rows > 1, y / (rows - 1)).otherwise(F.lit(0.0)))


def compose(pixel: Column, z: Column, h: Column, c: int, baseline: Column | None = None, mask: Column | None = None, strength: float = 0.5) -> Column:
    """8-bit value of channel c; other inputs are the columns of `resolved`."""
    d = F.pow(clamp(z), F.col("zgamma")) * F.col("dmax")
    beta = F.lit(3.912) / F.col("visibility") * F.col("spectral")[c]
    phi = F.exp(-F.greatest(h, F.lit(0.0)) / F.greatest(F.lit(1e-6), F.col("h_scale")))
    tau = beta * phi * d + (F.lit(0.0) if baseline is None else baseline)
    if mask is not None:
        tau = tau * (F.lit(1.0 - strength) + F.lit(strength) * mask)
    t = F.exp(-tau)
    out = to_linear(clamp(pixel)) * t + to_linear(clamp(F.col("air")[c])) * F.col("omega0") * (1 - F.pow(t, F.col("eta")))
    return half_up(clamp(to_srgb(clamp(out))))


def blur_size(visibility: Column, coin: Column) -> Column:
    """Side of the depth blur of fog; null for none."""
    return (
        F.when((visibility >= 30) & (visibility < 50), 7).when((visibility >= 50) & (visibility < 70), 11)
        .when(visibility <= 100, 3).when(coin < 0.5, 3)
    )
