"""Reports: HTML galleries, contact sheets, lists and tables as files."""

from __future__ import annotations

from collections.abc import Iterable
from html import escape

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.operators import kernels
from veilwork.sources.storage import opened, write_whole

STYLE = "body{background:#181818;color:#ddd;font-family:sans-serif}section{border-top:1px solid #444}figure{display:inline-block;margin:6px}img{height:220px}"


def escaped(value: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(raw), F.lit(entity))
    return value


def image_name(key: Column, field: Column, between: str = "__") -> Column:
    """File of a gallery image: slashes of the key become two underscores."""
    return F.concat(F.lit("images/"), F.replace(key, F.lit("/"), F.lit("__")), F.lit(between), field)


def sections(cells: DataFrame, between: str = "__") -> DataFrame:
    """key, html of cells (key, title, place, field, caption): a section per sample; a null field is an empty cell with its caption.

    between: what image files have between key and field; `write_gallery` keeps to two underscores, members of shards have a dot.
    """
    image = F.concat(F.lit('<img loading="lazy" src="'), escaped(image_name(F.col("key"), F.col("field"), between)), F.lit('" alt="">'))
    cell = F.concat(F.lit("<figure>"), F.coalesce(image, F.lit("")), F.lit("<figcaption>"), escaped(F.coalesce("caption", F.lit(""))), F.lit("</figcaption></figure>"))
    rows = cells.groupBy("key").agg(F.min("title").alias("title"), F.array_sort(F.collect_list(F.struct("place", cell.alias("cell")))).alias("cells"))
    return rows.select("key", F.concat(F.lit("<section><h3>"), escaped(F.coalesce("title", "key")), F.lit("</h3>"), F.array_join(F.col("cells.cell"), ""), F.lit("</section>")).alias("html"))


def write_gallery(cells: DataFrame, folder: str, title: str, note: str = "") -> str:
    """index.html of a picked sample in the folder, sections by key; they pass the driver one partition at a time."""
    head = f'<!doctype html><html><head><meta charset="utf-8"><title>{escape(title)}</title><style>{STYLE}</style></head><body><h1>{escape(title)}</h1><p>{escape(note)}</p>\n'
    files, root = opened(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/index.html", compression=None) as out:
        out.write(head.encode())
        for row in sections(cells).orderBy("key").toLocalIterator():
            out.write((row["html"] + "\n").encode())
        out.write(b"</body></html>\n")
    return f"{root}/index.html"


def contact_sheet(rows: Iterable[list[np.ndarray]], height: int = 256) -> np.ndarray:
    """Rows of images (h, w, 3), each scaled to one height, side by side on black, rows below each other; one black pixel without images."""
    lines = []
    for images in rows:
        small = [np.dstack([kernels.resize(x[:, :, c], height, max(int(x.shape[1] * height / x.shape[0]), 1)) for c in range(3)]) for x in images]
        if small:
            lines.append(np.rint(np.concatenate(small, axis=1)).astype(np.uint8))
    width = max((x.shape[1] for x in lines), default=1)
    sheet = np.zeros((height * len(lines) or 1, width, 3), np.uint8)
    for k, line in enumerate(lines):
        sheet[k * height : (k + 1) * height, : line.shape[1]] = line
    return sheet


def write_sheet(rows: Iterable[list[np.ndarray]], path: str, height: int = 256) -> None:
    write_whole(*opened(path), kernels.png(contact_sheet(rows, height)))


def write_details(scored: DataFrame, folder: str) -> None:
    """Scored rows as CSV with a header, in as many files as there are partitions."""
    scored.write.mode("overwrite").option("header", True).csv(folder)


def write_summary(summary: DataFrame, folder: str) -> None:
    """One CSV file: a row per task and method, in place of a spreadsheet."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)


def write_missing(matched: DataFrame, folder: str) -> None:
    """Sorted names without a path, a line each; files follow each other in name order."""
    matched.where("path is null").select("base").orderBy("base").write.mode("overwrite").text(folder)


def match_counts(matched: DataFrame) -> DataFrame:
    """total, matched, missing."""
    return matched.agg(F.count("*").alias("total"), F.count("path").alias("matched"), F.count_if(F.col("path").isNull()).alias("missing"))
