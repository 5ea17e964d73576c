"""String expressions: member names, tags, replies, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Image extensions of the listings.
IMAGES = [".jpg", ".jpeg", ".png", ".bmp", ".webp"]
#: Extensions of originals (fixed values).
ORIGINALS = (".jpg", ".jpeg", ".png")
TOKEN = r"(\d+|[vhdbk][0-9.]*[0-9][0-9.]*)"
#: Fixed value: the pattern of a scored reply.
SCORE = r"(?i)(?:评分|Score)\s*[:：]\s*(\d+\.?\d*)\s*%?"


def _or_null(value: Column, pattern: Column) -> Column:
    return F.when(pattern, value)


def member_key(name: Column) -> Column:
    """Up to the first dot after the last slash; null without one."""
    return _or_null(F.regexp_extract(name, r"^((?:.*/)?[^/.]*)\.", 1), name.rlike(r"^(?:.*/)?[^/.]*\.[^/]*$"))


def member_field(name: Column) -> Column:
    return _or_null(F.regexp_extract(name, r"^(?:.*/)?[^/.]*\.([^/]*)$", 1), name.rlike(r"^(?:.*/)?[^/.]*\.[^/]*$"))


def base(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Last extension with its dot, lower case; empty without one."""
    return F.lower(F.regexp_extract(base(path), r"(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(base(path), r"\.[^.]+$", "")


def depth_name(path: Column) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit("_depth.png"))


def is_image(path: Column) -> Column:
    return suffix(path).isin(IMAGES)


def tag_type(tag: Column) -> Column:
    """out_<type>[_<number>] to <type>; a lone number stays; any other tag gives its first part."""
    rest = F.substring(tag, 5, 1 << 20)
    return (
        F.when(tag.startswith("out_") & rest.rlike(f"^{TOKEN}$"), rest)
        .when(tag.startswith("out_"), F.regexp_replace(rest, f"_{TOKEN}$", ""))
        .otherwise(F.substring_index(tag, "_", 1))
    )


def score(reply: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """First score in a reply; null if there is none or it is out of range."""
    value = F.regexp_extract(reply, SCORE, 1)
    number = F.when(value != "", value).try_cast("double")
    return F.when(number.between(low, high), number)


def reply_tail(reply: Column, question: str) -> Column:
    """What follows the last repetition of the question."""
    return F.trim(F.substring_index(reply, question, -1))


def first_digits(name: Column) -> Column:
    return F.regexp_extract(name, r"(\d+)", 1)


def relative(path: Column, prefix: Column) -> Column:
    return F.regexp_replace(F.when(F.startswith(path, prefix), F.substring(path, F.char_length(prefix) + 1, F.lit(1 << 20))).otherwise(path), "^/+", "")


def utf8_or_skip(data: Column) -> Column:
    """Text of bytes without what isn't UTF-8; valid bytes stay as they are."""
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(F.replace(F.make_valid_utf8(data.cast("string")), F.lit("�"), F.lit("")))


def utf8_or_stop(data: Column) -> Column:
    """Text of bytes; the query stops with an error where they aren't UTF-8."""
    return F.validate_utf8(data.cast("string"))
