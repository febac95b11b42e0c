"""Column expressions that read typed values out of catalog text. All accept streaming input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex for surrounding Unicode whitespace; Spark's trim() strips plain spaces only.
OUTER_SPACE = r"^[\s\p{Z}\x85\x1c-\x1f]+|[\s\p{Z}\x85\x1c-\x1f]+$"
# A decimal literal, optionally in exponent form, inside optional whitespace. Keeps `4d`, `nan` and
# `inf` out of the cast.
SPACE = r"[\s\p{Z}\x85\x1c-\x1f]*"
DECIMAL = f"^{SPACE}([+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?){SPACE}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.regexp_replace(_col(c), OUTER_SPACE, "")


def to_number(c, drop: str = "") -> Column:
    """Double read from text after removing the characters in `drop`; null when not a number."""
    text = F.translate(_col(c), drop, "") if drop else _col(c)
    value = F.regexp_extract(text, DECIMAL, 1).try_cast("double")
    # Exponents out of range read as infinity, which no measure can hold.
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def parse_price(c) -> Column:
    """`₹1,899` -> 1899.0"""
    return to_number(c, "₹,")


def parse_percent(c) -> Column:
    """`64%` -> 64.0"""
    return to_number(c, "%")


def parse_rating(c) -> Column:
    """`4.2` -> 4.2; values outside 0..5 are null."""
    value = to_number(c)
    return F.get(F.filter(F.array(value), lambda v: v.between(0.0, 5.0)), F.lit(0))


def parse_count(c) -> Column:
    """`24,269` -> 24269.0"""
    return to_number(c, ",")


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def path_levels(c, sep: str = r"\|") -> Column:
    """Levels of a delimited path; null for a blank path."""
    c = _col(c)
    return F.when(~_blank(c), F.split(c, sep, -1))


def path_depth(c, sep: str = r"\|") -> Column:
    """Number of levels, empty ones included; 0 for a blank path."""
    c = _col(c)
    return F.when(_blank(c), 0).otherwise(F.size(F.split(c, sep, -1)))


def list_size(c, sep: str = ",") -> Column:
    """Number of delimited parts, empty ones included; 0 for blank text."""
    return path_depth(c, sep)


def mean_part_length(c, sep: str = ",") -> Column:
    """Mean length of the non-empty stripped parts; 0 when there is none."""
    parts = F.filter(F.transform(F.split(_col(c), sep, -1), strip), lambda p: p != "")
    total = F.aggregate(parts, F.lit(0), lambda acc, p: acc + F.length(p))
    return F.when(F.size(parts) > 0, total / F.size(parts)).otherwise(0.0)
