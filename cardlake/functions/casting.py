"""Tolerant casts from raw text: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, scale: int) -> Column:
    return value.try_cast(f"decimal(18,{scale})")


def whole_number(value: Column) -> Column:
    return value.try_cast("int")


def flag(value: Column) -> Column:
    return value.try_cast("boolean")


def day(value: Column) -> Column:
    return value.try_cast("date")


def instant(value: Column) -> Column:
    return value.try_cast("timestamp")


def text_id(value: Column) -> Column:
    return value.cast("string")


# Regular expression of the texts each pattern letter group can read.
_SHAPES = {
    "yyyy": r"\d{4}",
    "MM": r"(0[1-9]|1[0-2])",
    "dd": r"(0[1-9]|[12]\d|3[01])",
    "HH": r"([01]\d|2[0-3])",
    "mm": r"[0-5]\d",
    "ss": r"[0-5]\d",
    "SSS": r"\d{1,3}",
    "XXX": r"(Z|[+-]\d{2}:\d{2})",
    "Z": r"[+-]\d{4}",
    "'T'": "T",
    ".": r"\.",
}


def shape_of(pattern: str) -> str:
    """Regular expression that every text readable by the pattern matches."""
    groups = sorted(_SHAPES, key=len, reverse=True)
    found = re.split("(" + "|".join(re.escape(g) for g in groups) + ")", pattern)
    return "^" + "".join(_SHAPES.get(piece, piece) for piece in found) + "$"


def first_instant(value: Column, patterns: Iterable[str]) -> Column:
    """The value read by the first pattern that fits, NULL if none does.

    A failing parse costs an exception inside Spark, so each parser only sees texts of its shape.
    """
    return F.coalesce(
        *(F.when(value.rlike(shape_of(p)), F.try_to_timestamp(value, F.lit(p))) for p in patterns)
    )


def band_edges(value: Column) -> tuple[Column, Column]:
    """Lower and upper edge of a band such as ``11-25``; a plain number is both edges."""
    parts = F.split(value, "-")
    return whole_number(F.try_element_at(parts, F.lit(1))), whole_number(
        F.try_element_at(parts, F.lit(-1))
    )
