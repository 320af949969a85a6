"""Text clean-up, hashing and fixed lookups."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake import fixed_values


def code(value: Column) -> Column:
    return F.upper(F.trim(value))


def title_words(value: Column) -> Column:
    """Capital after each blank, the rest lower case."""
    return F.initcap(F.trim(value))


def title_letters(value: Column) -> Column:
    """Capital after anything that is not a letter, the rest lower case."""
    pieces = F.split(F.lower(value), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(pieces, F.initcap), "")


def digest(value: Column) -> Column:
    return F.sha2(F.trim(value), 256)


def digest_folded(value: Column) -> Column:
    return F.sha2(F.lower(F.trim(value)), 256)


def digest_short(value: Column) -> Column:
    """First 16 hex digits; blank and missing values stay blank."""
    trimmed = F.trim(value)
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit("")).otherwise(
        F.left(F.sha2(trimmed, 256), F.lit(16))
    )


def fixed_lookup(value: Column, table: Mapping[str, str], as_type: str = "string") -> Column:
    """Value for a key of a small constant table, NULL for any other key."""
    entries = chain.from_iterable((F.lit(k), F.lit(v).cast(as_type)) for k, v in table.items())
    return F.try_element_at(F.create_map(*entries), value)


def merchant_name(value: Column) -> Column:
    known = fixed_lookup(F.lower(F.trim(value)), fixed_values.MERCHANT_SPELLINGS)
    return F.coalesce(known, title_words(value))


def exposure(currency: Column, home: str = "Domestic", other: str = "Foreign") -> Column:
    return F.when(currency == fixed_values.HOME_CURRENCY, home).otherwise(other)
