"""Pseudonymised copies of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import text
from cardlake.operators.keys import ordinal_by_number
from cardlake.operators.replacement import replace_in_columns

CARD_TEXTS = ("name_on_card", "card_nickname")
TRANSACTION_TEXTS = ("merchant",)
CLEARING_TEXTS = ("Tenant Name", "Merchant Name", "Card Holder")
REDACTED = "[REDACTED]"


def _labels(kind: str, number: Column) -> dict[str, Column]:
    """The three spellings of a label: ``thing_1``, ``Thing 1``, ``THING 1``."""
    n = number.cast("string")
    return {
        "plain": F.concat(F.lit(f"{kind}_"), n),
        "title": F.concat(F.lit(f"{kind.title()} "), n),
        "upper": F.concat(F.lit(f"{kind.upper()} "), n),
    }


def _dictionary(entities: DataFrame, variants: list[tuple[Column, Column]]) -> DataFrame:
    """One entry per distinct spelling.

    Entities count in order of ``n``, their variants in the given order. Where a spelling occurs
    again, the later replacement wins but the first occurrence keeps the place in the order.
    """
    width = len(variants)
    rows = F.array(
        *(
            F.struct(
                old.alias("old"),
                new.alias("new"),
                (F.col("n") * width + i).alias("place"),
            )
            for i, (old, new) in enumerate(variants)
        )
    )
    return (
        entities.select(F.inline(rows))
        .filter(F.length("old") > 0)
        .groupBy("old")
        .agg(F.max_by("new", "place").alias("new"), F.min("place").alias("rank"))
    )


def org_dictionary(orgs: DataFrame) -> DataFrame:
    """Spellings of organisation names → labels numbered by organisation id."""
    numbered = ordinal_by_number(orgs.select("id", "name", "business_name"), "id", "n")
    label = _labels("business", F.col("n"))
    name, business = F.trim("name"), F.trim("business_name")
    return _dictionary(
        numbered,
        [
            (name, label["title"]),
            (F.upper(name), label["upper"]),
            (F.lower(name), label["plain"]),
            (business, label["plain"]),
            (F.lower(business), label["plain"]),
            (text.title_letters(business), label["title"]),
            (F.upper(business), label["upper"]),
        ],
    )


def user_dictionary(users: DataFrame) -> DataFrame:
    """Full names → labels numbered by user id."""
    numbered = ordinal_by_number(users.select("id", "first_name", "last_name"), "id", "n")
    label = _labels("user", F.col("n"))
    parts = [F.coalesce(F.trim(c), F.lit("")) for c in ("first_name", "last_name")]
    full = F.trim(F.concat_ws(" ", *parts))
    return _dictionary(numbered, [(full, label["title"]), (F.upper(full), label["upper"])])


def anonymise_orgs(orgs: DataFrame) -> DataFrame:
    label = _labels("business", F.col("n"))
    replaced = {
        "name": label["title"],
        "business_name": label["plain"],
        "contact_number": F.lit(""),
    }
    return _with(ordinal_by_number(orgs, "id", "n"), orgs.columns, replaced)


def anonymise_users(users: DataFrame) -> DataFrame:
    replaced = {
        "first_name": F.lit("User"),
        "last_name": F.col("n").cast("string"),
        "email": text.digest_short(F.col("email")),
        "phone_number": text.digest_short(F.col("phone_number")),
        "password": F.lit(REDACTED),
    }
    return _with(ordinal_by_number(users, "id", "n"), users.columns, replaced)


def anonymise_cards(cards: DataFrame, dictionary: DataFrame) -> DataFrame:
    return replace_in_columns(cards, CARD_TEXTS, dictionary)


def anonymise_transactions(transactions: DataFrame, dictionary: DataFrame) -> DataFrame:
    return replace_in_columns(transactions, TRANSACTION_TEXTS, dictionary)


def anonymise_clearing(clearing: DataFrame, dictionary: DataFrame) -> DataFrame:
    return replace_in_columns(clearing, CLEARING_TEXTS, dictionary)


def _with(df: DataFrame, columns: list[str], replaced: dict[str, Column]) -> DataFrame:
    return df.select(*(replaced[c].alias(c) if c in replaced else F.col(c) for c in columns))
