"""Raw text tables → typed, cleaned, deduplicated curated tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import fixed_values
from cardlake.functions import amounts, calendar, casting, text
from cardlake.operators.dedup import one_per_key
from cardlake.sources.datasets import write_counted
from cardlake.sources.shared import scratch, settle

PARTITIONS = {
    "transactions": ("year", "month"),
    "clearing": ("period",),
    "cards": ("card_type",),
    "users": (),
    "orgs": (),
}

#: Texts whose lengths vary most; rows are shuffled with them last.
VARYING = {
    "transactions": ("card_id", "id", "merchant"),
    "clearing": ("card_holder", "period", "capture_date", "transaction_id", "tenant_name", "merchant_name"),
}

MONEY_COLUMNS = ("actual_amount", "billing_amount", "transaction_amount", "fee_amount")
CLEARING_MONEY_COLUMNS = ("transaction_amount", "interchange_recon_fee_amount", "gtv")
CLEARING_TIME_COLUMNS = ("transaction_timestamp", "capture_date", "settlement_date")


def _replace(df: DataFrame, changed: dict[str, Column]) -> list[Column]:
    """All columns in place, the named ones replaced; names the table lacks are skipped."""
    return [changed[c].alias(c) if c in changed else F.col(c) for c in df.columns]


def snake_case(df: DataFrame) -> DataFrame:
    """Header names in lower case, blanks and repeated underscores as one underscore."""
    names = [re.sub(r"[\s_]+", "_", c.strip()).lower() for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns have the same name after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def type_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions, before any row is dropped."""
    changed = {c: casting.money(F.col(c), 4) for c in MONEY_COLUMNS}
    changed |= {c: casting.instant(F.col(c)) for c in ("transaction_timestamp", "clearing_timestamp")}
    changed |= {c: casting.text_id(F.col(c)) for c in ("id", "card_id")}
    return raw.select(_replace(raw, changed))


def known_currency(df: DataFrame) -> DataFrame:
    """Rows with an accepted transaction currency; a missing one is not accepted."""
    return df.filter(F.col("transaction_currency").isin(*fixed_values.CURRENCIES))


def clean_transactions(typed: DataFrame) -> DataFrame:
    """Rows with an accepted currency, the given columns cleaned."""
    kept = known_currency(typed)
    return kept.select(_replace(kept, {"merchant_city": text.title_words(F.col("merchant_city"))}))


def _month() -> list[Column]:
    at = F.col("transaction_timestamp")
    return [calendar.year_text(at).alias("year"), calendar.month_text(at).alias("month")]


def derive_transactions(cleaned: DataFrame) -> DataFrame:
    """Add the columns that follow from the given ones of the same row."""
    return cleaned.select(
        "*",
        text.merchant_name(F.col("merchant")).alias("merchant_normalized"),
        amounts.usd(F.col("billing_amount"), F.col("billing_currency")).alias("usd_amount"),
        *_month(),
    )


def enrich_transactions(typed: DataFrame) -> DataFrame:
    return derive_transactions(clean_transactions(typed))


def _unique_transactions(raw: DataFrame) -> DataFrame:
    return one_per_key(clean_transactions(type_transactions(raw)), ["id"], varying=VARYING["transactions"])


def curate_transactions(raw: DataFrame) -> DataFrame:
    """Derived columns stand last and never decide between rows, so survivors alone get them."""
    return derive_transactions(_unique_transactions(raw))


def clean_clearing(raw: DataFrame) -> DataFrame:
    """Renamed and typed clearing rows."""
    named = snake_case(raw)
    changed = {c: casting.money(F.col(c), 6) for c in CLEARING_MONEY_COLUMNS}
    if "settlement_status" in named.columns:
        changed["settlement_status"] = text.code(F.col("settlement_status"))
    return named.select(*_replace(named, changed))


def add_instants(cleaned: DataFrame) -> DataFrame:
    """Add UTC timestamps beside the given texts."""
    instants = [
        casting.first_instant(F.col(c), fixed_values.CLEARING_TIME_PATTERNS).alias(f"{c}_utc")
        for c in CLEARING_TIME_COLUMNS
        if c in cleaned.columns
    ]
    return cleaned.select("*", *instants)


def type_clearing(raw: DataFrame) -> DataFrame:
    """Renamed and typed clearing rows with UTC timestamps beside the given texts."""
    return add_instants(clean_clearing(raw))


def add_period(typed: DataFrame) -> DataFrame:
    given = F.col("period") if "period" in typed.columns else None
    captured = F.col("capture_date_utc") if "capture_date_utc" in typed.columns else None
    return typed.withColumn("period", calendar.period_key(given, captured))


def _clearing_in_steps(raw: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Unique rows without their timestamps, and what adds these."""
    typed = add_period(type_clearing(raw))
    given = typed.drop(*(f"{c}_utc" for c in CLEARING_TIME_COLUMNS if c in typed.columns))
    unique = one_per_key(given, ["transaction_id"], varying=VARYING["clearing"])
    return unique, lambda rows: add_instants(rows).select(typed.columns)


def curate_clearing(raw: DataFrame) -> DataFrame:
    """Timestamps follow from texts that stand before them, so survivors alone get them."""
    unique, finish = _clearing_in_steps(raw)
    return finish(unique)


def type_cards(raw: DataFrame) -> DataFrame:
    changed = {"allow_atm": casting.flag(F.col("allow_atm"))}
    changed |= {c: casting.day(F.col(c)) for c in ("issue_date", "expiry_date", "active_since")}
    changed |= {c: casting.instant(F.col(c)) for c in ("created_at", "updated_at")}
    changed |= {c: casting.text_id(F.col(c)) for c in ("id", "card_holder_id", "organization_id")}
    changed |= {c: text.code(F.col(c)) for c in ("card_type", "status", "scheme", "subtype")}
    return raw.select(_replace(raw, changed))


def curate_cards(raw: DataFrame) -> DataFrame:
    return one_per_key(type_cards(raw), ["id"], _latest())


def curate_users(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Users without e-mail, phone and password; hashes of the first two stay for joining.

    ``strict`` hashes the two name columns as well.
    """
    changed = {c: casting.flag(F.col(c)) for c in ("is_active", "is_verified")}
    changed |= {c: casting.instant(F.col(c)) for c in ("created_at", "updated_at")}
    changed["id"] = casting.text_id(F.col("id"))
    if strict:
        changed |= {c: text.digest_folded(F.col(c)) for c in ("first_name", "last_name")}
    safe = raw.select(
        *_replace(raw, changed),
        text.digest_folded(F.col("email")).alias("email_hash"),
        text.digest(F.col("phone_number")).alias("phone_hash"),
    ).drop(*fixed_values.SECRET_USER_COLUMNS)
    return one_per_key(safe, ["id"], _latest())


def curate_orgs(raw: DataFrame) -> DataFrame:
    """Organisations; an employee band such as ``11-25`` has no number, only its two edges."""
    low, high = casting.band_edges(F.col("number_of_employees"))
    counts = ("invoices_per_month", "number_of_employees")
    changed = {c: casting.whole_number(F.col(c)) for c in counts}
    changed |= {c: casting.instant(F.col(c)) for c in ("created_at", "updated_at", "deleted_at")}
    changed["id"] = casting.text_id(F.col("id"))
    changed["business_name"] = F.trim(F.col("business_name"))
    changed["country"] = text.code(F.col("country"))
    typed = raw.select(
        *_replace(raw, changed), low.alias("employees_min"), high.alias("employees_max")
    )
    return one_per_key(typed, ["id"], _latest())


def _latest() -> list[Column]:
    return [F.col("updated_at").desc_nulls_last()]


CURATE = {
    "transactions": curate_transactions,
    "clearing": curate_clearing,
    "cards": curate_cards,
    "users": curate_users,
    "orgs": curate_orgs,
}


def write_curated(source: str, raw: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Curate a source into its folders; ``(dataset, rows)``.

    Rows are dealt to their folders before they gain the columns that follow from others of the same row,
    so these are not shuffled. Unique rows of the large sources are settled first: the shuffles that find them
    are dropped before the one into folders.
    """
    with scratch(raw.sparkSession):
        if source == "transactions":
            rows = settle(_unique_transactions(raw), "unique_rows").select("*", *_month())
            finish = lambda dealt: derive_transactions(dealt.drop("year", "month"))
        elif source == "clearing":
            rows, finish = _clearing_in_steps(raw)
            rows = settle(rows, "unique_rows")
        else:
            rows, finish = CURATE[source](raw), None
        return write_counted(rows, path, PARTITIONS[source], varying=VARYING.get(source, ()), finish=finish)


# Key column of each curated table, and which of several rows with one key is preferred; ties go by all
# other columns (see ``one_per_key``).
SURVIVORS: dict[str, tuple[str, tuple[str, ...]]] = {
    "transactions": ("id", ()),
    "clearing": ("transaction_id", ()),
    "cards": ("id", ("updated_at",)),
    "users": ("id", ("updated_at",)),
    "orgs": ("id", ("updated_at",)),
}


def preferred(source: str) -> list[Column]:
    """The latest of the preferred columns first, missing ones last."""
    return [F.col(c).desc_nulls_last() for c in SURVIVORS[source][1]]
