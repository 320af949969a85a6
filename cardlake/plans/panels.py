"""Dashboard panels over the curated tables. Groups without a key are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import amounts, calendar, casting, text
from cardlake.functions.amounts import count_where, percent_or_zero, rounded_sum
from cardlake.operators.quantiles import exact_quantiles
from cardlake.plans.curation import PARTITIONS
from cardlake.sources.datasets import read_first
from cardlake.sources.raw import read_raw

MICROS_PER_HOUR = 3_600_000_000
LONGEST_LAG_HOURS = 240
BINS = 40
BIN_HOURS = LONGEST_LAG_HOURS // BINS


def _settled(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("status") == "SETTLED")


def light_clean(raw: DataFrame) -> DataFrame:
    """The columns the panels need, from raw text, where no curated dataset exists."""
    at = casting.instant(F.col("transaction_timestamp"))
    billing = casting.money(F.col("billing_amount"), 4)
    replaced = {
        "transaction_timestamp": at,
        "clearing_timestamp": casting.instant(F.col("clearing_timestamp")),
        "billing_amount": billing,
        "transaction_amount": casting.money(F.col("transaction_amount"), 4),
    }
    return raw.select(
        *((replaced[c].alias(c) if c in replaced else F.col(c)) for c in raw.columns),
        calendar.year_text(at).alias("year"),
        calendar.month_text(at).alias("month"),
        amounts.usd_with_default(billing, F.col("billing_currency")).alias("usd_amount"),
        text.title_letters(F.trim("merchant")).alias("merchant_normalized"),
    )


def light_cards(raw: DataFrame) -> DataFrame:
    """Raw cards with the two codes that the panels count by cleaned."""
    codes = ("card_type", "status")
    return raw.select(*(text.code(F.col(c)).alias(c) if c in codes else F.col(c) for c in raw.columns))


# What is cleaned of each source where no curated dataset exists.
LIGHT = {"transactions": light_clean, "cards": light_cards, "orgs": lambda raw: raw}


def load_source(spark: SparkSession, curated_root: str, raw_root: str, source: str) -> DataFrame:
    """The curated dataset of a source if there is one, else its raw files, lightly cleaned.

    Partition values of a curated dataset stay text, as they are in curation.
    """

    def fallback() -> DataFrame:
        return LIGHT[source](read_raw(spark, raw_root, source))

    found = read_first(spark, f"{curated_root}/{source}", None, fallback)
    return found.select(
        *(partition_text(c).alias(c) if c in PARTITIONS[source] else F.col(f"`{c}`") for c in found.columns)
    )


def partition_text(name: str) -> Column:
    """A partition value as the text in the folder's name, of which reading made a number."""
    return F.lpad(F.col(name).cast("string"), 2, "0") if name == "month" else F.col(name).cast("string")


def kpis(transactions: DataFrame) -> DataFrame:
    status = F.col("status")
    settled, declined = count_where(status == "SETTLED"), count_where(status == "DECLINED")
    every = F.count("*")
    return transactions.agg(
        F.round(amounts.sum_where(status == "SETTLED", F.col("billing_amount")), 2).alias(
            "total_spend_aed"
        ),
        every.alias("total_transactions"),
        settled.alias("settled_count"),
        percent_or_zero(settled, every).alias("settled_pct"),
        declined.alias("declined_count"),
        percent_or_zero(declined, every).alias("declined_pct"),
    )


def org_of_settled(transactions: DataFrame, cards: DataFrame, orgs: DataFrame) -> DataFrame:
    """Settled spend per card with the organisation's name, ``Unknown Org`` where there is none.

    Rows are reduced to one per card first, so a hot or missing card id is one row in the joins.
    """
    per_card = (
        _settled(transactions).groupBy("card_id").agg(F.sum("billing_amount").alias("spend"))
    )
    owners = cards.select(F.col("id").alias("card_id"), "organization_id")
    names = orgs.select(F.col("id").alias("organization_id"), "business_name")
    return (
        per_card.join(owners, "card_id", "left")
        .join(names, "organization_id", "left")
        .withColumn("business_name", F.coalesce("business_name", F.lit("Unknown Org")))
    )


def org_top(
    transactions: DataFrame, cards: DataFrame, orgs: DataFrame, limit: int = 15
) -> DataFrame:
    return (
        org_of_settled(transactions, cards, orgs)
        .groupBy("business_name")
        .agg(rounded_sum(F.col("spend")).alias("total_aed"))
        .orderBy(F.col("total_aed").desc_nulls_last(), "business_name")
        .limit(limit)
    )


def volume(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("year").isNotNull() & F.col("month").isNotNull())
        .groupBy("year", "month")
        .agg(
            F.count("id").alias("txn_count"),
            rounded_sum(F.col("billing_amount")).alias("total_aed"),
        )
        .withColumn("period", calendar.year_month(F.col("year"), F.col("month")))
        .orderBy("period")
    )


def fx(transactions: DataFrame) -> DataFrame:
    currency = F.col("transaction_currency")
    return (
        _settled(transactions)
        .filter(currency.isNotNull())
        .groupBy(currency.alias("currency"))
        .agg(rounded_sum(F.col("billing_amount")).alias("total_aed"))
        .withColumn(
            "exposure_type",
            text.exposure(F.col("currency"), "Domestic (AED)", "Foreign Currency"),
        )
        .orderBy(F.col("total_aed").desc_nulls_last(), "currency")
    )


def merchants(transactions: DataFrame, limit: int = 10) -> DataFrame:
    return (
        _settled(transactions)
        .filter(F.col("merchant_normalized").isNotNull())
        .groupBy(F.col("merchant_normalized").alias("merchant"))
        .agg(rounded_sum(F.col("billing_amount")).alias("total_aed"))
        .orderBy(F.col("total_aed").desc_nulls_last(), "merchant")
        .limit(limit)
    )


def cards_panel(cards: DataFrame) -> DataFrame:
    every = F.count("*")
    active = count_where(F.col("status") == "ACTIVE")
    counted = cards.agg(
        every.alias("total_cards"),
        active.alias("active_cards"),
        count_where(F.col("status") == "TERMINATED").alias("terminated_cards"),
        count_where(F.col("card_type") == "VIRTUAL").alias("virtual_cards"),
        count_where(F.col("card_type") == "PHYSICAL").alias("physical_cards"),
        percent_or_zero(active, every).alias("active_rate_pct"),
    )
    rate = F.col("active_rate_pct")
    return counted.select(
        "*",
        amounts.rate_band(rate).alias("rate_band"),
        F.round(rate - 80, 1).alias("delta_to_target"),
    )


def lags(transactions: DataFrame) -> DataFrame:
    """Settled rows with their lag in whole microseconds, 0 to 240 hours inclusive."""
    micros = calendar.lag_micros(F.col("transaction_timestamp"), F.col("clearing_timestamp"))
    return (
        _settled(transactions)
        .select("id", micros.alias("lag_micros"))
        .filter(F.col("lag_micros").between(0, LONGEST_LAG_HOURS * MICROS_PER_HOUR))
    )


def lag_histogram(lagged: DataFrame) -> DataFrame:
    """Rows per 6-hour bin; the last bin includes 240 h, and empty bins count 0."""
    bin_of = F.least(F.floor(F.col("lag_micros") / (BIN_HOURS * MICROS_PER_HOUR)), F.lit(BINS - 1))
    counted = lagged.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    every_bin = lagged.sparkSession.range(BINS).select(F.col("id").alias("bin"))
    return every_bin.join(counted, "bin", "left").select(
        "bin",
        (F.col("bin") * BIN_HOURS).alias("from_hour"),
        ((F.col("bin") + 1) * BIN_HOURS).alias("to_hour"),
        F.coalesce("n", F.lit(0)).alias("transactions"),
    )


def lag_summary(lagged: DataFrame) -> DataFrame:
    """Median, 95th percentile and maximum lag in hours, exact to the microsecond."""
    marks = {"median": 0.5, "p95": 0.95, "longest": 1.0}
    # Slices of one second: at most 864,001 slices and a million distinct values in each.
    found = exact_quantiles(lagged, [], "lag_micros", marks, slice_width=1_000_000)
    return found.select(
        *(
            F.round(F.col(n) / MICROS_PER_HOUR, 1).alias(alias)
            for n, alias in (
                ("median", "median_lag_hours"),
                ("p95", "p95_lag_hours"),
                ("longest", "max_lag_hours"),
            )
        )
    )
