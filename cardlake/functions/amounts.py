"""Money and ratio expressions. Sums stay DECIMAL until the last step, so they are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake import fixed_values
from cardlake.functions.text import fixed_lookup

RATE_TYPE = "decimal(10,6)"


def usd(amount: Column, currency: Column) -> Column:
    """Converted amount; NULL where the currency has no rate or the amount no room in 18 digits."""
    rate = fixed_lookup(currency, fixed_values.USD_PER_UNIT, RATE_TYPE)
    return F.round(amount.try_cast("decimal(18,6)") * rate, 6).try_cast("decimal(18,6)")


def usd_with_default(amount: Column, currency: Column) -> Column:
    """Dashboard conversion: a currency without a rate takes the default rate."""
    rate = F.coalesce(
        fixed_lookup(currency, fixed_values.DASHBOARD_USD_PER_UNIT, RATE_TYPE),
        F.lit(fixed_values.DASHBOARD_DEFAULT_RATE).cast(RATE_TYPE),
    )
    return F.round(amount.try_cast("decimal(18,6)") * rate, 6).try_cast("decimal(18,6)")


def rounded_sum(amount: Column, digits: int = 2) -> Column:
    return F.round(F.sum(amount), digits)


def quotient(total: Column, count: Column, digits: int = 2) -> Column:
    """Rounded ``total / count``, NULL when there is nothing to divide by."""
    return F.round(total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0)), digits)


def rounded_mean(amount: Column, digits: int = 2) -> Column:
    return quotient(F.sum(amount), F.count(amount), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL when the whole is 0."""
    base = F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * part.cast("double") / base, digits)


def percent_or_zero(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded percentage; an empty whole counts as 1, so the answer is 0 and not NULL."""
    return percent(part, F.greatest(whole, F.lit(1)), digits)


def rate_band(rate: Column) -> Column:
    return F.when(rate < 50, "low").when(rate < 80, "medium").otherwise("high")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, amount: Column) -> Column:
    """Sum of the amounts under a condition; rows outside it add 0."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0).cast("decimal(18,4)")))
