"""Projections, casts, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlake import fixed_values
from cardlake.entries.lake import query
from cardlake.functions import amounts, calendar, casting, text
from cardlake.plans import curation, panels


# Casts ------------------------------------------------------------------------------------


@query("cast_money_4")
def cast_money_4(lake):
    cast = (casting.money(F.col(c), 4).alias(c) for c in curation.MONEY_COLUMNS)
    return lake.raw("transactions").select("id", *cast)


@query("cast_money_6")
def cast_money_6(lake):
    raw = curation.snake_case(lake.raw("clearing"))
    cast = (casting.money(F.col(c), 6).alias(c) for c in curation.CLEARING_MONEY_COLUMNS)
    return raw.select("transaction_id", *cast)


@query("parse_timestamp")
def parse_timestamp(lake):
    names = ("transaction_timestamp", "clearing_timestamp")
    return lake.raw("transactions").select(
        "id", *(casting.instant(F.col(c)).alias(c) for c in names)
    )


@query("parse_timestamp_multi_utc")
def parse_timestamp_multi_utc(lake):
    names = (f"{c}_utc" for c in curation.CLEARING_TIME_COLUMNS)
    return curation.type_clearing(lake.raw("clearing")).select("transaction_id", *names)


@query("cast_date")
def cast_date(lake):
    names = ("issue_date", "expiry_date", "active_since")
    return lake.raw("cards").select("id", *(casting.day(F.col(c)).alias(c) for c in names))


@query("cast_boolean")
def cast_boolean(lake):
    names = ("is_active", "is_verified")
    return lake.raw("users").select("id", *(casting.flag(F.col(c)).alias(c) for c in names))


@query("cast_integer_tolerant")
def cast_integer_tolerant(lake):
    employees = F.col("number_of_employees")
    low, high = casting.band_edges(employees)
    return lake.raw("orgs").select(
        "id",
        casting.whole_number(F.col("invoices_per_month")).alias("invoices_per_month"),
        casting.whole_number(employees).alias("number_of_employees"),
        low.alias("employees_min"),
        high.alias("employees_max"),
    )


@query("cast_ids_string")
def cast_ids_string(lake):
    ids = {"id": "c_custkey", "organization_id": "c_nationkey"}
    return lake.table("customer").select(
        *(casting.text_id(F.col(src)).alias(name) for name, src in ids.items())
    )


# Columns and rows ----------------------------------------------------------------------------


@query("rename_snake_case")
def rename_snake_case(lake):
    return curation.snake_case(lake.raw("clearing"))


@query("drop_columns")
def drop_columns(lake):
    return lake.raw("users").drop(*fixed_values.SECRET_USER_COLUMNS)


@query("filter_isin")
def filter_isin(lake):
    return curation.known_currency(lake.raw("transactions")).select("id", "transaction_currency")


@query("filter_not_null")
def filter_not_null(lake):
    names = [f"{c}_utc" for c in curation.CLEARING_TIME_COLUMNS]
    return lake.curated("clearing").dropna(subset=names).select("transaction_id", *names)


@query("filter_status")
def filter_status(lake):
    return lake.raw("transactions").select("id", "status").filter(
        F.col("status").isin("SETTLED", "REFUNDED")
    )


@query("filter_range")
def filter_range(lake):
    hours = calendar.lag_hours(F.col("transaction_timestamp"), F.col("clearing_timestamp"))
    return (
        lake.curated("transactions")
        .select("id", hours.alias("lag_hours"))
        .filter(F.col("lag_hours").between(0, panels.LONGEST_LAG_HOURS))
    )


@query("case_exposure")
def case_exposure(lake):
    currency = F.col("transaction_currency")
    return lake.curated("transactions").select(
        "id",
        text.exposure(currency).alias("exposure_type"),
        text.exposure(currency, "Domestic (AED)", "Foreign Currency").alias("panel_label"),
    )


@query("coalesce_defaults")
def coalesce_defaults(lake):
    return lake.raw("transactions").select(
        "id",
        F.coalesce("card_id", F.lit("")).alias("card_id"),
        F.coalesce("transaction_currency", F.lit(fixed_values.HOME_CURRENCY)).alias("currency"),
        F.coalesce(
            casting.money(F.col("billing_amount"), 4), F.lit(0).cast("decimal(18,4)")
        ).alias("billing_amount"),
    )


@query("safe_ratio_pct")
def safe_ratio_pct(lake):
    declined = F.count_if(F.col("status") == "DECLINED")
    settled = F.count_if((F.col("status") == "SETTLED") & (F.col("mcc") < "5025"))
    return lake.curated("transactions").groupBy("mcc").agg(
        amounts.percent(declined, F.count("*")).alias("declined_pct"),
        amounts.percent(declined, settled, 1).alias("declined_per_settled_pct"),
    )


@query("guarded_ratio")
def guarded_ratio(lake):
    settled = F.count_if(F.col("status") == "SETTLED")
    guarded = amounts.percent_or_zero(settled, F.count("*")).alias("settled_pct")
    rows = lake.curated("transactions")
    every = rows.agg(guarded).select(F.lit("all").alias("rows_of"), "settled_pct")
    none = rows.filter("status = 'NEVER'").agg(guarded)
    return every.unionByName(none.select(F.lit("none").alias("rows_of"), "settled_pct"))


@query("rate_band")
def rate_band(lake):
    rate = amounts.percent_or_zero(F.count_if(F.col("status") == "ACTIVE"), F.count("*"))
    rated = lake.curated("cards").groupBy("organization_id", "card_type").agg(rate.alias("rate"))
    return rated.select(
        "*",
        amounts.rate_band(F.col("rate")).alias("band"),
        F.round(F.col("rate") - 80, 1).alias("delta_to_target"),
    )


# Text --------------------------------------------------------------------------------------


@query("fn_upper_trim")
def fn_upper_trim(lake):
    names = ("card_type", "status", "scheme", "subtype")
    return lake.raw("cards").select("id", *(text.code(F.col(c)).alias(c) for c in names))


@query("fn_title_case")
def fn_title_case(lake):
    names = ("merchant", "merchant_city")
    return lake.raw("transactions").select(
        "id", *(text.title_words(F.col(c)).alias(c) for c in names)
    )


@query("fn_title_case_letters")
def fn_title_case_letters(lake):
    return lake.raw("transactions").select(
        "id", text.title_letters(F.trim("merchant")).alias("merchant")
    )


@query("fn_sha256")
def fn_sha256(lake):
    return lake.raw("users").select(
        "id",
        text.digest_folded(F.col("email")).alias("email_hash"),
        text.digest(F.col("phone_number")).alias("phone_hash"),
    )


@query("fn_sha256_16")
def fn_sha256_16(lake):
    names = ("email", "phone_number")
    return lake.raw("users").select("id", *(text.digest_short(F.col(c)).alias(c) for c in names))


@query("fn_lpad_month")
def fn_lpad_month(lake):
    return lake.table("orders").select(
        "o_orderkey", calendar.month_text(F.col("o_orderdate")).alias("month")
    )


@query("fn_concat_year_month")
def fn_concat_year_month(lake):
    return lake.curated("transactions").select(
        "id", calendar.year_month(F.col("year"), F.col("month")).alias("year_month")
    )


@query("fn_regex_period")
def fn_regex_period(lake):
    return lake.raw("clearing").select(
        F.col("Transaction ID").alias("transaction_id"),
        calendar.leading_year_month(F.col("Period")).alias("period"),
    )


@query("fn_date_format_period")
def fn_date_format_period(lake):
    typed = curation.type_clearing(lake.raw("clearing"))
    return typed.select(
        "transaction_id", calendar.period_key(None, F.col("capture_date_utc")).alias("period")
    )


# Dates -----------------------------------------------------------------------------------------


@query("fn_year_month_parts")
def fn_year_month_parts(lake):
    at = casting.instant(F.col("transaction_timestamp"))
    return lake.raw("transactions").select(
        "id", calendar.year_text(at).alias("year"), calendar.month_text(at).alias("month")
    )


@query("fn_datediff_hour")
def fn_datediff_hour(lake):
    hours = calendar.hour_boundaries(
        F.col("transaction_timestamp_utc"), F.col("capture_date_utc")
    )
    return lake.curated("clearing").select("transaction_id", hours.alias("hours_to_capture"))


@query("fn_datediff_day")
def fn_datediff_day(lake):
    days = calendar.day_boundaries(F.col("capture_date_utc"), F.col("settlement_date_utc"))
    return lake.curated("clearing").select("transaction_id", days.alias("days_to_settle"))


@query("fn_lag_hours")
def fn_lag_hours(lake):
    hours = calendar.lag_hours(F.col("transaction_timestamp"), F.col("clearing_timestamp"))
    return lake.curated("transactions").select("id", hours.alias("lag_hours"))


@query("fn_date_key")
def fn_date_key(lake):
    return lake.curated("transactions").select(
        "id", calendar.date_key(F.col("transaction_timestamp")).alias("date_key")
    )


@query("fn_calendar_parts")
def fn_calendar_parts(lake):
    parts = calendar.calendar_parts(F.col("o_orderdate").cast("date"))
    return lake.table("orders").select(
        "o_orderkey", *(c.alias(n) for n, c in parts.items())
    )


@query("fn_cast_to_date")
def fn_cast_to_date(lake):
    at = F.col("transaction_timestamp")
    return lake.curated("transactions").groupBy("transaction_currency").agg(
        F.min(at).cast("date").alias("first_date"), F.max(at).cast("date").alias("last_date")
    )


# Amounts -----------------------------------------------------------------------------------


@query("fn_round_money")
def fn_round_money(lake):
    amount = F.col("usd_amount")
    return lake.curated("transactions").select(
        "id", *(F.round(amount, d).alias(f"usd_{d}") for d in (1, 2, 6))
    )


@query("fn_map_lookup_fx")
def fn_map_lookup_fx(lake):
    amount = casting.money(F.col("billing_amount"), 4)
    return lake.raw("transactions").select(
        "id", amounts.usd(amount, F.col("transaction_currency")).alias("usd_amount")
    )


@query("fn_fx_default_rate")
def fn_fx_default_rate(lake):
    amount = casting.money(F.col("billing_amount"), 4)
    return lake.raw("transactions").select(
        "id", amounts.usd_with_default(amount, F.col("transaction_currency")).alias("usd_amount")
    )


@query("fn_case_map_merchant")
def fn_case_map_merchant(lake):
    return lake.raw("transactions").select(
        "id", text.merchant_name(F.col("merchant")).alias("merchant_normalized")
    )


@query("fn_redact_literal")
def fn_redact_literal(lake):
    users = lake.raw("users").select(
        F.lit("users").alias("table_name"), "id", F.lit("[REDACTED]").alias("redacted")
    )
    orgs = lake.raw("orgs").select(
        F.lit("orgs").alias("table_name"), "id", F.lit("").alias("redacted")
    )
    return users.unionByName(orgs)
