"""Joins, aggregations, windows, keys, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cardlake.entries.lake import query
from cardlake.functions import amounts, calendar
from cardlake.operators import dedup, keys, quantiles
from cardlake.operators.joins import blank_safe_lookup, orphans
from cardlake.plans import marts, panels, warehouse


# Joins ---------------------------------------------------------------------------------------


@query("join_inner_equi")
def join_inner_equi(lake):
    fact = lake.star("fact_transactions").select("transaction_id", "org_key", "billing_amount")
    orgs = lake.star("dim_organizations").select("org_key", "org_id", "country")
    return fact.join(orgs, "org_key").select(
        "transaction_id", "org_id", "country", "billing_amount"
    )


@query("join_left_on_predicate")
def join_left_on_predicate(lake):
    cards = lake.star("dim_cards").select("card_key", "card_id", "status")
    settled = lake.star("fact_transactions").filter("status = 'SETTLED'")
    return cards.join(
        settled.select("card_key", "transaction_id", "billing_amount"), "card_key", "left"
    ).select("card_id", "status", "transaction_id", "billing_amount")


@query("join_cross_scalar")
def join_cross_scalar(lake):
    per_currency = (
        lake.star("fact_transactions")
        .groupBy("transaction_currency")
        .agg(F.sum("billing_amount").alias("spend"))
    )
    grand = per_currency.agg(F.sum("spend").alias("grand_total")).scalar()
    return per_currency.select("transaction_currency", "spend", grand.alias("grand_total"))


@query("join_multi_key")
def join_multi_key(lake):
    monthly = (
        lake.curated("transactions")
        .groupBy("year", "month", "transaction_currency")
        .agg(amounts.rounded_sum(F.col("billing_amount")).alias("spend"))
    )
    months = monthly.groupBy("year", "month").agg(F.sum("spend").alias("month_spend"))
    return monthly.join(months, ["year", "month"])


@query("join_left_chain_unknown")
def join_left_chain_unknown(lake):
    joined = panels.org_of_settled(
        lake.curated("transactions"), lake.curated("cards"), lake.curated("orgs")
    )
    return joined.select("card_id", "business_name", "spend")


@query("join_null_safe_lookup")
def join_null_safe_lookup(lake):
    rows = lake.curated("transactions").select(
        "id",
        "merchant_normalized",
        F.when(F.col("merchant_city") != "Cairo", F.col("merchant_city")).alias("city"),
    )
    known = rows.select("merchant_normalized", "city").distinct()
    lookup = known.select(
        F.col("merchant_normalized").alias("name"),
        F.col("city").alias("known_city"),
        F.concat_ws("/", "merchant_normalized", F.coalesce("city", F.lit("?"))).alias("place"),
    )
    pairs = [("merchant_normalized", "name"), ("city", "known_city")]
    return blank_safe_lookup(rows, lookup, pairs, ["place"])


@query("join_left_anti")
def join_left_anti(lake):
    return orphans(lake.raw("transactions"), lake.curated("cards"), "card_id", "id")


@query("join_surrogate_keys")
def join_surrogate_keys(lake):
    dims = [lake.star(d) for d in ("dim_cards", "dim_organizations", "dim_merchants")]
    return warehouse.resolve_keys(lake.curated("transactions"), *dims).select(
        F.col("id").alias("transaction_id"), "card_key", "org_key", "merchant_key", "date_key"
    )


# Aggregations ----------------------------------------------------------------------------------


@query("agg_basic")
def agg_basic(lake):
    amount = F.col("billing_amount")
    return lake.star("fact_transactions").groupBy("transaction_currency").agg(
        F.count("*").alias("n"),
        F.sum(amount).alias("total"),
        amounts.rounded_mean(amount).alias("mean"),
        F.min(amount).alias("smallest"),
        F.max(amount).alias("largest"),
    )


@query("agg_count_distinct")
def agg_count_distinct(lake):
    return lake.curated("transactions").groupBy("year", "month").agg(
        F.count_distinct("card_id").alias("cards"),
        F.count_distinct("merchant_normalized").alias("merchants"),
    )


@query("agg_conditional")
def agg_conditional(lake):
    settled = F.col("status") == "SETTLED"
    return lake.curated("transactions").groupBy("merchant_country").agg(
        amounts.count_where(settled).alias("settled"),
        amounts.count_where(F.col("status") == "DECLINED").alias("declined"),
        amounts.sum_where(settled, F.col("billing_amount")).alias("settled_aed"),
    )


@query("agg_percentile_cont")
def agg_percentile_cont(lake):
    days = calendar.day_boundaries(F.col("capture_date_utc"), F.col("settlement_date_utc"))
    lagged = lake.curated("clearing").select(
        "merchant_country", "transaction_currency", days.alias("days")
    )
    groups = ["merchant_country", "transaction_currency"]
    marks = {"median_days": 0.5, "p95_days": 0.95, "max_days": 1.0}
    found = quantiles.exact_quantiles(lagged, groups, "days", marks, slice_width=1)
    return found.select(*groups, *(F.round(m, 4).alias(m) for m in marks))


@query("agg_two_level")
def agg_two_level(lake):
    activity = marts.card_activity(lake.star("dim_cards"), lake.star("fact_transactions"))
    return activity.groupBy("org_id", "card_type").agg(
        F.count("*").alias("cards"),
        F.sum("transaction_count").alias("transactions"),
        F.sum("total_spend_aed").alias("spend"),
        F.max("last_used_at").alias("last_used_at"),
    )


@query("agg_global")
def agg_global(lake):
    return lake.star("fact_transactions").agg(
        F.count("*").alias("n"),
        F.sum("billing_amount").alias("total_aed"),
        F.max("transaction_timestamp").alias("last_seen"),
    )


@query("dedup_by_key")
def dedup_by_key(lake):
    rows = lake.raw("transactions").select("id", "card_id", "merchant", "billing_amount")
    return dedup.one_per_key(rows, ["id"])


@query("dedup_counted_first")
def dedup_counted_first(lake):
    rows = lake.raw("transactions").select("id", "card_id", "merchant", "billing_amount")
    return dedup.one_per_key_counted(rows, ["id"])


@query("agg_duplicates")
def agg_duplicates(lake):
    rows = lake.raw("transactions")
    by_id = dedup.duplicate_count(rows, "id").select(F.lit("id").alias("key"), "duplicates")
    by_card = dedup.duplicate_count(rows, "card_id")
    return by_id.unionByName(by_card.select(F.lit("card_id").alias("key"), "duplicates"))


@query("select_distinct")
def select_distinct(lake):
    return warehouse.merchant_tuples(lake.curated("transactions"))


@query("agg_histogram")
def agg_histogram(lake):
    return panels.lag_histogram(panels.lags(lake.curated("transactions")))


@query("agg_share_of_total")
def agg_share_of_total(lake):
    spend = (
        lake.curated("transactions")
        .groupBy("transaction_currency")
        .agg(F.sum("billing_amount").alias("spend"))
    )
    whole = F.sum("spend").over(Window.partitionBy())
    return spend.select(
        "transaction_currency", amounts.percent(F.col("spend"), whole).alias("share_pct")
    )


@query("agg_int_avg_trunc")
def agg_int_avg_trunc(lake):
    days = calendar.day_boundaries(F.col("capture_date_utc"), F.col("settlement_date_utc"))
    return (
        lake.curated("clearing")
        .groupBy("merchant_country")
        .agg(F.sum(days).alias("total"), F.count(days).alias("n"))
        .select(
            "merchant_country",
            amounts.quotient(F.col("total"), F.col("n"), 4).alias("avg_days"),
            (F.col("total") / F.col("n")).cast("bigint").alias("avg_days_truncated"),
        )
    )


@query("agg_drop_null_groups")
def agg_drop_null_groups(lake):
    currency = F.col("transaction_currency")
    return (
        lake.raw("transactions")
        .filter(currency.isNotNull())
        .groupBy(currency)
        .agg(F.count("card_id").alias("with_card"), F.count("*").alias("n"))
    )


# Windows and keys ---------------------------------------------------------------------------------


def _monthly(lake):
    return (
        lake.curated("transactions")
        .filter(F.col("year").isNotNull())
        .groupBy("transaction_currency", "year", "month")
        .agg(amounts.rounded_sum(F.col("billing_amount")).alias("spend"))
    )


@query("window_lag")
def window_lag(lake):
    history = Window.partitionBy("transaction_currency").orderBy("year", "month")
    return _monthly(lake).withColumn("previous", F.lag("spend").over(history))


@query("window_mom_change")
def window_mom_change(lake):
    previous = F.col("previous")
    return window_lag(lake).select(
        "transaction_currency",
        "year",
        "month",
        amounts.percent(F.col("spend") - previous, previous).alias("mom_change_pct"),
    )


@query("surrogate_key")
def surrogate_key(lake):
    ids = lake.curated("transactions").select("id")
    return keys.dense_key(ids, [F.col("id")], "transaction_key")


@query("ordinal_label")
def ordinal_label(lake):
    numbered = keys.ordinal_by_number(lake.raw("users").select("id"), "id", "n")
    return numbered.select("id", F.concat(F.lit("user_"), F.col("n").cast("string")).alias("label"))


# Sorts and set operations --------------------------------------------------------------------------


@query("topk_10")
def topk_10(lake):
    return (
        lake.curated("transactions")
        .groupBy("merchant_normalized", "mcc")
        .agg(amounts.rounded_sum(F.col("billing_amount")).alias("spend"))
        .orderBy(F.col("spend").desc_nulls_last(), "merchant_normalized", "mcc")
        .limit(10)
    )


@query("topk_15")
def topk_15(lake):
    return (
        lake.star("fact_transactions")
        .groupBy("org_key")
        .agg(amounts.rounded_sum(F.col("billing_amount")).alias("spend"))
        .orderBy(F.col("spend").desc_nulls_last(), F.col("org_key").asc_nulls_first())
        .limit(15)
    )


@query("sort_multi_key")
def sort_multi_key(lake):
    return (
        lake.curated("cards")
        .groupBy("organization_id", "card_type")
        .agg(F.count("*").alias("cards"))
        .orderBy(F.col("cards").desc(), F.col("card_type").asc(), "organization_id")
    )


@query("union_all_seed")
def union_all_seed(lake):
    paid = lake.raw("transactions").select(
        F.lit("payment").alias("kind"), "id", F.col("billing_amount").alias("amount")
    )
    cleared = lake.raw("clearing").select(
        F.lit("clearing").alias("kind"),
        F.col("GTV").alias("amount"),
        F.col("Transaction ID").alias("id"),
    )
    return paid.unionByName(cleared)


@query("fn_replace_longest_first")
def fn_replace_longest_first(lake):
    from cardlake.operators.replacement import constant_dictionary, replace_in_columns

    # Each entry can complete the text of a shorter one: 'NATION_1' is part of 'NATION_12'.
    dictionary = constant_dictionary(
        lake.spark,
        [("NATION_1", "HOUSE_2"), ("NATION_12", "NATION_1b"), ("HOUSE_2", "home"), ("me t", "ME-T")],
    )
    rows = lake.raw("transactions").select("id", "merchant", "merchant_city")
    return replace_in_columns(rows, ["merchant"], dictionary).select("id", "merchant")


