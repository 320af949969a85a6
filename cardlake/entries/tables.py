"""Curated tables, pseudonymised tables and the star schema."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardlake.entries.lake import CALENDAR, query
from cardlake.operators.replacement import combine_dictionaries, constant_dictionary
from cardlake.plans import pseudonym, warehouse
from cardlake.plans.curation import CURATE, write_curated

# Brand spellings of the operator itself, replaced before all others.
BRAND = [("trading office", "brand office"), ("Starbucks", "Brand"), ("b tech", "brand")]


def _curated(source):
    def build(lake):
        return write_curated(source, lake.raw(source), lake.path(source))[0]

    return build


for _source in CURATE:
    query(f"curated_{_source}")(_curated(_source))


# Pseudonymisation ---------------------------------------------------------------------------------


def _brand(lake):
    return constant_dictionary(lake.spark, BRAND)


def _orgs(lake):
    return pseudonym.org_dictionary(lake.raw("orgs"))


def _users(lake):
    return pseudonym.user_dictionary(lake.raw("users"))


@query("anon_org_dictionary")
def anon_org_dictionary(lake):
    return _orgs(lake).select("old", "new")


@query("anon_user_dictionary")
def anon_user_dictionary(lake):
    return _users(lake).select("old", "new")


@query("anon_orgs")
def anon_orgs(lake):
    return pseudonym.anonymise_orgs(lake.raw("orgs"))


@query("anon_users")
def anon_users(lake):
    return pseudonym.anonymise_users(lake.raw("users"))


@query("anon_cards")
def anon_cards(lake):
    dictionary = combine_dictionaries(_brand(lake), _orgs(lake), _users(lake))
    return pseudonym.anonymise_cards(lake.raw("cards"), dictionary).select(
        "id", "name_on_card", "card_nickname"
    )


@query("anon_transactions")
def anon_transactions(lake):
    dictionary = combine_dictionaries(_brand(lake), _orgs(lake))
    return pseudonym.anonymise_transactions(lake.raw("transactions"), dictionary).select(
        "id", "merchant", "billing_amount"
    )


@query("anon_clearing")
def anon_clearing(lake):
    dictionary = combine_dictionaries(_brand(lake), _orgs(lake))
    replaced = pseudonym.anonymise_clearing(lake.raw("clearing"), dictionary)
    return replaced.select(
        F.col("Transaction ID").alias("transaction_id"),
        F.col("Tenant Name").alias("tenant_name"),
        F.col("Merchant Name").alias("merchant_name"),
        F.col("Card Holder").alias("card_holder"),
    )


# Star schema -------------------------------------------------------------------------------------


@query("dim_organizations")
def dim_organizations(lake):
    return warehouse.dim_organizations(lake.curated("orgs"))


@query("dim_users")
def dim_users(lake):
    return warehouse.dim_users(lake.curated("users"), lake.curated("cards"))


@query("dim_cards")
def dim_cards(lake):
    return warehouse.dim_cards(lake.curated("cards"))


@query("dim_merchants")
def dim_merchants(lake):
    """Two loads: merchants of the years before 1998, then all, keeping the first keys."""
    rows = lake.curated("transactions")
    first = warehouse.dim_merchants(rows.filter("year < '1998'"))
    return warehouse.dim_merchants(rows, first)


@query("dim_dates")
def dim_dates(lake):
    """Calendar with the number of curated transactions of each day."""
    days = warehouse.dim_dates(lake.spark)
    parts = warehouse.dim_dates(lake.spark, *CALENDAR)
    busy = (
        lake.star("fact_transactions")
        .filter(F.col("date_key").isNotNull())
        .groupBy("date_key")
        .agg(F.count("*").alias("transactions"))
    )
    calendar = days.unionByName(parts)
    return calendar.join(busy, "date_key", "left").withColumn(
        "transactions", F.coalesce("transactions", F.lit(0))
    )


@query("fact_transactions")
def fact_transactions(lake):
    dims = [lake.star(d) for d in ("dim_cards", "dim_organizations", "dim_merchants")]
    return warehouse.fact_transactions(lake.curated("transactions"), *dims)


@query("fact_clearing")
def fact_clearing(lake):
    return warehouse.fact_clearing(lake.curated("clearing"), lake.star("fact_transactions"))


@query("fact_layout")
def fact_layout(lake):
    sort = ["date_key", "status"]
    fact = lake.star("fact_transactions").select("transaction_key", "card_key", *sort)
    table = f"laid_out_fact_{uuid.uuid4().hex[:12]}"
    stored = warehouse.lay_out_fact(fact, table, lake.path("laid_out_fact"), sort)
    cards = lake.star("dim_cards").select("card_key", "card_type")
    return stored.join(cards, "card_key", "left")


@query("fact_layout_skipping")
def fact_layout_skipping(lake):
    """Rows of one month in a clustered fact; whether a reader leaves three files in four alone."""
    fact = lake.star("fact_transactions").select("transaction_key", "card_key", "date_key", "status")
    sizes = max(1, fact.count() // 64)
    stored = warehouse.cluster_fact(fact, lake.path("clustered_fact"), ["date_key", "status"], sizes)
    first, last = 19970301, 19970331
    rows = stored.filter(F.col("date_key").between(first, last)).agg(F.count("*").alias("rows_in_month"))
    files = warehouse.files_met(stored, "date_key", first, last)
    return rows.crossJoin(F.broadcast(files)).select(
        "rows_in_month", (F.col("files_met") * 4 <= F.col("files")).alias("most_files_skipped")
    )


@query("warehouse_constraints")
def warehouse_constraints(lake):
    names = {t for t, *_ in warehouse.CONSTRAINTS}
    return warehouse.check_constraints({n: lake.star(n) for n in sorted(names)})
