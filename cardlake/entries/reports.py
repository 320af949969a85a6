"""Marts, dashboard panels, data quality, governance and the whole run."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlake.entries.lake import CALENDAR, query
from cardlake.fixed_values import SOURCES
from cardlake.operators import quality, quality_states
from cardlake.plans import curation, governance, marts, panels, pipeline
from cardlake.sources.datasets import write_dataset
from cardlake.sources.raw import write_raw


# Marts ---------------------------------------------------------------------------------------


@query("top_merchants")
def top_merchants(lake):
    return marts.top_merchants(lake.curated("transactions"))


@query("monthly_volume")
def monthly_volume(lake):
    return marts.monthly_volume(lake.curated("transactions"))


@query("currency_breakdown")
def currency_breakdown(lake):
    return marts.currency_breakdown(lake.curated("transactions"))


@query("spend_by_org")
def spend_by_org(lake):
    return marts.spend_by_org(lake.star("fact_transactions"), lake.star("dim_organizations"))


@query("spend_by_org_all_status")
def spend_by_org_all_status(lake):
    return marts.spend_by_org_all_status(
        lake.star("fact_transactions"), lake.star("dim_organizations")
    )


@query("fx_exposure")
def fx_exposure(lake):
    return marts.fx_exposure(lake.star("fact_transactions"))


@query("settlement_lag")
def settlement_lag(lake):
    return marts.settlement_lag(lake.star("fact_clearing"))


@query("card_utilization")
def card_utilization(lake):
    return marts.card_utilization(
        lake.star("dim_cards"), lake.star("fact_transactions"), lake.star("dim_organizations")
    )


# Panels --------------------------------------------------------------------------------------


@query("panel_kpis")
def panel_kpis(lake):
    return panels.kpis(lake.curated("transactions"))


@query("panel_org_top15")
def panel_org_top15(lake):
    return panels.org_top(
        lake.curated("transactions"), lake.curated("cards"), lake.curated("orgs")
    )


@query("panel_volume")
def panel_volume(lake):
    return panels.volume(lake.curated("transactions"))


@query("panel_fx")
def panel_fx(lake):
    return panels.fx(lake.curated("transactions"))


@query("panel_merchants")
def panel_merchants(lake):
    return panels.merchants(lake.curated("transactions"))


@query("panel_cards")
def panel_cards(lake):
    return panels.cards_panel(lake.curated("cards"))


@query("panel_lag")
def panel_lag(lake):
    """Histogram rows with the summary beside each."""
    lagged = panels.lags(lake.curated("transactions"))
    summary = panels.lag_summary(lagged)
    names = summary.columns
    one = summary.select(F.struct(*names).alias("s")).scalar()
    return panels.lag_histogram(lagged).withColumn("s", one).select(
        "bin", "transactions", *(F.col(f"s.{n}").alias(n) for n in names)
    )


# Data quality -----------------------------------------------------------------------------------


def staged(lake):
    """Typed rows before any is dropped: here the injected violations are still present."""
    return {
        "transactions": curation.type_transactions(lake.raw("transactions")),
        "clearing": curation.type_clearing(lake.raw("clearing")),
        "cards": lake.curated("cards"),
        "users": lake.curated("users"),
    }


RULE_KEYS = {
    "dq_complete": "transactions_no_null_card_id",
    "dq_positive_where": "transactions_positive_settled_amount",
    "dq_in_set_currency": "transactions_valid_currency",
    "dq_unique_txn": "transactions_no_duplicate_ids",
    "dq_ref_card": "transactions_card_id_referential_integrity",
    "dq_ref_holder": "cards_holder_referential_integrity",
    "dq_order_settlement": "clearing_settlement_after_transaction",
    "dq_unique_clearing": "clearing_no_duplicate_transaction_ids",
    "dq_in_set_dr_cr": "transactions_valid_dr_cr",
    "dq_in_set_card_status": "cards_valid_status",
}


def _rule_query(name):
    rules = [r for r in quality.RULES if r.name == name]
    return lambda lake: quality.scorecard(rules, staged(lake))


for _key, _name in RULE_KEYS.items():
    query(_key)(_rule_query(_name))


@query("dq_scorecard")
def dq_scorecard(lake):
    """All rules on the curated tables, and the rows the currency filter dropped before."""
    tables = {s: lake.curated(s) for s in ("transactions", "clearing", "cards", "users")}
    card = quality.scorecard(quality.RULES, tables)
    accepted = F.coalesce(F.col("transaction_currency").isin(*curation.fixed_values.CURRENCIES), F.lit(False))
    dropped = lake.raw("transactions").agg(
        F.lit("dropped_by_currency_filter").alias("rule"),
        F.lit("transactions").alias("table_name"),
        F.count_if(~accepted).alias("violations"),
        F.lit(0).cast("bigint").alias("undecided"),
        F.count("*").alias("checked"),
        (F.count_if(~accepted) == 0).alias("passed"),
    )
    return card.unionByName(dropped)


@query("dq_scorecard_over_time")
def dq_scorecard_over_time(lake):
    """The scorecard from states: after a first run the year 2000 arrives, and only its folder (and none
    in a third run) is read."""
    tables, root = staged(lake), lake.path("quality")
    booked = {
        "transactions": F.coalesce(F.year("transaction_timestamp").cast("string"), F.lit("none")),
        "clearing": F.coalesce(F.year("transaction_timestamp_utc").cast("string"), F.lit("none")),
        "cards": F.lit("all"),
    }

    def folders_read(name):
        path, rows = f"{root}/{name}", tables[name].withColumn("booked", booked[name])
        read = []
        for arrived in (rows.filter("booked != '2000'"), rows.filter("booked = '2000'"), None):
            if arrived is not None:
                write_dataset(arrived, path, ["booked"], replace="touched", varying=curation.VARYING.get(name, ()))
            read.append(quality_states.refresh(lake.spark, quality.RULES, name, path, rows.schema, f"{root}/states"))
        return name, read

    # one table after the other: what a large one shuffles is dropped before the next
    read = dict(map(folders_read, booked))
    card = quality_states.merged(lake.spark, quality.RULES, tables, f"{root}/states")
    counts = F.create_map(*(x for n, c in read.items() for x in (F.lit(n), F.array(*map(F.lit, c)))))
    folders = F.element_at(counts, F.col("table_name"))
    return card.withColumn("read_later", folders[1]).withColumn("read_again", folders[2])


@query("dq_gate")
def dq_gate(lake):
    return quality.gate_verdicts({"transactions": lake.curated("transactions")})


@query("governed_users_view")
def governed_users_view(lake):
    return governance.governed_view(lake.curated("users"), "readable_users")


@query("pipeline_run")
def pipeline_run(lake):
    """The whole run on the raw CSV files; the sample data fails the strict gate on purpose, so
    only the currency check gates here."""
    root = lake.path("raw")
    for source in SOURCES:
        write_raw(lake.raw(source), f"{root}/{source}")
    checks = {"invalid_currencies": quality.GATE["invalid_currencies"]}
    return pipeline.run(lake.spark, root, lake.path("run"), CALENDAR, checks)
