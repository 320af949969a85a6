"""Expected marts, panels, data-quality results and run counts."""

from oracle.base import CURRENCY_LIST, big, dbl, dt, each, expect, mean, pct, ratio, total, ts

expect(
    "top_merchants",
    f"""SELECT merchant_normalized AS merchant_name, merchant_country, mcc, count(*) AS transaction_count,
      count(DISTINCT card_id) AS unique_cards, {total('billing_amount', 'total_spend_aed')},
      {total('usd_amount', 'total_spend_usd')}, {mean('billing_amount')} AS avg_transaction_aed
    FROM cur_transactions WHERE status = 'SETTLED' AND merchant_normalized IS NOT NULL
    GROUP BY merchant_normalized, merchant_country, mcc
    ORDER BY sum(billing_amount) DESC NULLS LAST, 1, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 10""",
)
expect(
    "monthly_volume",
    f"""SELECT year, month, year || '-' || month AS year_month, count(*) AS transaction_count,
      count(DISTINCT card_id) AS active_cards, {total('billing_amount', 'total_spend_aed')},
      {total('usd_amount', 'total_spend_usd')}, {mean('billing_amount')} AS avg_transaction_aed,
      count(*) FILTER (status = 'SETTLED') AS settled_count,
      count(*) FILTER (status = 'DECLINED') AS declined_count,
      count(*) FILTER (status = 'REFUNDED') AS refunded_count,
      {pct("count(*) FILTER (status = 'DECLINED')", 'count(*)')} AS decline_rate_pct
    FROM cur_transactions WHERE year IS NOT NULL GROUP BY year, month""",
)
expect(
    "currency_breakdown",
    f"""with base AS (SELECT year, month, transaction_currency, count(*) AS n,
        round(sum(billing_amount), 2) AS aed, round(sum(usd_amount), 2) AS usd,
        {mean('billing_amount')} AS avg_billing_aed FROM cur_transactions
      WHERE status = 'SETTLED' AND transaction_currency IS NOT NULL AND year IS NOT NULL GROUP BY 1, 2, 3),
    whole AS (SELECT year, month, sum(aed) AS month_aed FROM base GROUP BY 1, 2),
    hist AS (SELECT *, lag(aed) OVER (PARTITION BY transaction_currency ORDER BY year, month) AS prev FROM base)
    SELECT h.year, h.month, h.year || '-' || h.month AS year_month, h.transaction_currency,
      if(h.transaction_currency = 'AED', 'Domestic', 'Foreign') AS exposure_type, h.n AS txn_count,
      {dbl('h.aed', 'total_billing_aed')}, {dbl('h.usd', 'total_usd_equivalent')}, h.avg_billing_aed,
      {pct('h.aed', 'w.month_aed')} AS pct_of_monthly_spend, {dbl('h.prev', 'prev_month_aed')},
      {pct('h.aed - h.prev', 'h.prev')} AS mom_change_pct
    FROM hist h JOIN whole w ON w.year = h.year AND w.month = h.month""",
)


def _org(where: str, base: str) -> str:
    return f"""with s AS (SELECT o.org_id, o.business_name, o.country,
        count(DISTINCT f.transaction_id) AS total_transactions,
        count(DISTINCT f.card_key) AS unique_cards_used, sum(f.billing_amount) AS spend,
        sum(f.usd_amount) AS usd, count(f.billing_amount) AS k,
        sum(f.billing_amount) FILTER (f.status = 'SETTLED') AS settled,
        sum(f.billing_amount) FILTER (f.status = 'REFUNDED') AS refunded,
        count(*) FILTER (f.status = 'DECLINED') AS declined_count
      FROM fact_transactions f JOIN dim_organizations o ON o.org_key = f.org_key {where}
      GROUP BY o.org_id, o.business_name, o.country)
    SELECT business_name, country, total_transactions, unique_cards_used,
      {dbl('round(spend, 2)', 'total_spend_aed')}, {dbl('round(usd, 2)', 'total_spend_usd')},
      {ratio('spend', 'k')} AS avg_transaction_aed, {dbl('round(ifnull(settled, 0), 2)', 'settled_aed')},
      {dbl('round(ifnull(refunded, 0), 2)', 'refunded_aed')}, declined_count,
      {pct('declined_count', base)} AS decline_rate_pct FROM s"""


expect(
    "spend_by_org",
    _org("WHERE f.status IN ('SETTLED', 'REFUNDED')", "total_transactions + declined_count"),
)
expect("spend_by_org_all_status", _org("", "total_transactions"))
expect(
    "fx_exposure",
    f"""with s AS (SELECT transaction_currency, count(*) AS n, sum(transaction_amount) AS original,
        sum(billing_amount) AS aed, sum(usd_amount) AS usd, {mean('transaction_amount')} AS m,
        min(transaction_timestamp) AS a, max(transaction_timestamp) AS z FROM fact_transactions
      WHERE status = 'SETTLED' AND transaction_currency IS NOT NULL GROUP BY 1)
    SELECT transaction_currency, n AS transaction_count, {dbl('round(original, 2)', 'total_original')},
      {dbl('round(aed, 2)', 'total_billing_aed')}, {dbl('round(usd, 2)', 'total_usd_equivalent')},
      m AS avg_transaction, {pct('aed', '(SELECT sum(aed) FROM s)')} AS pct_of_total_spend,
      {dt('a', 'first_transaction_date')}, {dt('z', 'last_transaction_date')},
      if(transaction_currency = 'AED', 'Domestic', 'Foreign') AS exposure_type FROM s""",
)
expect(
    "settlement_lag",
    f"""with lag AS (SELECT merchant_country, transaction_currency,
        date_diff('hour', transaction_timestamp_utc, capture_date_utc) AS h,
        date_diff('day', capture_date_utc, settlement_date_utc) AS d FROM fact_clearing
      WHERE settlement_date_utc IS NOT NULL AND capture_date_utc IS NOT NULL
        AND transaction_timestamp_utc IS NOT NULL)
    SELECT merchant_country, transaction_currency, count(*) AS transaction_count,
      {ratio('sum(h)', 'count(*)', 1)} AS avg_hours_to_capture, {ratio('sum(d)', 'count(*)', 1)} AS avg_days_to_settle,
      round(quantile_cont(d::DOUBLE, 0.5), 1) AS median_days, round(quantile_cont(d::DOUBLE, 0.95), 1) AS p95_days,
      max(d) AS max_days_to_settle, {big('trunc(sum(h)::DOUBLE / count(*))', 'whole_hours_to_capture')},
      {big('trunc(sum(d)::DOUBLE / count(*))', 'whole_days_to_settle')}
    FROM lag GROUP BY 1, 2""",
)
expect(
    "card_utilization",
    f"""with act AS (SELECT c.card_key, c.org_id, c.card_type, c.status, count(f.transaction_key) AS n,
        ifnull(sum(f.billing_amount), 0) AS spend FROM dim_cards c
      LEFT JOIN fact_transactions f ON f.card_key = c.card_key AND f.status = 'SETTLED' GROUP BY 1, 2, 3, 4),
    s AS (SELECT o.business_name, o.country, a.card_type, count(*) AS total_cards,
        count(*) FILTER (a.status = 'ACTIVE') AS active_cards,
        count(*) FILTER (a.status = 'TERMINATED') AS terminated_cards,
        count(*) FILTER (a.n > 0) AS cards_with_transactions,
        count(*) FILTER (a.n = 0 AND a.status = 'ACTIVE') AS dormant_active_cards,
        count(*) FILTER (a.n > 0 AND a.status = 'ACTIVE') AS live_used, sum(a.spend) AS spend
      FROM act a JOIN dim_organizations o ON o.org_id = a.org_id GROUP BY 1, 2, 3)
    SELECT * EXCLUDE (live_used, spend), {pct('active_cards', 'total_cards', 1)} AS active_rate_pct,
      {pct('cards_with_transactions', 'active_cards', 1)} AS utilization_rate_pct,
      {pct('live_used', 'active_cards', 1)} AS active_utilization_rate_pct,
      {pct('dormant_active_cards', 'active_cards', 1)} AS dormancy_rate_pct,
      {dbl('round(spend, 2)', 'total_spend_aed')}, {ratio('spend', 'total_cards')} AS avg_spend_per_card_aed
    FROM s""",
)

expect(
    "panel_kpis",
    f"""SELECT {dbl("round(ifnull(sum(billing_amount) FILTER (status = 'SETTLED'), 0), 2)", 'total_spend_aed')},
      count(*) AS total_transactions, count(*) FILTER (status = 'SETTLED') AS settled_count,
      round(100.0::DOUBLE * count(*) FILTER (status = 'SETTLED') / greatest(count(*), 1), 1) AS settled_pct,
      count(*) FILTER (status = 'DECLINED') AS declined_count,
      round(100.0::DOUBLE * count(*) FILTER (status = 'DECLINED') / greatest(count(*), 1), 1) AS declined_pct
    FROM cur_transactions""",
)
expect(
    "panel_org_top15",
    f"""SELECT ifnull(o.business_name, 'Unknown Org') AS business_name, {total('t.billing_amount', 'total_aed')}
    FROM cur_transactions t LEFT JOIN cur_cards c ON c.id = t.card_id
    LEFT JOIN cur_orgs o ON o.id = c.organization_id WHERE t.status = 'SETTLED'
    GROUP BY 1 ORDER BY sum(t.billing_amount) DESC NULLS LAST, 1 LIMIT 15""",
)
expect(
    "panel_volume",
    f"""SELECT year, month, year || '-' || month AS period, count(id) AS txn_count,
      {total('billing_amount', 'total_aed')} FROM cur_transactions
    WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY 1, 2""",
)
expect(
    "panel_fx",
    f"""SELECT transaction_currency AS currency, {total('billing_amount', 'total_aed')},
      if(transaction_currency = 'AED', 'Domestic (AED)', 'Foreign Currency') AS exposure_type
    FROM cur_transactions WHERE status = 'SETTLED' AND transaction_currency IS NOT NULL GROUP BY 1""",
)
expect(
    "panel_merchants",
    f"""SELECT merchant_normalized AS merchant, {total('billing_amount', 'total_aed')}
    FROM cur_transactions WHERE status = 'SETTLED' AND merchant_normalized IS NOT NULL
    GROUP BY 1 ORDER BY sum(billing_amount) DESC NULLS LAST, 1 LIMIT 10""",
)
expect(
    "panel_cards",
    """SELECT *, CASE WHEN active_rate_pct < 50 THEN 'low' WHEN active_rate_pct < 80 THEN 'medium' ELSE 'high' END AS rate_band,
      round(active_rate_pct - 80, 1) AS delta_to_target FROM (
      SELECT count(*) AS total_cards, count(*) FILTER (status = 'ACTIVE') AS active_cards,
        count(*) FILTER (status = 'TERMINATED') AS terminated_cards,
        count(*) FILTER (card_type = 'VIRTUAL') AS virtual_cards,
        count(*) FILTER (card_type = 'PHYSICAL') AS physical_cards,
        round(100.0::DOUBLE * count(*) FILTER (status = 'ACTIVE') / greatest(count(*), 1), 1) AS active_rate_pct
      FROM cur_cards)""",
)
expect(
    "panel_lag",
    """with lag AS (SELECT * FROM (
        SELECT date_diff('microsecond', transaction_timestamp, clearing_timestamp) AS us
        FROM cur_transactions WHERE status = 'SETTLED') WHERE us BETWEEN 0 AND 240 * 3600000000),
    bins AS (SELECT unnest(range(40)) AS bin),
    facts AS (SELECT round(quantile_cont(us / 3600000000.0::DOUBLE, 0.5), 1) AS median_lag_hours,
      round(quantile_cont(us / 3600000000.0::DOUBLE, 0.95), 1) AS p95_lag_hours,
      round(max(us) / 3600000000.0::DOUBLE, 1) AS max_lag_hours FROM lag)
    SELECT bin, count(us) AS transactions, any_value(median_lag_hours) AS median_lag_hours,
      any_value(p95_lag_hours) AS p95_lag_hours, any_value(max_lag_hours) AS max_lag_hours
    FROM bins CROSS JOIN facts LEFT JOIN lag ON least(us // 21600000000, 39) = bin GROUP BY 1""",
)


def _rule(name: str, table: str, violations: str, undecided: str, checked: str, source: str) -> str:
    return f"""SELECT '{name}' AS rule, '{table}' AS table_name, CAST({violations} AS BIGINT) AS violations,
      CAST({undecided} AS BIGINT) AS undecided, CAST({checked} AS BIGINT) AS checked,
      {violations} = 0 AS passed FROM {source}"""


def _rules(txn: str, clr: str) -> dict[str, str]:
    unique = "(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {0} FROM {1})))"
    return {
        "dq_complete": _rule(
            "transactions_no_null_card_id", "transactions",
            "count(*) FILTER (card_id IS NULL)", "0", "count(*)", txn,
        ),
        "dq_positive_where": _rule(
            "transactions_positive_settled_amount", "transactions",
            "count(*) FILTER (status = 'SETTLED' AND billing_amount <= 0)",
            "count(*) FILTER (status = 'SETTLED' AND billing_amount IS NULL)",
            "count(*) FILTER (status = 'SETTLED')", txn,
        ),
        "dq_in_set_currency": _rule(
            "transactions_valid_currency", "transactions",
            f"count(*) FILTER (transaction_currency NOT IN {CURRENCY_LIST})",
            "count(*) FILTER (transaction_currency IS NULL)", "count(*)", txn,
        ),
        "dq_unique_txn": _rule(
            "transactions_no_duplicate_ids", "transactions", unique.format("id", txn), "0",
            "count(*)", txn,
        ),
        "dq_ref_card": _rule(
            "transactions_card_id_referential_integrity", "transactions",
            "count(*) FILTER (card_id IS NOT NULL AND card_id NOT IN (SELECT id FROM cur_cards))",
            "count(*) FILTER (card_id IS NULL)", "count(*)", txn,
        ),
        "dq_ref_holder": _rule(
            "cards_holder_referential_integrity", "cards",
            "count(*) FILTER (card_holder_id IS NOT NULL AND card_holder_id NOT IN (SELECT id FROM cur_users))",
            "count(*) FILTER (card_holder_id IS NULL)", "count(*)", "cur_cards",
        ),
        "dq_order_settlement": _rule(
            "clearing_settlement_after_transaction", "clearing",
            "count(*) FILTER (settlement_date_utc < transaction_timestamp_utc)",
            "count(*) FILTER (settlement_date_utc IS NULL OR transaction_timestamp_utc IS NULL)",
            "count(*)", clr,
        ),
        "dq_unique_clearing": _rule(
            "clearing_no_duplicate_transaction_ids", "clearing",
            unique.format("transaction_id", clr), "0", "count(*)", clr,
        ),
        "dq_in_set_dr_cr": _rule(
            "transactions_valid_dr_cr", "transactions",
            "count(*) FILTER (dr_cr NOT IN ('DEBIT', 'CREDIT'))",
            "count(*) FILTER (dr_cr IS NULL)", "count(*)", txn,
        ),
        "dq_in_set_card_status": _rule(
            "cards_valid_status", "cards",
            "count(*) FILTER (status NOT IN ('ACTIVE', 'TERMINATED'))",
            "count(*) FILTER (status IS NULL)", "count(*)", "cur_cards",
        ),
    }


for _key, _text in _rules("typed_transactions", "typed_clearing").items():
    expect(_key, _text)

_DROPPED = _rule(
    "dropped_by_currency_filter", "transactions",
    f"count(*) FILTER (transaction_currency IS NULL OR transaction_currency NOT IN {CURRENCY_LIST})",
    "0", "count(*)", "raw_transactions",
)
expect(
    "dq_scorecard",
    " UNION ALL ".join([*_rules("cur_transactions", "cur_clearing").values(), _DROPPED]),
)
_TYPED = " UNION ALL ".join(_rules("typed_transactions", "typed_clearing").values())
expect(
    "dq_scorecard_over_time",
    f"""SELECT *, CASE table_name
        WHEN 'transactions' THEN (SELECT count(*) > 0 FROM typed_transactions WHERE year(transaction_timestamp) = 2000)
        WHEN 'clearing' THEN (SELECT count(*) > 0 FROM typed_clearing WHERE year(transaction_timestamp_utc) = 2000)
        ELSE false END::BIGINT AS read_later, 0::BIGINT AS read_again
      FROM ({_TYPED})""",
)
expect(
    "dq_gate",
    f"""with v AS (SELECT count(*) FILTER (card_id IS NULL) AS a,
      count(*) FILTER (transaction_currency NOT IN {CURRENCY_LIST}) AS b,
      count(*) FILTER (status = 'SETTLED' AND billing_amount <= 0) AS c FROM cur_transactions)
    SELECT 'null_card_ids' AS check_name, a AS violations, a = 0 AS passed FROM v
    UNION ALL SELECT 'invalid_currencies', b, b = 0 FROM v
    UNION ALL SELECT 'negative_settled_amounts', c, c = 0 FROM v""",
)
expect(
    "governed_users_view",
    f"""SELECT id, first_name, last_name, is_active, is_verified, track_id,
      {each(ts, 'created_at updated_at')}, deleted_at FROM cur_users""",
)
_COUNTS = {
    "curate_orgs": "cur_orgs", "curate_users": "cur_users", "curate_cards": "cur_cards",
    "curate_transactions": "cur_transactions", "curate_clearing": "cur_clearing",
    "load_dim_organizations": "cur_orgs", "load_dim_users": "cur_users",
    "load_dim_cards": "cur_cards", "load_dim_merchants": "dim_merchants",
    "load_dim_dates": "dim_dates", "load_fact_transactions": "cur_transactions",
    "load_fact_clearing": "cur_clearing",
}
expect(
    "pipeline_run",
    " UNION ALL ".join(
        f"SELECT '{s}' AS step, count(*) AS \"rows\" FROM {t}" for s, t in _COUNTS.items()
    ),
)
