"""Expected results of joins, aggregations, windows, keys, sorts and set operations."""

from oracle.base import big, dbl, each, expect, mean, pct, ratio, total, ts

expect(
    "join_inner_equi",
    f"""SELECT transaction_id, org_id, country, {dbl('billing_amount')}
    FROM fact_transactions JOIN dim_organizations USING (org_key)""",
)
expect(
    "join_left_on_predicate",
    f"""SELECT c.card_id, c.status, f.transaction_id, {dbl('f.billing_amount', 'billing_amount')}
    FROM dim_cards c LEFT JOIN fact_transactions f ON f.card_key = c.card_key AND f.status = 'SETTLED'""",
)
expect(
    "join_cross_scalar",
    f"""with s AS (SELECT transaction_currency, sum(billing_amount) AS spend FROM fact_transactions GROUP BY 1)
    SELECT transaction_currency, {dbl('spend')}, {dbl('g', 'grand_total')}
    FROM s CROSS JOIN (SELECT sum(spend) AS g FROM s)""",
)
expect(
    "join_multi_key",
    f"""with m AS (SELECT year, month, transaction_currency, round(sum(billing_amount), 2) AS spend
      FROM cur_transactions GROUP BY ALL)
    SELECT m.year, m.month, transaction_currency, {dbl('spend')}, {dbl('s', 'month_spend')}
    FROM m JOIN (SELECT year, month, sum(spend) AS s FROM m GROUP BY ALL) t
      ON t.year = m.year AND t.month = m.month""",
)
expect(
    "join_left_chain_unknown",
    f"""SELECT t.card_id, ifnull(o.business_name, 'Unknown Org') AS business_name, {dbl('sum(t.billing_amount)', 'spend')}
    FROM cur_transactions t LEFT JOIN cur_cards c ON c.id = t.card_id
    LEFT JOIN cur_orgs o ON o.id = c.organization_id WHERE t.status = 'SETTLED' GROUP BY 1, 2""",
)
expect(
    "join_null_safe_lookup",
    """SELECT id, merchant_normalized, nullif(merchant_city, 'Cairo') AS city,
    merchant_normalized || '/' || ifnull(nullif(merchant_city, 'Cairo'), '?') AS place
    FROM cur_transactions""",
)
expect(
    "join_left_anti",
    """SELECT card_id AS key, count(*) AS "rows" FROM raw_transactions
    WHERE card_id IS NOT NULL AND card_id NOT IN (SELECT id FROM cur_cards) GROUP BY 1""",
)
expect(
    "join_surrogate_keys",
    f"""SELECT transaction_id, {each(big, 'card_key org_key merchant_key date_key')}
    FROM fact_transactions""",
)
expect(
    "agg_basic",
    f"""SELECT transaction_currency, count(*) AS n, {dbl('sum(billing_amount)', 'total')},
    {mean('billing_amount')} AS mean, {dbl('min(billing_amount)', 'smallest')},
    {dbl('max(billing_amount)', 'largest')} FROM fact_transactions GROUP BY 1""",
)
expect(
    "agg_count_distinct",
    """SELECT year, month, count(DISTINCT card_id) AS cards,
    count(DISTINCT merchant_normalized) AS merchants FROM cur_transactions GROUP BY 1, 2""",
)
expect(
    "agg_conditional",
    f"""SELECT merchant_country, count(*) FILTER (status = 'SETTLED') AS settled,
    count(*) FILTER (status = 'DECLINED') AS declined,
    {dbl("ifnull(sum(billing_amount) FILTER (status = 'SETTLED'), 0)", 'settled_aed')}
    FROM cur_transactions GROUP BY 1""",
)
expect(
    "agg_percentile_cont",
    f"""SELECT merchant_country, transaction_currency,
    round(quantile_cont(d, 0.5), 4) AS median_days, round(quantile_cont(d, 0.95), 4) AS p95_days,
    {dbl('max(d)', 'max_days')} FROM (SELECT *, CAST(date_diff('day', capture_date_utc, settlement_date_utc) AS DOUBLE) AS d
    FROM cur_clearing) WHERE d IS NOT NULL GROUP BY 1, 2""",
)
expect(
    "agg_two_level",
    f"""SELECT org_id, card_type, count(*) AS cards, {big('sum(n)', 'transactions')},
    {dbl('sum(spend)', 'spend')}, {ts('max(last_used)', 'last_used_at')} FROM (
      SELECT c.card_key, c.org_id, c.card_type, count(f.transaction_key) AS n,
        coalesce(sum(f.billing_amount), 0) AS spend, max(f.transaction_timestamp) AS last_used
      FROM dim_cards c LEFT JOIN fact_transactions f ON f.card_key = c.card_key AND f.status = 'SETTLED'
      GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
expect(
    "agg_global",
    f"""SELECT count(*) AS n, {dbl('sum(billing_amount)', 'total_aed')},
    {ts('max(transaction_timestamp)', 'last_seen')} FROM fact_transactions""",
)
for _key in ("dedup_by_key", "dedup_counted_first"):
    expect(
        _key,
        """SELECT id, card_id, merchant, billing_amount FROM raw_transactions
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY card_id NULLS FIRST, merchant, billing_amount) = 1""",
    )
expect(
    "agg_duplicates",
    """SELECT 'id' AS key, count(*) - count(DISTINCT id) AS duplicates FROM raw_transactions
    UNION ALL SELECT 'card_id', count(*) - (SELECT count(*) FROM (SELECT DISTINCT card_id FROM raw_transactions))
    FROM raw_transactions""",
)
expect(
    "select_distinct",
    """SELECT merchant_normalized AS merchant_name, merchant_city, merchant_country, mcc
    FROM cur_transactions WHERE merchant_normalized IS NOT NULL GROUP BY ALL""",
)
expect(
    "agg_histogram",
    """with lag AS (SELECT date_diff('microsecond', transaction_timestamp, clearing_timestamp) AS us
      FROM cur_transactions WHERE status = 'SETTLED'),
    bins AS (SELECT unnest(range(40)) AS bin)
    SELECT bin, bin * 6 AS from_hour, bin * 6 + 6 AS to_hour, count(us) AS transactions
    FROM bins LEFT JOIN (SELECT us FROM lag WHERE us BETWEEN 0 AND 240 * 3600000000) ON least(us // 21600000000, 39) = bin
    GROUP BY 1""",
)
expect(
    "agg_share_of_total",
    f"""SELECT transaction_currency, {pct('s', '(SELECT sum(billing_amount) FROM cur_transactions)')} AS share_pct
    FROM (SELECT transaction_currency, sum(billing_amount) AS s FROM cur_transactions GROUP BY 1)""",
)
expect(
    "agg_int_avg_trunc",
    f"""SELECT merchant_country, {ratio('sum(d)', 'count(d)', 4)} AS avg_days,
    {big('trunc(sum(d)::DOUBLE / count(d))', 'avg_days_truncated')}
    FROM (SELECT merchant_country, date_diff('day', capture_date_utc, settlement_date_utc) AS d FROM cur_clearing)
    GROUP BY 1""",
)
expect(
    "agg_drop_null_groups",
    """SELECT transaction_currency, count(card_id) AS with_card, count(*) AS n FROM raw_transactions
    WHERE transaction_currency IS NOT NULL GROUP BY 1""",
)
_MONTHLY = """SELECT transaction_currency, year, month, round(sum(billing_amount), 2) AS spend
  FROM cur_transactions WHERE year IS NOT NULL GROUP BY ALL"""
_LAGGED = f"""SELECT *, lag(spend) OVER (PARTITION BY transaction_currency ORDER BY year, month) AS previous
  FROM ({_MONTHLY})"""
expect(
    "window_lag",
    f"SELECT transaction_currency, year, month, {each(dbl, 'spend previous')} FROM ({_LAGGED})",
)
expect(
    "window_mom_change",
    f"""SELECT transaction_currency, year, month, {pct('spend - previous', 'previous')} AS mom_change_pct
    FROM ({_LAGGED})""",
)
expect(
    "surrogate_key",
    "SELECT row_number() OVER (ORDER BY id) AS transaction_key, id FROM cur_transactions",
)
expect(
    "ordinal_label",
    """SELECT id, 'user_' || row_number() OVER (ORDER BY id::BIGINT) AS label FROM raw_users""",
)
expect(
    "topk_10",
    f"""SELECT merchant_normalized, mcc, {total('billing_amount', 'spend')} FROM cur_transactions
    GROUP BY 1, 2 ORDER BY sum(billing_amount) DESC NULLS LAST, 1, 2 LIMIT 10""",
)
expect(
    "topk_15",
    f"""SELECT org_key, {total('billing_amount', 'spend')} FROM fact_transactions
    GROUP BY 1 ORDER BY sum(billing_amount) DESC NULLS LAST, 1 NULLS FIRST LIMIT 15""",
)
expect(
    "sort_multi_key",
    "SELECT organization_id, card_type, count(*) AS cards FROM cur_cards GROUP BY 1, 2",
)
expect(
    "union_all_seed",
    """SELECT 'payment' AS kind, id, billing_amount AS amount FROM raw_transactions
    UNION ALL SELECT 'clearing', "Transaction ID", "GTV" FROM raw_clearing""",
)
_STEPS = (("NATION_12", "NATION_1b"), ("NATION_1", "HOUSE_2"), ("HOUSE_2", "home"), ("me t", "ME-T"))
_nested = "merchant"
for _old, _new in _STEPS:
    _nested = f"replace({_nested}, '{_old}', '{_new}')"
expect("fn_replace_longest_first", f"SELECT id, {_nested} AS merchant FROM raw_transactions")
