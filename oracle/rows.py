"""Expected results of casts, predicates and scalar functions."""

from oracle.base import (
    CURRENCY_LIST,
    DASH,
    big,
    clearing_time,
    dbl,
    dt,
    each,
    expect,
    merchant,
    money,
    pct,
    title_letters,
    title_words,
    ts,
    usd,
    usd_rate,
    yes_no,
)
from cardlake.sources.sample_raw import COLUMNS

_AMOUNTS = ("actual_amount", "billing_amount", "transaction_amount", "fee_amount")
expect(
    "cast_money_4",
    "SELECT id, " + ", ".join(dbl(money(c, 4), c) for c in _AMOUNTS) + " FROM raw_transactions",
)
expect(
    "cast_money_6",
    f"""SELECT "Transaction ID" AS transaction_id, {dbl(money('"Transaction Amount"', 6), 'transaction_amount')},
    {dbl(money('"Interchange Recon Fee Amount"', 6), 'interchange_recon_fee_amount')},
    {dbl(money('"GTV"', 6), 'gtv')} FROM raw_clearing""",
)
expect(
    "parse_timestamp",
    f"""SELECT id, {ts('TRY_CAST(transaction_timestamp AS TIMESTAMP)', 'transaction_timestamp')},
    {ts('TRY_CAST(clearing_timestamp AS TIMESTAMP)', 'clearing_timestamp')} FROM raw_transactions""",
)
expect(
    "parse_timestamp_multi_utc",
    f"""SELECT "Transaction ID" AS transaction_id,
    {ts(clearing_time('"Transaction  Timestamp"'), 'transaction_timestamp_utc')},
    {ts(clearing_time('"Capture Date"'), 'capture_date_utc')},
    {ts(clearing_time('"Settlement Date"'), 'settlement_date_utc')} FROM raw_clearing""",
)
expect(
    "cast_date",
    "SELECT id, "
    + ", ".join(
        dt(f"TRY_CAST({c} AS DATE)", c) for c in ("issue_date", "expiry_date", "active_since")
    )
    + " FROM raw_cards",
)
expect(
    "cast_boolean",
    f"SELECT id, {yes_no('is_active')} AS is_active, {yes_no('is_verified')} AS is_verified FROM raw_users",
)
expect(
    "cast_integer_tolerant",
    "SELECT id, "
    + each(big, "invoices_per_month number_of_employees employees_min employees_max")
    + " FROM cur_orgs",
)
expect(
    "cast_ids_string",
    "SELECT c_custkey::VARCHAR AS id, c_nationkey::VARCHAR AS organization_id FROM customer",
)
_SNAKE = {c: "_".join(c.lower().split()) for c in COLUMNS["clearing"]}
expect(
    "rename_snake_case",
    "SELECT " + ", ".join(f'"{c}" AS {n}' for c, n in _SNAKE.items()) + " FROM raw_clearing",
)
expect("drop_columns", "SELECT * EXCLUDE (email, phone_number, password) FROM raw_users")
expect(
    "filter_isin",
    f"""SELECT id, transaction_currency FROM raw_transactions
    WHERE transaction_currency IN {CURRENCY_LIST}""",
)
expect(
    "filter_not_null",
    f"""SELECT transaction_id, {each(ts, 'transaction_timestamp_utc capture_date_utc settlement_date_utc')}
    FROM cur_clearing WHERE transaction_timestamp_utc IS NOT NULL AND capture_date_utc IS NOT NULL
      AND settlement_date_utc IS NOT NULL""",
)
expect(
    "filter_status",
    "SELECT id, status FROM raw_transactions WHERE status IN ('SETTLED', 'REFUNDED')",
)
_LAG = "CAST(epoch_us(clearing_timestamp) - epoch_us(transaction_timestamp) AS DOUBLE) / 3600000000.0::DOUBLE"
expect(
    "filter_range",
    f"SELECT * FROM (SELECT id, {_LAG} AS lag_hours FROM cur_transactions) WHERE lag_hours BETWEEN 0 AND 240",
)
expect(
    "case_exposure",
    """SELECT id, if(transaction_currency = 'AED', 'Domestic', 'Foreign') AS exposure_type,
    if(transaction_currency = 'AED', 'Domestic (AED)', 'Foreign Currency') AS panel_label
    FROM cur_transactions""",
)
expect(
    "coalesce_defaults",
    f"""SELECT id, ifnull(card_id, '') AS card_id, ifnull(transaction_currency, 'AED') AS currency,
    ifnull(CAST({money('billing_amount', 4)} AS DOUBLE), 0) AS billing_amount FROM raw_transactions""",
)
expect(
    "safe_ratio_pct",
    f"""SELECT mcc, {pct('declined', 'n')} AS declined_pct,
    {pct('declined', 'settled', 1)} AS declined_per_settled_pct FROM (
      SELECT mcc, count(*) AS n, count(*) FILTER (status = 'DECLINED') AS declined,
        count(*) FILTER (status = 'SETTLED' AND mcc < '5025') AS settled
      FROM cur_transactions GROUP BY mcc)""",
)
expect(
    "guarded_ratio",
    """SELECT 'all' AS rows_of, round(100.0::DOUBLE * count(*) FILTER (status = 'SETTLED') / greatest(count(*), 1), 1) AS settled_pct
    FROM cur_transactions UNION ALL SELECT 'none', 0.0::DOUBLE""",
)
expect(
    "rate_band",
    """SELECT *, CASE WHEN rate < 50 THEN 'low' WHEN rate < 80 THEN 'medium' ELSE 'high' END AS band,
      round(rate - 80, 1) AS delta_to_target
    FROM (SELECT organization_id, card_type,
      round(100.0::DOUBLE * count(*) FILTER (status = 'ACTIVE') / greatest(count(*), 1), 1) AS rate
      FROM cur_cards GROUP BY organization_id, card_type)""",
)

expect(
    "fn_upper_trim",
    """SELECT id, upper(trim(card_type)) AS card_type, upper(trim(status)) AS status,
    upper(trim(scheme)) AS scheme, upper(trim(subtype)) AS subtype FROM raw_cards""",
)
expect(
    "fn_title_case",
    f"""SELECT id, {title_words('merchant')} AS merchant, {title_words('merchant_city')} AS merchant_city
    FROM raw_transactions""",
)
expect(
    "fn_title_case_letters",
    f"SELECT id, {title_letters('trim(merchant)')} AS merchant FROM raw_transactions",
)
expect(
    "fn_sha256",
    """SELECT id, sha256(lower(trim(email))) AS email_hash, sha256(trim(phone_number)) AS phone_hash
    FROM raw_users""",
)
_SHORT = "CASE WHEN {0} IS NULL OR trim({0}) = '' THEN '' ELSE left(sha256(trim({0})), 16) END AS {0}"
expect(
    "fn_sha256_16",
    f"SELECT id, {_SHORT.format('email')}, {_SHORT.format('phone_number')} FROM raw_users",
)
expect("fn_lpad_month", "SELECT o_orderkey, strftime(o_orderdate, '%m') AS month FROM orders")
expect("fn_concat_year_month", "SELECT id, year || '-' || month AS year_month FROM cur_transactions")
expect(
    "fn_regex_period",
    """SELECT "Transaction ID" AS transaction_id, CASE WHEN "Period" SIMILAR TO '\\d{4}-\\d{2}.*'
    THEN left("Period", 7) END AS period FROM raw_clearing""",
)
expect(
    "fn_date_format_period",
    """SELECT transaction_id, ifnull(strftime(capture_date_utc, '%Y-%m'), 'unknown') AS period
    FROM typed_clearing""",
)
expect(
    "fn_year_month_parts",
    "SELECT id, strftime(paid, '%Y') AS year, strftime(paid, '%m') AS month FROM (SELECT id, "
    "TRY_CAST(transaction_timestamp AS TIMESTAMP) AS paid FROM raw_transactions)",
)
expect(
    "fn_datediff_hour",
    """SELECT transaction_id, date_diff('hour', transaction_timestamp_utc, capture_date_utc)
    AS hours_to_capture FROM cur_clearing""",
)
expect(
    "fn_datediff_day",
    """SELECT transaction_id, date_diff('day', capture_date_utc, settlement_date_utc)
    AS days_to_settle FROM cur_clearing""",
)
expect("fn_lag_hours", f"SELECT id, {_LAG} AS lag_hours FROM cur_transactions")
expect(
    "fn_date_key",
    """SELECT id, CAST(strftime(transaction_timestamp, '%Y%m%d') AS BIGINT) AS date_key
    FROM cur_transactions""",
)
_CALENDAR = """CAST(strftime({0}, '%Y%m%d') AS BIGINT) AS date_key,
    strftime({0}, '%Y-%m-%d') AS full_date, year({0})::BIGINT AS year, quarter({0})::BIGINT AS quarter,
    month({0})::BIGINT AS month, monthname({0}) AS month_name, day({0})::BIGINT AS day_of_month,
    dayofweek({0})::BIGINT AS day_of_week, dayname({0}) AS day_name,
    weekofyear({0})::BIGINT AS week_of_year, dayofweek({0}) IN (0, 6) AS is_weekend,
    day({0}) = 1 AS is_month_start, CAST({0} AS DATE) = last_day({0}) AS is_month_end"""
expect("fn_calendar_parts", f"SELECT o_orderkey, {_CALENDAR.format('o_orderdate')} FROM orders")
expect(
    "fn_cast_to_date",
    f"""SELECT transaction_currency, {dt('min(transaction_timestamp)', 'first_date')},
    {dt('max(transaction_timestamp)', 'last_date')} FROM cur_transactions GROUP BY 1""",
)
expect(
    "fn_round_money",
    "SELECT id, "
    + ", ".join(dbl(f"round(usd_amount, {d})", f"usd_{d}") for d in (1, 2, 6))
    + " FROM cur_transactions",
)
expect(
    "fn_map_lookup_fx",
    f"""SELECT id, {dbl(usd(money('billing_amount', 4), usd_rate('transaction_currency')), 'usd_amount')}
    FROM raw_transactions""",
)
expect(
    "fn_fx_default_rate",
    f"""SELECT id, {dbl(usd(money('billing_amount', 4), DASH.replace('billing_currency', "ifnull(transaction_currency, '')")), 'usd_amount')}
    FROM raw_transactions""",
)
expect(
    "fn_case_map_merchant",
    f"SELECT id, {merchant('merchant')} AS merchant_normalized FROM raw_transactions",
)
expect(
    "fn_redact_literal",
    """SELECT 'users' AS table_name, id, '[REDACTED]' AS redacted FROM raw_users
    UNION ALL SELECT 'orgs', id, '' FROM raw_orgs""",
)
