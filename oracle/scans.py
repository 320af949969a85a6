"""Expected results of the source and sink queries."""

import re

from oracle.base import (
    DASH,
    dbl,
    dt,
    each,
    expect,
    money,
    title_letters,
    total,
    usd,
)
from cardlake.sources.sample_raw import COLUMNS

expect(
    "scan_csv_strings",
    "SELECT " + ", ".join(COLUMNS["transactions"]) + " FROM raw_transactions",
)
expect(
    "scan_curated_parquet",
    f"SELECT id, year, month, status, {dbl('billing_amount')} FROM cur_transactions",
)
expect("sink_parquet_overwrite", "SELECT id, is_active, email_hash FROM cur_users")
expect(
    "sink_partition_one",
    """SELECT 'cards' AS table_name, card_type AS partition_value, id FROM cur_cards
    UNION ALL SELECT 'clearing', period, transaction_id FROM cur_clearing""",
)
expect(
    "sink_partition_year_month",
    """SELECT id, CASE WHEN year = '1997' THEN 'RELOADED' ELSE status END AS status, year, month
    FROM cur_transactions""",
)

_ORG = "id name business_name contact_number business_type invoices_per_month number_of_employees kyb_id track_id created_at updated_at deleted_at country"
_USER = "id first_name last_name email phone_number password is_active is_verified track_id created_at updated_at deleted_at"
_TYPES = {
    "curated_orgs": [
        (c, {"invoices_per_month": "int", "number_of_employees": "int", "created_at": "timestamp",
             "updated_at": "timestamp", "deleted_at": "timestamp"}.get(c, "string"))
        for c in _ORG.split()
    ] + [("employees_min", "int"), ("employees_max", "int"), ("region", "string")],
    "curated_users": [
        ("id", "string"), ("first_name", "string"), ("last_name", "string"),
        ("is_active", "boolean"), ("is_verified", "boolean"), ("track_id", "string"),
        ("created_at", "timestamp"), ("updated_at", "timestamp"), ("deleted_at", "string"),
        ("email_hash", "string"), ("phone_hash", "string"),
    ],
}


def _typed(source, kinds, more, partitions):
    """Curated columns: those of the raw table, changed types, further columns, and partitions last."""
    names = [re.sub(r"[\s_]+", "_", c).lower() for c in COLUMNS[source]]
    return [(c, kinds.get(c, "string")) for c in [*names, *more] if c not in partitions]


_MONEY = {c: "decimal(18,4)" for c in ("actual_amount", "billing_amount", "transaction_amount", "fee_amount")}
_FEES = {c: "decimal(18,6)" for c in ("transaction_amount", "interchange_recon_fee_amount", "gtv")}
_CLEARED = ["transaction_timestamp_utc", "capture_date_utc", "settlement_date_utc"]
_PARTS = {"curated_transactions": ["year", "month"], "curated_clearing": ["period"], "curated_cards": ["card_type"]}
_TYPES["curated_transactions"] = _typed(
    "transactions",
    _MONEY | {"usd_amount": "decimal(18,6)", "transaction_timestamp": "timestamp", "clearing_timestamp": "timestamp"},
    ["merchant_normalized", "usd_amount"], _PARTS["curated_transactions"],
)
_TYPES["curated_clearing"] = _typed(
    "clearing", _FEES | {c: "timestamp" for c in _CLEARED}, _CLEARED, _PARTS["curated_clearing"]
)
_TYPES["curated_cards"] = _typed(
    "cards",
    {"allow_atm": "boolean", "created_at": "timestamp", "updated_at": "timestamp"}
    | {c: "date" for c in ("issue_date", "expiry_date", "active_since")},
    [], _PARTS["curated_cards"],
)
for _source in COLUMNS:
    _TYPES[f"raw_{_source}"] = [(c, "string") for c in COLUMNS[_source]]
_FILLED = {f"raw_{s}": f"(SELECT count(*) FROM raw_{s})" for s in COLUMNS}
_FILLED |= {f"curated_{s}": f"(SELECT count(*) FROM cur_{s})" for s in COLUMNS}
_FILLED["curated_orgs"] = "2 * " + _FILLED["curated_orgs"]
expect(
    "register_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS column_type, "
        f"{i}::BIGINT AS position, {i > len(columns)} AS is_partition, "
        f"{int(t == 'curated_orgs')}::BIGINT AS folders_read, CAST({_FILLED[t]} AS BIGINT) AS table_rows"
        for t, columns in _TYPES.items()
        for i, (c, k) in enumerate([*columns, *((p, "string") for p in _PARTS.get(t, ()))], 1)
    ),
)
expect(
    "scan_fallback_sources",
    f"""SELECT 'raw' AS branch, 'transactions' AS source, id, concat_ws('|', {title_letters('trim(merchant)')},
      CAST(year(paid) AS VARCHAR), lpad(CAST(month(paid) AS VARCHAR), 2, '0')) AS shown
    FROM (SELECT *, TRY_CAST(transaction_timestamp AS TIMESTAMP) AS paid FROM raw_transactions)
    UNION ALL SELECT 'raw', 'cards', id, concat_ws('|', upper(trim(card_type)), upper(trim(status))) FROM raw_cards
    UNION ALL SELECT 'raw', 'orgs', id, concat_ws('|', business_name, country) FROM raw_orgs
    UNION ALL SELECT 'curated', 'transactions', id, concat_ws('|', merchant_normalized, year, month) FROM cur_transactions
    UNION ALL SELECT 'curated', 'cards', id, concat_ws('|', card_type, status) FROM cur_cards
    UNION ALL SELECT 'curated', 'orgs', id, concat_ws('|', business_name, country) FROM cur_orgs""",
)

expect(
    "scan_fallback_chain",
    f"""SELECT id, CAST(billing AS DOUBLE) AS billing_amount, CAST({usd('billing', DASH)} AS DOUBLE) AS usd_amount,
      {title_letters('trim(merchant)')} AS merchant_normalized,
      CAST(year(paid) AS VARCHAR) AS year, lpad(CAST(month(paid) AS VARCHAR), 2, '0') AS month
    FROM (SELECT *, {money('billing_amount', 4)} AS billing,
      TRY_CAST(transaction_timestamp AS TIMESTAMP) AS paid FROM raw_transactions)""",
)
expect(
    "warehouse_load_columns",
    f"""SELECT id AS card_id, card_holder_id, organization_id AS org_id, name_on_card, card_type,
      card_usage, status, scheme, card_product_type, subtype, last_four_digits,
      {each(dt, 'issue_date expiry_date active_since')}, allow_atm FROM cur_cards""",
)
expect(
    "source_presence",
    """SELECT * FROM (VALUES ('orgs', (SELECT count(*) > 0 FROM nation)), ('users', (SELECT count(*) > 0 FROM customer)),
      ('cards', (SELECT count(*) > 0 FROM customer)),
      ('transactions', (SELECT count(*) > 0 FROM lineitem)), ('clearing', false)) AS v(source, present)""",
)
expect(
    "lakehouse_join",
    f"""SELECT business_name, {total('billing_amount', 'total_spend_aed')}
    FROM cur_transactions t JOIN dim_cards c ON c.card_id = t.card_id
    JOIN dim_organizations o ON o.org_id = c.org_id
    WHERE t.status = 'SETTLED' GROUP BY business_name""",
)
expect(
    "write_metrics",
    " UNION ALL ".join(
        f"SELECT '{s}' AS output, count(*) AS rows_written FROM cur_{s}"
        for s in ("orgs", "users", "cards", "transactions", "clearing")
    ),
)
expect(
    "named_views",
    f"""with top10 AS (
      SELECT merchant_normalized, merchant_country, mcc, round(sum(billing_amount), 2) AS spend
      FROM cur_transactions WHERE status = 'SETTLED' AND merchant_normalized IS NOT NULL
      GROUP BY ALL ORDER BY spend DESC NULLS LAST, merchant_normalized, merchant_country, mcc LIMIT 10),
    months AS (SELECT round(sum(billing_amount), 2) AS spend FROM cur_transactions
      WHERE year IS NOT NULL GROUP BY year, month),
    currencies AS (SELECT round(sum(billing_amount), 2) AS spend FROM cur_transactions
      WHERE status = 'SETTLED' AND year IS NOT NULL GROUP BY year, month, transaction_currency)
    SELECT 'report_top_merchants' AS view_name, count(*) AS view_rows, {dbl('sum(spend)', 'spend')} FROM top10
    UNION ALL SELECT 'report_monthly_volume', count(*), {dbl('sum(spend)', 'spend')} FROM months
    UNION ALL SELECT 'report_currency_breakdown', count(*), {dbl('sum(spend)', 'spend')} FROM currencies""",
)
