"""Expected curated, pseudonymised and star tables."""

from oracle.base import (
    CARD_OUT,
    MERCHANT_ORDER,
    PARTS,
    TRANSACTION_OUT,
    big,
    dbl,
    dt,
    each,
    expect,
    title_letters,
    ts,
)
from oracle.rows import _CALENDAR

expect("curated_transactions", f"SELECT {TRANSACTION_OUT} FROM cur_transactions")
expect(
    "curated_clearing",
    f"""SELECT * REPLACE ({dbl('transaction_amount')}, {dbl('gtv')}, {dbl('interchange_recon_fee_amount')},
      {each(ts, 'transaction_timestamp_utc capture_date_utc settlement_date_utc')}) FROM cur_clearing""",
)
expect("curated_cards", f"SELECT {CARD_OUT} FROM cur_cards")
expect(
    "curated_users",
    f"SELECT * REPLACE ({each(ts, 'created_at updated_at')}) FROM cur_users",
)
expect(
    "curated_orgs",
    f"""SELECT * REPLACE ({each(ts, 'created_at updated_at deleted_at')},
      {each(big, 'invoices_per_month number_of_employees employees_min employees_max')}) FROM cur_orgs""",
)

# Dictionaries: (old, new, place) with the last replacement of a spelling and its first place.
PARTS["org_spellings"] = f"""
  SELECT n * 7 + slot AS place, old, new FROM (
    SELECT row_number() OVER (ORDER BY id::BIGINT) AS n, trim(name) AS a, trim(business_name) AS b
    FROM raw_orgs), LATERAL (VALUES
      (0, a, 'Business ' || n), (1, upper(a), 'BUSINESS ' || n), (2, lower(a), 'business_' || n),
      (3, b, 'business_' || n), (4, lower(b), 'business_' || n),
      (5, {title_letters('b')}, 'Business ' || n), (6, upper(b), 'BUSINESS ' || n)) AS v(slot, old, new)"""
PARTS["user_spellings"] = """
  SELECT n * 2 + slot AS place, old, new FROM (
    SELECT row_number() OVER (ORDER BY id::BIGINT) AS n, trim(first_name) || ' ' || trim(last_name) AS f
    FROM raw_users), LATERAL (VALUES (0, f, 'User ' || n), (1, upper(f), 'USER ' || n)) AS v(slot, old, new)"""
PARTS["brand_spellings"] = """
  SELECT * FROM (VALUES (0, 'trading office', 'brand office'), (1, 'Starbucks', 'Brand'),
    (2, 'b tech', 'brand')) AS v(place, old, new)"""
for _name in ("org", "user", "brand"):
    PARTS[f"{_name}_entries"] = f"""SELECT old, arg_max(new, place) AS new, min(place) AS place
      FROM {_name}_spellings WHERE old <> '' GROUP BY old"""


def _steps(*names: str) -> str:
    """Ordered list of (o, n) replacements of several dictionaries, as a one-row query."""
    union = " UNION ALL ".join(
        f"SELECT {i} AS src, place, old, new FROM {n}_entries" for i, n in enumerate(names)
    )
    return f"""SELECT list({{'o': old, 'n': new}} ORDER BY length(old) DESC, src, place) AS steps
      FROM (SELECT old, arg_max(new, src) AS new, min(src) AS src, arg_min(place, src) AS place
            FROM ({union}) GROUP BY old)"""


PARTS["card_steps"] = _steps("brand", "org", "user")
PARTS["business_steps"] = _steps("brand", "org")


def _replaced(texts: str, steps: str) -> str:
    """(t, r): each distinct text with all replacements applied in order."""
    return f"""SELECT t, list_reduce(steps, lambda acc, x: {{'o': '', 'n': replace(acc.n, x.o, x.n)}},
        {{'o': '', 'n': t}}).n AS r
      FROM (SELECT DISTINCT t FROM ({texts}) WHERE t <> '') CROSS JOIN {steps}"""


PARTS["card_texts"] = _replaced(
    "SELECT name_on_card AS t FROM raw_cards UNION ALL SELECT card_nickname FROM raw_cards",
    "card_steps",
)
PARTS["merchant_texts"] = _replaced("SELECT merchant AS t FROM raw_transactions", "business_steps")
PARTS["clearing_texts"] = _replaced(
    """SELECT "Tenant Name" AS t FROM raw_clearing UNION ALL SELECT "Merchant Name" FROM raw_clearing
    UNION ALL SELECT "Card Holder" FROM raw_clearing""",
    "business_steps",
)

expect("anon_org_dictionary", "SELECT old, new FROM org_entries")
expect("anon_user_dictionary", "SELECT old, new FROM user_entries")
expect(
    "anon_orgs",
    """SELECT * REPLACE ('Business ' || row_number() OVER (ORDER BY id::BIGINT) AS name,
      'business_' || row_number() OVER (ORDER BY id::BIGINT) AS business_name, '' AS contact_number)
    FROM raw_orgs""",
)
_HASH = "CASE WHEN trim(ifnull({0}, '')) = '' THEN '' ELSE sha256(trim({0}))[:16] END AS {0}"
expect(
    "anon_users",
    f"""SELECT * REPLACE ('User' AS first_name, CAST(row_number() OVER (ORDER BY id::BIGINT) AS VARCHAR) AS last_name,
      '[REDACTED]' AS password, {_HASH.format('email')}, {_HASH.format('phone_number')}) FROM raw_users""",
)
expect(
    "anon_cards",
    """SELECT id, ifnull(a.r, name_on_card) AS name_on_card, ifnull(b.r, card_nickname) AS card_nickname
    FROM raw_cards LEFT JOIN card_texts a ON a.t = name_on_card LEFT JOIN card_texts b ON b.t = card_nickname""",
)
expect(
    "anon_transactions",
    """SELECT id, ifnull(r, merchant) AS merchant, billing_amount
    FROM raw_transactions LEFT JOIN merchant_texts ON t = merchant""",
)
expect(
    "anon_clearing",
    """SELECT "Transaction ID" AS transaction_id, ifnull(a.r, "Tenant Name") AS tenant_name,
      ifnull(b.r, "Merchant Name") AS merchant_name, ifnull(c.r, "Card Holder") AS card_holder
    FROM raw_clearing LEFT JOIN clearing_texts a ON a.t = "Tenant Name"
    LEFT JOIN clearing_texts b ON b.t = "Merchant Name" LEFT JOIN clearing_texts c ON c.t = "Card Holder" """,
)

expect(
    "dim_organizations",
    f"""SELECT * REPLACE ({big('num_employees')}, {each(ts, 'created_at updated_at')})
    FROM dim_organizations""",
)
expect("dim_users", f"SELECT * REPLACE ({ts('created_at')}) FROM dim_users")
expect(
    "dim_cards",
    f"SELECT * REPLACE ({each(dt, 'issue_date expiry_date active_since')}) FROM dim_cards",
)
expect(
    "dim_merchants",
    f"""with seen AS (SELECT merchant_normalized AS merchant_name, merchant_city, merchant_country, mcc,
      ifnull(bool_or(year < '1998'), false) AS early FROM cur_transactions
      WHERE merchant_normalized IS NOT NULL GROUP BY ALL)
    SELECT row_number() OVER (ORDER BY early DESC, {MERCHANT_ORDER}) AS merchant_key,
      merchant_name, merchant_city, merchant_country, mcc FROM seen""",
)
expect(
    "dim_dates",
    f"""with days AS (SELECT d FROM range(DATE '2020-01-01', DATE '2031-01-01', INTERVAL 1 DAY) AS a(d)
      UNION ALL SELECT d FROM range(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 1 DAY) AS b(d)),
    busy AS (SELECT date_key AS k, count(*) AS n FROM fact_transactions GROUP BY 1)
    SELECT {_CALENDAR.format('d')}, ifnull(n, 0) AS transactions FROM days
    LEFT JOIN busy ON k = CAST(strftime(d, '%Y%m%d') AS INT)""",
)
_FACT = (
    each(dbl, "actual_amount billing_amount transaction_amount usd_amount fee_amount")
    + ", "
    + each(ts, "transaction_timestamp clearing_timestamp")
    + ", "
    + big("date_key")
)
expect("fact_transactions", f"SELECT * REPLACE ({_FACT}) FROM fact_transactions")
expect(
    "fact_clearing",
    f"""SELECT * REPLACE ({big('date_key')}, {each(dbl, 'transaction_amount gtv interchange_recon_fee')},
      {each(ts, 'transaction_timestamp_utc capture_date_utc settlement_date_utc')}) FROM fact_clearing""",
)
expect(
    "fact_layout",
    f"""SELECT f.transaction_key, f.card_key, {big('f.date_key', 'date_key')}, f.status, c.card_type
    FROM fact_transactions f LEFT JOIN dim_cards c ON c.card_key = f.card_key""",
)
expect(
    "fact_layout_skipping",
    """SELECT count(*) AS rows_in_month, true AS most_files_skipped FROM fact_transactions
    WHERE date_key BETWEEN 19970301 AND 19970331""",
)


def _constraint(table: str, kind: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{table}' || '' AS table_name, '{kind}' AS kind, '{column}' AS column_name, "
        f"CAST(({violations}) AS BIGINT) AS violations"
    )


def _unique(table: str, column: str) -> str:
    return (
        f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {column} FROM {table})) FROM {table}"
    )


def _foreign(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {key} FROM {parent})"
    )


_CONSTRAINTS = [
    _constraint(t, "primary_key", k, _unique(t, k))
    for t, k in (
        ("dim_organizations", "org_key"),
        ("dim_users", "user_key"),
        ("dim_cards", "card_key"),
        ("dim_merchants", "merchant_key"),
        ("dim_dates", "date_key"),
        ("fact_transactions", "transaction_key"),
        ("fact_clearing", "clearing_key"),
    )
]
_CONSTRAINTS += [
    _constraint(t, "unique", k, _unique(t, k))
    for t, k in (
        ("dim_organizations", "org_id"),
        ("dim_users", "user_id"),
        ("dim_cards", "card_id"),
        ("fact_transactions", "transaction_id"),
        ("fact_clearing", "clearing_id"),
    )
]
_CONSTRAINTS += [
    _constraint("fact_transactions", "not_null", c, f"SELECT count(*) FROM fact_transactions WHERE {c} IS NULL")
    for c in ("card_key", "date_key")
]
_CONSTRAINTS += [
    _constraint(t, "foreign_key", c, _foreign(t, c, p, c))
    for t, c, p in (
        ("fact_transactions", "card_key", "dim_cards"),
        ("fact_transactions", "org_key", "dim_organizations"),
        ("fact_transactions", "merchant_key", "dim_merchants"),
        ("fact_transactions", "date_key", "dim_dates"),
        ("fact_clearing", "card_key", "dim_cards"),
        ("fact_clearing", "date_key", "dim_dates"),
    )
]
expect("warehouse_constraints", " UNION ALL ".join(_CONSTRAINTS))
