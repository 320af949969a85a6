"""Building blocks: named common table expressions and the few SQL helpers they share."""

from __future__ import annotations

import re

from cardlake.sources.sample_raw import COLUMNS

ORACLE: dict[str, str] = {}
PARTS: dict[str, str] = {}


def ts(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g') AS {name or x}"


def dt(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d') AS {name or x}"


def dbl(x: str, name: str | None = None) -> str:
    return f"CAST({x} AS DOUBLE) AS {name or x}"


def big(x: str, name: str | None = None) -> str:
    return f"CAST({x} AS BIGINT) AS {name or x}"


def each(fn, names: str) -> str:
    return ", ".join(fn(n) for n in names.split())


def half_up(x: str, digits: int) -> str:
    """Round a DOUBLE half up on its shortest decimal text (66388.415 → 66388.42)."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def pct(a: str, b: str, digits: int = 2) -> str:
    return half_up(
        f"100.0::DOUBLE * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits
    )


def ratio(a: str, b: str, digits: int = 2) -> str:
    return half_up(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits)


def mean(x: str, digits: int = 2) -> str:
    return ratio(f"sum({x})", f"count({x})", digits)


def total(x: str, name: str) -> str:
    return f"CAST(round(sum({x}), 2) AS DOUBLE) AS {name}"


def title_words(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
        f"lambda w: concat(upper(w[1]), w[2:])), ' ')"
    )


def title_letters(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|\\P{{L}}+'), "
        f"lambda w: concat(upper(w[1]), w[2:])), '')"
    )


def sql(text: str) -> str:
    """Prefix a query with the common table expressions it uses, directly or not."""
    ordered: list[str] = []

    def need(body: str) -> None:
        for name in sorted(set(re.findall(r"\b[a-z_]+\b", body)) & set(PARTS)):
            if name not in ordered:
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(text)
    if not ordered:
        return text
    chain = ",\n".join(f"{n} AS ({PARTS[n]})" for n in ordered)
    head = "WITH RECURSIVE " if "recursive" in text else "WITH "
    joint = ",\n" if text.lstrip().lower().startswith("with ") else "\n"
    body = re.sub(r"^\s*with\s+", "", text, flags=re.I) if joint == ",\n" else text
    return f"{head}{chain}{joint}{body}"


def expect(key: str, text: str) -> None:
    ORACLE[key] = sql(text)


def _raw(source: str, tables: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in COLUMNS[source].items()) + " " + tables


PARTS["raw_transactions"] = _raw(
    "transactions",
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
)
PARTS["raw_clearing"] = _raw("clearing", "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
PARTS["raw_cards"] = _raw("cards", "FROM customer")
PARTS["raw_users"] = _raw("users", "FROM customer")
PARTS["raw_orgs"] = _raw("orgs", "FROM nation")

CURRENCY_LIST = "('AED', 'USD', 'EGP', 'GBP', 'EUR', 'SAR', 'KWD')"


def usd_rate(x: str) -> str:
    return (
        f"CAST(CASE {x} WHEN 'AED' THEN '0.2723' WHEN 'USD' THEN '1' WHEN 'EGP' THEN '0.0206' "
        f"WHEN 'GBP' THEN '1.27' WHEN 'EUR' THEN '1.08' WHEN 'SAR' THEN '0.2667' "
        f"WHEN 'KWD' THEN '3.25' END AS DECIMAL(10,6))"
    )


def usd(amount: str, rate: str) -> str:
    return f"CAST(round(CAST({amount} AS DECIMAL(18,6)) * {rate}, 6) AS DECIMAL(18,6))"


def money(x: str, scale: int) -> str:
    return f"TRY_CAST({x} AS DECIMAL(18,{scale}))"


def merchant(x: str) -> str:
    return f"""CASE
      WHEN lower(trim({x})) IN ('meta platforms, inc.', 'meta platforms inc', 'facebook') THEN 'Meta'
      WHEN lower(trim({x})) IN ('google llc', 'google ireland limited', 'alphabet inc') THEN 'Google'
      WHEN lower(trim({x})) IN ('starbucks coffee', 'starbucks corporation') THEN 'Starbucks'
      WHEN lower(trim({x})) IN ('emirates airline', 'emirates airlines') THEN 'Emirates'
      WHEN lower(trim({x})) IN ('b.tech', 'b tech', 'btech') THEN 'B.Tech'
      WHEN lower(trim({x})) = 'amazon web services' THEN 'AWS'
      WHEN lower(trim({x})) = 'amazon.com' THEN 'Amazon'
      ELSE {title_words(x)} END"""


def clearing_time(x: str) -> str:
    """Clearing texts: plain, ISO with zone (colon, Z or none), day first, then month first."""
    return f"""CASE
      WHEN regexp_full_match({x}, '\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%Y-%m-%d %H:%M:%S')
      WHEN regexp_full_match({x}, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d{{1,3}})?(Z|[+-]\\d\\d:?\\d\\d)')
        THEN TRY_CAST(substring({x}, 1, 19) AS TIMESTAMP) - CASE
          WHEN {x} LIKE '%Z' THEN INTERVAL 0 MINUTE
          ELSE to_minutes(CAST((CASE WHEN regexp_extract({x}, '([+-])\\d\\d:?\\d\\d$', 1) = '-' THEN -1 ELSE 1 END)
            * (60 * CAST(regexp_extract({x}, '[+-](\\d\\d):?\\d\\d$', 1) AS INT)
               + CAST(regexp_extract({x}, '[+-]\\d\\d:?(\\d\\d)$', 1) AS INT)) AS BIGINT)) END
      WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d:\\d\\d')
        THEN coalesce(try_strptime({x}, '%d/%m/%Y %H:%M:%S'), try_strptime({x}, '%m/%d/%Y %H:%M:%S'))
      END"""


PARTS["typed_transactions"] = f"""
  SELECT id, card_id, {", ".join(f"{money(c, 4)} AS {c}" for c in
    ("actual_amount", "billing_amount", "transaction_amount", "fee_amount"))},
    actual_currency, billing_currency, transaction_currency, fee_currency,
    status, dr_cr, type, mcc, merchant, merchant_city, merchant_country,
    TRY_CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
    TRY_CAST(clearing_timestamp AS TIMESTAMP) AS clearing_timestamp
  FROM raw_transactions"""

PARTS["rich_transactions"] = f"""
  SELECT * EXCLUDE (merchant_city), {title_words("merchant_city")} AS merchant_city,
    {merchant("merchant")} AS merchant_normalized,
    {usd("billing_amount", usd_rate("billing_currency"))} AS usd_amount,
    CAST(year(transaction_timestamp) AS VARCHAR) AS year,
    lpad(CAST(month(transaction_timestamp) AS VARCHAR), 2, '0') AS month
  FROM typed_transactions WHERE transaction_currency IN {CURRENCY_LIST}"""


def first_per(key: str, order: str, source: str) -> str:
    ranking = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split())
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {ranking}) = 1"
    )


PARTS["cur_transactions"] = first_per(
    "id",
    "card_id actual_amount actual_currency billing_amount billing_currency transaction_amount "
    "transaction_currency fee_amount fee_currency status dr_cr type mcc merchant merchant_city "
    "merchant_country transaction_timestamp clearing_timestamp merchant_normalized usd_amount "
    "year month",
    "rich_transactions",
)

PARTS["typed_clearing"] = f"""
  SELECT "Transaction ID" AS transaction_id, "Network" AS network, "MTI" AS mti,
    "Transaction Code" AS transaction_code, "Transaction Type" AS transaction_type,
    "Tenant Name" AS tenant_name, "Merchant Name" AS merchant_name,
    "Merchant City" AS merchant_city, "Merchant Country" AS merchant_country,
    "Card Holder" AS card_holder, "MCC" AS mcc,
    {money('"Transaction Amount"', 6)} AS transaction_amount,
    "Transaction Currency" AS transaction_currency, {money('"GTV"', 6)} AS gtv,
    {money('"Interchange Recon Fee Amount"', 6)} AS interchange_recon_fee_amount,
    "Interchange Fee Sign" AS interchange_fee_sign,
    upper(trim("Settlement Status")) AS settlement_status,
    "Transaction  Timestamp" AS transaction_timestamp, "Capture Date" AS capture_date,
    "Settlement Date" AS settlement_date, "Period" AS given_period,
    {clearing_time('"Transaction  Timestamp"')} AS transaction_timestamp_utc,
    {clearing_time('"Capture Date"')} AS capture_date_utc,
    {clearing_time('"Settlement Date"')} AS settlement_date_utc
  FROM raw_clearing"""

PARTS["period_clearing"] = """
  SELECT * EXCLUDE (given_period), coalesce(
    nullif(regexp_extract(given_period, '^(\\d{4}-\\d{2})', 1), ''),
    strftime(try_strptime(given_period, '%B %d, %Y'), '%Y-%m'),
    strftime(capture_date_utc, '%Y-%m'), 'unknown') AS period
  FROM typed_clearing"""

PARTS["cur_clearing"] = first_per(
    "transaction_id",
    "network mti transaction_code transaction_type tenant_name merchant_name merchant_city "
    "merchant_country card_holder mcc transaction_amount transaction_currency gtv "
    "interchange_recon_fee_amount interchange_fee_sign settlement_status transaction_timestamp "
    "capture_date settlement_date period transaction_timestamp_utc capture_date_utc "
    "settlement_date_utc",
    "period_clearing",
)


def yes_no(x: str) -> str:
    return (
        f"CASE WHEN lower({x}) IN ('true', 't', 'yes', 'y', '1') THEN true "
        f"WHEN lower({x}) IN ('false', 'f', 'no', 'n', '0') THEN false END"
    )


PARTS["cur_cards"] = f"""
  SELECT id, card_holder_id, card_issuer_id, organization_id, upper(trim(card_type)) AS card_type,
    card_usage, upper(trim(status)) AS status, upper(trim(scheme)) AS scheme, card_product_type,
    upper(trim(subtype)) AS subtype, last_four_digits, name_on_card, card_nickname,
    TRY_CAST(issue_date AS DATE) AS issue_date, TRY_CAST(expiry_date AS DATE) AS expiry_date,
    TRY_CAST(active_since AS DATE) AS active_since, {yes_no("allow_atm")} AS allow_atm,
    TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at
  FROM raw_cards QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""

PARTS["cur_users"] = f"""
  SELECT id, first_name, last_name, {yes_no("is_active")} AS is_active,
    {yes_no("is_verified")} AS is_verified, track_id,
    TRY_CAST(created_at AS TIMESTAMP) AS created_at,
    TRY_CAST(updated_at AS TIMESTAMP) AS updated_at, deleted_at,
    sha256(lower(trim(email))) AS email_hash, sha256(trim(phone_number)) AS phone_hash
  FROM raw_users QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""

PARTS["cur_orgs"] = """
  SELECT id, name, trim(business_name) AS business_name, contact_number, business_type,
    TRY_CAST(invoices_per_month AS INT) AS invoices_per_month,
    TRY_CAST(number_of_employees AS INT) AS number_of_employees, kyb_id, track_id,
    TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
    TRY_CAST(deleted_at AS TIMESTAMP) AS deleted_at, upper(trim(country)) AS country,
    TRY_CAST(string_split(number_of_employees, '-')[1] AS INT) AS employees_min,
    TRY_CAST(string_split(number_of_employees, '-')[-1] AS INT) AS employees_max
  FROM raw_orgs QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""

PARTS["dim_organizations"] = """
  SELECT row_number() OVER (ORDER BY id) AS org_key, id AS org_id, business_name, country,
    business_type, number_of_employees AS num_employees, created_at, updated_at
  FROM cur_orgs"""

PARTS["dim_users"] = """
  SELECT row_number() OVER (ORDER BY id) AS user_key, id AS user_id, printed AS name_on_card,
    email_hash, phone_hash, is_active, is_verified, created_at
  FROM cur_users LEFT JOIN (SELECT card_holder_id, min(name_on_card) AS printed
    FROM cur_cards GROUP BY card_holder_id) ON card_holder_id = id"""

PARTS["dim_cards"] = """
  SELECT row_number() OVER (ORDER BY id) AS card_key, id AS card_id, card_holder_id,
    organization_id AS org_id, name_on_card, card_type, card_usage, status, scheme,
    card_product_type, subtype, last_four_digits, issue_date, expiry_date, active_since, allow_atm
  FROM cur_cards"""

MERCHANT_ORDER = (
    "merchant_name NULLS FIRST, merchant_city NULLS FIRST, merchant_country NULLS FIRST, "
    "mcc NULLS FIRST"
)
PARTS["dim_merchants"] = f"""
  SELECT row_number() OVER (ORDER BY {MERCHANT_ORDER}) AS merchant_key, *
  FROM (SELECT DISTINCT merchant_normalized AS merchant_name, merchant_city, merchant_country, mcc
        FROM cur_transactions WHERE merchant_normalized IS NOT NULL)"""

PARTS["dim_dates"] = """
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date
  FROM range(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 1 DAY) AS calendar(d)"""

PARTS["fact_transactions"] = """
  SELECT row_number() OVER (ORDER BY t.id NULLS FIRST) AS transaction_key, t.id AS transaction_id,
    c.card_key, o.org_key, m.merchant_key,
    CAST(strftime(t.transaction_timestamp, '%Y%m%d') AS INT) AS date_key,
    t.actual_amount, t.actual_currency, t.billing_amount, t.billing_currency,
    t.transaction_amount, t.transaction_currency, t.usd_amount, t.fee_amount, t.fee_currency,
    t.status, t.dr_cr, t.type, t.mcc, t.merchant, t.merchant_city, t.merchant_country,
    t.transaction_timestamp, t.clearing_timestamp
  FROM cur_transactions t LEFT JOIN dim_cards c ON c.card_id = t.card_id
  LEFT JOIN dim_organizations o ON o.org_id = c.org_id
  LEFT JOIN dim_merchants m ON m.merchant_name = t.merchant_normalized
    AND m.merchant_city IS NOT DISTINCT FROM t.merchant_city
    AND m.merchant_country IS NOT DISTINCT FROM t.merchant_country
    AND m.mcc IS NOT DISTINCT FROM t.mcc"""

PARTS["fact_clearing"] = """
  SELECT row_number() OVER (ORDER BY r.transaction_id NULLS FIRST) AS clearing_key,
    r.transaction_id AS clearing_id, r.transaction_id, f.card_key,
    CAST(strftime(r.capture_date_utc, '%Y%m%d') AS INT) AS date_key,
    CAST(NULL AS VARCHAR) AS approval_code, r.transaction_amount, r.transaction_currency, r.gtv,
    r.interchange_recon_fee_amount AS interchange_recon_fee, r.interchange_fee_sign,
    r.settlement_status, r.network, r.transaction_type, r.mcc, r.mti, r.merchant_name,
    r.merchant_city, r.merchant_country, r.transaction_timestamp_utc, r.capture_date_utc,
    r.settlement_date_utc
  FROM cur_clearing r LEFT JOIN fact_transactions f ON f.transaction_id = r.transaction_id"""

# Outputs of whole tables in comparable types.
TRANSACTION_OUT = (
    "id, card_id, "
    + each(dbl, "actual_amount billing_amount transaction_amount fee_amount usd_amount")
    + ", actual_currency, billing_currency, transaction_currency, fee_currency, status, dr_cr, "
    "type, mcc, merchant, merchant_city, merchant_country, merchant_normalized, year, month, "
    + each(ts, "transaction_timestamp clearing_timestamp")
)
CARD_OUT = (
    "id, card_holder_id, card_issuer_id, organization_id, card_type, card_usage, status, scheme, "
    "card_product_type, subtype, last_four_digits, name_on_card, card_nickname, allow_atm, "
    + each(dt, "issue_date expiry_date active_since")
    + ", "
    + each(ts, "created_at updated_at")
)

# Dashboard rate of the billing currency, with the default for any other.
DASH = (
    "CAST(CASE billing_currency WHEN 'USD' THEN '1' WHEN 'EGP' THEN '0.0206' "
    "WHEN 'GBP' THEN '1.27' WHEN 'EUR' THEN '1.08' ELSE '0.2723' END AS DECIMAL(10,6))"
)
