"""Raw card-domain tables derived from the TPC-H-like sample tables.

The sample tables are clean, so text noise, missing and orphan keys, bad codes and duplicate ids
are injected by key arithmetic. The column formulas are plain SQL text understood by Spark and by
other engines alike, which lets a test derive the same input elsewhere.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators.lookups import is_broadcast

#: Line items in a task that joins them. Their shuffled columns are a small part of the rows made of them,
#: so tasks sized by shuffled bytes would sort more rows than fit in memory.
ROWS_PER_TASK = 250_000

_PRICE = "cast(cast(l_extendedprice as decimal(18,2)) as string)"
_TXN_ID = "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"
_CUST = "cast(c_custkey as string)"
_ORDER_TIME = "cast(o_orderdate as string)"
_SHIP_TIME = "cast(l_shipdate as string)"
_COUNTRY = (
    "CASE l_suppkey % 5 WHEN 0 THEN 'ARE' WHEN 1 THEN 'USA' WHEN 2 THEN 'IRL' "
    "WHEN 3 THEN 'GBR' ELSE 'EGY' END"
)
_CITY = "CASE l_suppkey % 3 WHEN 0 THEN '  dubai ' WHEN 1 THEN 'CAIRO' ELSE 'london' END"
_SINCE = "'2022-03-' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || 'T06:20:25.500Z'"

TRANSACTION_COLUMNS = {
    "id": _TXN_ID,
    "card_id": "CASE WHEN l_orderkey % 211 = 0 THEN NULL "
    "WHEN l_orderkey % 307 = 0 THEN 'CARD-X' || cast(o_custkey as string) "
    "ELSE 'CARD-' || cast(o_custkey as string) END",
    "actual_amount": _PRICE,
    "actual_currency": "'AED'",
    "billing_amount": f"CASE WHEN l_orderkey % 401 = 0 THEN 'n/a' "
    f"WHEN l_orderkey % 503 = 0 THEN '-' || {_PRICE} ELSE {_PRICE} END",
    "billing_currency": "'AED'",
    "transaction_amount": "cast(cast(l_extendedprice as decimal(18,2)) "
    "* cast(l_quantity as decimal(18,2)) as string)",
    "transaction_currency": "CASE WHEN l_partkey % 12 < 5 THEN 'AED' "
    "WHEN l_partkey % 12 < 8 THEN 'USD' WHEN l_partkey % 12 = 8 THEN 'EUR' "
    "WHEN l_partkey % 12 = 9 THEN 'SAR' WHEN l_partkey % 12 = 10 THEN 'EGP' "
    "WHEN l_suppkey % 3 = 0 THEN 'XYZ' WHEN l_suppkey % 3 = 1 THEN NULL ELSE 'GBP' END",
    "fee_amount": "cast(cast(l_tax as decimal(18,2)) as string)",
    "fee_currency": "'AED'",
    "status": "CASE WHEN l_orderkey % 13 = 0 THEN 'PENDING' WHEN o_orderstatus = 'F' "
    "THEN 'SETTLED' WHEN o_orderstatus = 'O' THEN 'DECLINED' ELSE 'REFUNDED' END",
    "dr_cr": "CASE WHEN l_orderkey % 601 = 0 THEN 'debit' WHEN l_linestatus = 'F' "
    "THEN 'DEBIT' ELSE 'CREDIT' END",
    "type": "'PURCHASE'",
    "mcc": "cast(5000 + p_size as string)",
    "merchant": "CASE l_partkey % 8 WHEN 0 THEN ' Meta Platforms, Inc.' WHEN 1 THEN 'GOOGLE LLC ' "
    "WHEN 2 THEN 'Starbucks Coffee' WHEN 3 THEN 'b tech' "
    "WHEN 4 THEN 'NATION_' || cast(l_suppkey % 25 as string) || ' trading' "
    "ELSE upper(p_name) END",
    "merchant_city": _CITY,
    "merchant_country": _COUNTRY,
    "transaction_timestamp": f"CASE WHEN l_orderkey % 701 = 0 THEN 'not-a-date' ELSE {_ORDER_TIME} END",
    "clearing_timestamp": _SHIP_TIME,
}

CLEARING_COLUMNS = {
    "Transaction ID": _TXN_ID,
    "Network": "'MASTERCARD'",
    "MTI": "'1240'",
    "Transaction Code": "'00'",
    "Transaction Type": "CASE WHEN l_returnflag = 'R' THEN 'REFUND' ELSE 'PURCHASE' END",
    "Tenant Name": "'nation_' || cast(l_suppkey % 25 as string) || ' trading office'",
    "Merchant Name": "'NATION_' || cast(l_partkey % 25 as string) || ' store '"
    " || cast(l_suppkey as string)",
    "Merchant City": _CITY,
    "Merchant Country": _COUNTRY,
    "Card Holder": "cast(o_custkey as string)",
    "MCC": "cast(5000 + l_partkey % 50 as string)",
    "Transaction Amount": _PRICE,
    "Transaction Currency": "CASE l_partkey % 3 WHEN 0 THEN '784' WHEN 1 THEN '840' ELSE '818' END",
    "GTV": _PRICE,
    "Interchange Recon Fee Amount": "CASE WHEN l_orderkey % 401 = 0 THEN '' "
    "ELSE cast(cast(l_discount as decimal(18,2)) as string) END",
    "Interchange Fee Sign": "CASE WHEN l_linestatus = 'F' THEN 'DR' ELSE 'CR' END",
    "Settlement Status": "CASE WHEN l_linestatus = 'F' THEN ' settled ' ELSE 'Pending' END",
    "Transaction  Timestamp": f"replace({_ORDER_TIME}, ' ', 'T') || 'Z'",
    "Capture Date": f"CASE l_linenumber % 4 WHEN 0 THEN {_ORDER_TIME} "
    f"WHEN 1 THEN replace({_ORDER_TIME}, ' ', 'T') || '+04:00' "
    f"WHEN 2 THEN substring({_ORDER_TIME}, 9, 2) || '/' || substring({_ORDER_TIME}, 6, 2) "
    f"|| '/' || substring({_ORDER_TIME}, 1, 4) || ' 23:30:00' ELSE 'unknown' END",
    "Settlement Date": _SHIP_TIME,
    "Period": f"CASE l_linenumber % 3 WHEN 0 THEN substring({_ORDER_TIME}, 1, 7) "
    f"WHEN 1 THEN 'October 1, 2023' ELSE NULL END",
}

CARD_COLUMNS = {
    "id": f"'CARD-' || {_CUST}",
    "card_holder_id": f"CASE WHEN c_custkey % 97 = 0 THEN 'U' || {_CUST} ELSE {_CUST} END",
    "card_issuer_id": "'ISSUER-1'",
    "organization_id": "cast(c_nationkey as string)",
    "card_type": "CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN ' physical ' "
    "ELSE 'virtual' END",
    "card_usage": "'CORPORATE'",
    "status": "CASE WHEN c_acctbal < 0 THEN 'terminated' WHEN c_custkey % 50 = 0 THEN 'pending' "
    "ELSE ' active ' END",
    "scheme": "CASE WHEN c_custkey % 2 = 0 THEN ' visa' ELSE 'MasterCard ' END",
    "card_product_type": "'CREDIT'",
    "subtype": "' business '",
    "last_four_digits": "lpad(cast(c_custkey % 10000 as string), 4, '0')",
    "name_on_card": f"CASE WHEN c_custkey % 3 = 0 THEN 'GIVEN' || {_CUST} || ' FAMILY' || {_CUST} "
    f"WHEN c_custkey % 3 = 1 THEN 'Given' || {_CUST} || ' Family' || {_CUST} "
    f"ELSE 'NATION_' || cast(c_nationkey as string) || ' FLEET' END",
    "card_nickname": f"CASE WHEN c_custkey % 4 = 0 THEN NULL "
    f"ELSE 'nation_' || cast(c_nationkey as string) || ' trading of Given' || {_CUST} "
    f"|| ' Family' || {_CUST} END",
    "issue_date": "CASE WHEN c_custkey % 13 = 0 THEN 'soon' ELSE '2021-05-' "
    "|| lpad(cast(1 + c_custkey % 28 as string), 2, '0') END",
    "expiry_date": "'2026-05-31'",
    "active_since": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '2021-06-' "
    "|| lpad(cast(1 + c_custkey % 30 as string), 2, '0') END",
    "allow_atm": "CASE c_custkey % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' ELSE 'maybe' END",
    "created_at": _SINCE,
    "updated_at": _SINCE,
}

USER_COLUMNS = {
    "id": _CUST,
    "first_name": f"'Given' || {_CUST}",
    "last_name": f"'Family' || {_CUST}",
    "email": f"' User' || {_CUST} || '@Example.com '",
    "phone_number": f"CASE WHEN c_custkey % 11 = 0 THEN '  ' WHEN c_custkey % 19 = 0 THEN NULL "
    f"ELSE '+9715' || lpad({_CUST}, 8, '0') END",
    "is_active": "CASE WHEN c_acctbal < 0 THEN 'FALSE' ELSE 'TRUE' END",
    "is_verified": "CASE c_custkey % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'unclear' END",
    "password": "'not-a-real-secret'",
    "track_id": f"'track-' || {_CUST}",
    "created_at": _SINCE,
    "updated_at": _SINCE,
    "deleted_at": "CASE WHEN c_custkey % 29 = 0 THEN '2023-01-01T00:00:00.000Z' ELSE NULL END",
}

ORG_COLUMNS = {
    "id": "cast(n_nationkey as string)",
    "name": "n_name",
    "business_name": "'  ' || n_name || ' trading '",
    "contact_number": "'+971500' || cast(n_nationkey as string)",
    "business_type": "CASE WHEN n_nationkey % 2 = 0 THEN 'ITI' ELSE 'LLC' END",
    "invoices_per_month": "CASE WHEN n_nationkey % 7 = 0 THEN 'many' "
    "ELSE cast(n_nationkey * 5 as string) END",
    "number_of_employees": "CASE n_nationkey % 3 WHEN 0 THEN '11-25' WHEN 1 THEN '51-100' "
    "ELSE '40' END",
    "kyb_id": "'kyb-' || cast(n_nationkey as string)",
    "track_id": "'track-' || cast(n_nationkey as string)",
    "created_at": "'2022-03-18T06:20:25.500Z'",
    "updated_at": "'2022-04-08T10:21:25.288Z'",
    "deleted_at": "CASE WHEN n_nationkey % 12 = 5 THEN '2023-01-01T00:00:00.000Z' ELSE NULL END",
    "country": "CASE n_regionkey WHEN 0 THEN ' ae' WHEN 1 THEN 'us ' WHEN 2 THEN 'gb' "
    "WHEN 3 THEN 'ie' ELSE NULL END",
}

COLUMNS = {
    "transactions": TRANSACTION_COLUMNS,
    "clearing": CLEARING_COLUMNS,
    "cards": CARD_COLUMNS,
    "users": USER_COLUMNS,
    "orgs": ORG_COLUMNS,
}


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks of a join that makes wide rows of ``rows`` narrow ones, no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


def sample_raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Raw text table of one source, built from the sample tables below ``sf_dir``."""

    def table(name: str) -> DataFrame:
        return sample_table(spark, sf_dir, name)

    if source in ("transactions", "clearing"):
        # Both sides grow with the data. A shuffle join also spreads a file of one row group.
        lines, orders, part = table("lineitem"), table("orders"), table("part")
        tasks = join_tasks(spark, lines.count())
        same_part, late = F.expr("l_partkey = p_partkey"), is_broadcast(part)
        if source == "transactions" and not late:
            lines = lines.repartition(tasks, "l_partkey").join(part.repartition(tasks, "p_partkey"), same_part)
        lines = lines.repartition(tasks, "l_orderkey").hint("shuffle_merge")
        base = lines.join(orders.repartition(tasks, "o_orderkey"), F.expr("l_orderkey = o_orderkey"))
        if source == "transactions" and late:
            base = base.join(part, same_part)
    elif source in ("cards", "users"):
        base = table("customer")
    else:
        base = table("nation")
    return base.selectExpr(*(f"{sql} AS `{name}`" for name, sql in COLUMNS[source].items()))

