"""Star schema: dimensions with surrogate keys, facts with resolved keys, layout, constraints."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import calendar
from cardlake.operators.dedup import one_per_key, surplus_rows
from cardlake.operators.joins import orphans
from cardlake.operators.keys import dense_key, number_by_id
from cardlake.operators.lookups import SHARE, frequent_hashes, is_broadcast, key_hash, lookup
from cardlake.sources.datasets import drop_external, load_columns

# Target column → curated column.
ORGANIZATION_COLUMNS = {
    "org_id": "id",
    "business_name": "business_name",
    "country": "country",
    "business_type": "business_type",
    "num_employees": "number_of_employees",
    "created_at": "created_at",
    "updated_at": "updated_at",
}
USER_COLUMNS = {
    "user_id": "id",
    "name_on_card": "name_on_card",
    "email_hash": "email_hash",
    "phone_hash": "phone_hash",
    "is_active": "is_active",
    "is_verified": "is_verified",
    "created_at": "created_at",
}
CARD_COLUMNS = {
    "card_id": "id",
    "card_holder_id": "card_holder_id",
    "org_id": "organization_id",
    "name_on_card": "name_on_card",
    "card_type": "card_type",
    "card_usage": "card_usage",
    "status": "status",
    "scheme": "scheme",
    "card_product_type": "card_product_type",
    "subtype": "subtype",
    "last_four_digits": "last_four_digits",
    "issue_date": "issue_date",
    "expiry_date": "expiry_date",
    "active_since": "active_since",
    "allow_atm": "allow_atm",
}
CLEARING_COLUMNS = {
    "clearing_id": "transaction_id",
    "transaction_id": "transaction_id",
    "transaction_amount": "transaction_amount",
    "transaction_currency": "transaction_currency",
    "gtv": "gtv",
    "interchange_recon_fee": "interchange_recon_fee_amount",
    "interchange_fee_sign": "interchange_fee_sign",
    "settlement_status": "settlement_status",
    "network": "network",
    "transaction_type": "transaction_type",
    "mcc": "mcc",
    "mti": "mti",
    "merchant_name": "merchant_name",
    "merchant_city": "merchant_city",
    "merchant_country": "merchant_country",
    "transaction_timestamp_utc": "transaction_timestamp_utc",
    "capture_date_utc": "capture_date_utc",
    "settlement_date_utc": "settlement_date_utc",
}
MERCHANT_COLUMNS = ("merchant_name", "merchant_city", "merchant_country", "mcc")
FACT_MEASURES = (
    "actual_amount",
    "actual_currency",
    "billing_amount",
    "billing_currency",
    "transaction_amount",
    "transaction_currency",
    "usd_amount",
    "fee_amount",
    "fee_currency",
    "status",
    "dr_cr",
    "type",
    "mcc",
    "merchant",
    "merchant_city",
    "merchant_country",
    "transaction_timestamp",
    "clearing_timestamp",
)


def dim_organizations(orgs: DataFrame, active_only: bool = False) -> DataFrame:
    """One row per organisation, the latest version of each."""
    kept = orgs.filter(F.col("deleted_at").isNull()) if active_only else orgs
    latest = one_per_key(kept, ["id"], [F.col("updated_at").desc_nulls_last()])
    return dense_key(load_columns(latest, ORGANIZATION_COLUMNS), [F.col("org_id")], "org_key")


def dim_users(users: DataFrame, cards: DataFrame) -> DataFrame:
    """One row per user; the printed name comes from the user's cards (first by name)."""
    printed = cards.groupBy(F.col("card_holder_id").alias("id")).agg(
        F.min("name_on_card").alias("name_on_card")
    )
    named = users.join(printed, "id", "left")
    return dense_key(load_columns(named, USER_COLUMNS), [F.col("user_id")], "user_key")


def dim_cards(cards: DataFrame) -> DataFrame:
    return dense_key(load_columns(cards, CARD_COLUMNS), [F.col("card_id")], "card_key")


def merchant_tuples(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("merchant_normalized").isNotNull())
        .select(
            F.col("merchant_normalized").alias("merchant_name"),
            "merchant_city",
            "merchant_country",
            "mcc",
        )
        .distinct()
    )


def dim_merchants(transactions: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct merchants. Known ones keep their key, new ones are numbered after the last key."""
    order = [F.col(c).asc_nulls_first() for c in MERCHANT_COLUMNS]
    found = merchant_tuples(transactions)
    if existing is None:
        return dense_key(found, order, "merchant_key")
    known = existing.select(*(F.col(c).alias(f"known_{c}") for c in MERCHANT_COLUMNS))
    same = reduce(
        lambda a, b: a & b, (found[c].eqNullSafe(known[f"known_{c}"]) for c in MERCHANT_COLUMNS)
    )
    added = dense_key(found.join(known, same, "left_anti"), order, "merchant_key")
    last = existing.agg(F.coalesce(F.max("merchant_key"), F.lit(0)).alias("last")).scalar()
    shifted = added.withColumn("merchant_key", F.col("merchant_key") + last)
    return existing.select("merchant_key", *MERCHANT_COLUMNS).unionByName(shifted)


def dim_dates(spark: SparkSession, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day")
    )
    return days.select(*(c.alias(n) for n, c in calendar.calendar_parts(F.col("day")).items()))


MERCHANT_PAIRS = (
    ("merchant_normalized", "merchant_name"),
    ("merchant_city", "merchant_city"),
    ("merchant_country", "merchant_country"),
    ("mcc", "mcc"),
)


def resolve_keys(
    transactions: DataFrame, cards: DataFrame, organizations: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Transactions with card, organisation, merchant and date keys; unknown ones get NULL.

    Cards and organisations are joined to each other first, so rows are looked up once by card and once
    by merchant. All dimension join keys are unique: no row multiplies. Cards and merchants that hold
    many rows, and rows without a card, stay out of the shuffles (see ``lookups``).
    """
    found = _look_up(transactions, cards, organizations, merchants)
    return found.withColumn("date_key", calendar.date_key(F.col("transaction_timestamp")))


def _look_up(
    transactions: DataFrame, cards: DataFrame, organizations: DataFrame, merchants: DataFrame
) -> DataFrame:
    sides = cards.select("card_key", "card_id", "org_id"), organizations.select("org_key", "org_id")
    owners, small = sides[0].join(sides[1], "org_id", "left"), all(map(is_broadcast, sides))
    carded = lookup(transactions, owners, [("card_id", "card_id")], ["card_key", "org_key"], small=small)
    return lookup(carded, merchants, MERCHANT_PAIRS, ["merchant_key"], missing_matches=True)


def fact_transactions(
    transactions: DataFrame, cards: DataFrame, organizations: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Transactions with their keys and a dense number in the order of their ids.

    Only ids and the columns that keys are found by go through the lookups and are numbered; whole
    rows are shuffled once, by id, to meet their keys.
    """
    sought = ("id", "card_id", *(a for a, _ in MERCHANT_PAIRS))
    found = _look_up(transactions.select(*sought), cards, organizations, merchants)
    keys = found.select(F.col("id").alias("transaction_id"), "card_key", "org_key", "merchant_key")
    rows = transactions.select(F.col("id").alias("transaction_id"), *FACT_MEASURES)
    numbered = number_by_id(rows, keys, "transaction_id", "transaction_key", ["merchant"])
    return numbered.select(
        "transaction_key",
        "transaction_id",
        "card_key",
        "org_key",
        "merchant_key",
        calendar.date_key(F.col("transaction_timestamp")).alias("date_key"),
        *FACT_MEASURES,
    )


def fact_clearing(clearing: DataFrame, transactions: DataFrame) -> DataFrame:
    """Clearing rows; the card key comes from the fact transaction with the same id.

    Ids meet their card key and their number first; whole rows are shuffled once, by id.
    """
    given = {c: source for c, source in CLEARING_COLUMNS.items() if c != "transaction_id"}
    rows = load_columns(clearing, given)
    ids = clearing.select(F.col("transaction_id").alias("clearing_id"))
    cards = transactions.select(F.col("transaction_id").alias("clearing_id"), "card_key")
    keys = ids.join(cards, "clearing_id", "left")
    return number_by_id(rows, keys, "clearing_id", "clearing_key", ["merchant_name"]).select(
        "clearing_key",
        "clearing_id",
        F.col("clearing_id").alias("transaction_id"),
        "card_key",
        calendar.date_key(F.col("capture_date_utc")).alias("date_key"),
        F.lit(None).cast("string").alias("approval_code"),
        *(c for c in CLEARING_COLUMNS if c not in ("clearing_id", "transaction_id")),
    )


def lay_out_fact(
    fact: DataFrame,
    table: str,
    path: str,
    sort_by: Sequence[str],
    rows_per_bucket: int = 4_000_000,
    buckets: int | None = None,
) -> DataFrame:
    """Store a fact by card, sorted within buckets, with table statistics.

    The number of buckets follows from the rows unless it is given, as for a table to join with. Cards that hold many rows, and rows without a card, would
    overfill a bucket; they are stored beside the buckets, in ranges of ``sort_by`` of even size. Reading
    gives both. External tables of the two names are replaced; managed ones are refused.
    """
    spark, beside = fact.sparkSession, f"{table}_spread"
    for name in (table, beside):
        drop_external(spark, name)
    buckets = buckets or max(1, math.ceil(fact.count() / rows_per_bucket))
    known = fact.filter(F.col("card_key").isNotNull())
    hot = frequent_hashes(known, ["card_key"], share=max(SHARE, 1 / buckets))
    spread = key_hash(["card_key"]).isin(hot) | F.col("card_key").isNull()
    bucketed = fact.filter(~spread).write.bucketBy(buckets, "card_key").sortBy(*sort_by)
    bucketed.option("path", f"{path}/buckets").format("parquet").saveAsTable(table)
    ranges = in_ranges(fact.filter(spread), sort_by).write.option("path", f"{path}/spread")
    ranges.format("parquet").saveAsTable(beside)
    for name in (table, beside):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(sort_by)}")
    return spark.table(table).unionByName(spark.table(beside))


def in_ranges(df: DataFrame, order: Sequence[str], rows_per_file: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``; a hash of the row splits ranges of equal values."""
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    by = [*(F.col(c) for c in order), tie]
    if rows_per_file:
        parts = max(1, math.ceil(df.count() / rows_per_file))
        return df.repartitionByRange(parts, *by).sortWithinPartitions(*order)
    return df.repartitionByRange(*by).sortWithinPartitions(*order)


def cluster_fact(fact: DataFrame, path: str, order: Sequence[str], rows_per_file: int = 4_000_000) -> DataFrame:
    """Store a fact in files that each cover a narrow range of ``order``, so that filters skip files."""
    in_ranges(fact, order, rows_per_file).write.mode("overwrite").parquet(path)
    return fact.sparkSession.read.parquet(path)


def files_met(stored: DataFrame, column: str, low, high) -> DataFrame:
    """files, files_met: how many files there are, and in how many a value of the range may lie.

    Like a reader, it looks at the least and the largest value of each file.
    """
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("least"), F.max(column).alias("most")
    )
    met = (F.col("least") <= F.lit(high)) & (F.col("most") >= F.lit(low))
    return files.agg(F.count("*").alias("files"), F.count_if(met).alias("files_met"))


# (table, kind, column, parent table, parent column)
CONSTRAINTS = (
    ("dim_organizations", "primary_key", "org_key", None, None),
    ("dim_organizations", "unique", "org_id", None, None),
    ("dim_users", "primary_key", "user_key", None, None),
    ("dim_users", "unique", "user_id", None, None),
    ("dim_cards", "primary_key", "card_key", None, None),
    ("dim_cards", "unique", "card_id", None, None),
    ("dim_merchants", "primary_key", "merchant_key", None, None),
    ("dim_dates", "primary_key", "date_key", None, None),
    ("fact_transactions", "primary_key", "transaction_key", None, None),
    ("fact_transactions", "unique", "transaction_id", None, None),
    ("fact_transactions", "not_null", "card_key", None, None),
    ("fact_transactions", "not_null", "date_key", None, None),
    ("fact_transactions", "foreign_key", "card_key", "dim_cards", "card_key"),
    ("fact_transactions", "foreign_key", "org_key", "dim_organizations", "org_key"),
    ("fact_transactions", "foreign_key", "merchant_key", "dim_merchants", "merchant_key"),
    ("fact_transactions", "foreign_key", "date_key", "dim_dates", "date_key"),
    ("fact_clearing", "primary_key", "clearing_key", None, None),
    ("fact_clearing", "unique", "clearing_id", None, None),
    ("fact_clearing", "foreign_key", "card_key", "dim_cards", "card_key"),
    ("fact_clearing", "foreign_key", "date_key", "dim_dates", "date_key"),
)


def check_constraints(
    tables: Mapping[str, DataFrame], constraints: Sequence[tuple] = CONSTRAINTS
) -> DataFrame:
    """One row per declared constraint with the number of violating rows.

    NOT NULL constraints of a table share one scan; a primary key also counts its missing values.
    Foreign keys ignore missing values.
    """
    results = []
    for table in dict.fromkeys(c[0] for c in constraints):
        mine = [c[1:] for c in constraints if c[0] == table]
        required = {c: F.count_if(F.isnull(F.col(c))) for kind, c, *_ in mine if kind == "not_null"}
        if required:
            results.append(_violations(tables[table], table, "not_null", required))
        for kind, column, parent, parent_column in mine:
            key = F.col(column)
            if kind == "unique":
                counted = {column: surplus_rows(key)}
            elif kind == "primary_key":
                counted = {column: surplus_rows(key) + F.count_if(F.isnull(key))}
            elif kind == "foreign_key":
                counted = {column: F.coalesce(F.sum("rows"), F.lit(0))}
            else:
                continue
            source = tables[table]
            if kind == "foreign_key":
                source = orphans(source, tables[parent], column, parent_column)
            results.append(_violations(source, table, kind, counted))
    return reduce(DataFrame.unionByName, results)


def _violations(source: DataFrame, table: str, kind: str, counted: Mapping) -> DataFrame:
    """One row per column from one aggregate over ``source``."""
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), n.cast("bigint").alias("violations"))
            for c, n in counted.items()
        )
    )
    return source.agg(rows.alias("rows")).select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.inline("rows")
    )
