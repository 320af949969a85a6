"""Declarative data-quality rules compiled to aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake import fixed_values
from cardlake.operators.dedup import surplus_rows
from cardlake.operators.joins import orphans


class DataQualityError(Exception):
    """At least one gating check found violations."""


@dataclass(frozen=True)
class Rule:
    """One check. ``kind`` is complete, positive, in_set, unique, not_before or reference.

    ``args``: allowed values (in_set), earlier column (not_before), parent table and column
    (reference). ``where`` restricts the rows looked at.
    """

    name: str
    table: str
    kind: str
    column: str
    args: tuple = ()
    where: str | None = None


# The published rules.
RULES = (
    Rule("transactions_no_null_card_id", "transactions", "complete", "card_id"),
    Rule(
        "transactions_positive_settled_amount",
        "transactions",
        "positive",
        "billing_amount",
        where="status = 'SETTLED'",
    ),
    Rule(
        "transactions_valid_currency",
        "transactions",
        "in_set",
        "transaction_currency",
        fixed_values.CURRENCIES,
    ),
    Rule("transactions_no_duplicate_ids", "transactions", "unique", "id"),
    Rule(
        "transactions_card_id_referential_integrity",
        "transactions",
        "reference",
        "card_id",
        ("cards", "id"),
    ),
    Rule(
        "cards_holder_referential_integrity", "cards", "reference", "card_holder_id", ("users", "id")
    ),
    Rule(
        "clearing_settlement_after_transaction",
        "clearing",
        "not_before",
        "settlement_date_utc",
        ("transaction_timestamp_utc",),
    ),
    Rule("clearing_no_duplicate_transaction_ids", "clearing", "unique", "transaction_id"),
    Rule("transactions_valid_dr_cr", "transactions", "in_set", "dr_cr", fixed_values.ENTRY_SIDES),
    Rule("cards_valid_status", "cards", "in_set", "status", fixed_values.CARD_STATUSES),
)

# Checks that stop the load, and the rule each one is.
GATE = {
    "null_card_ids": "transactions_no_null_card_id",
    "invalid_currencies": "transactions_valid_currency",
    "negative_settled_amounts": "transactions_positive_settled_amount",
}


def _holds(rule: Rule) -> Column:
    """Row condition of a rule; NULL where the value is missing."""
    value = F.col(rule.column)
    if rule.kind == "complete":
        return value.isNotNull()
    if rule.kind == "positive":
        return value > 0
    if rule.kind == "in_set":
        return value.isin(*rule.args)
    if rule.kind == "not_before":
        return value >= F.col(rule.args[0])
    raise ValueError(f"unknown kind of rule: {rule.kind}")


def row_sums(rule: Rule) -> dict[str, Column]:
    """Aggregates of a rule that add up over parts of its table: violations that single rows show (none for
    uniqueness and references), rows left undecided and rows checked."""
    value = F.col(rule.column)
    applies = F.expr(rule.where) if rule.where else F.lit(True)
    if rule.kind == "unique":
        violations, undecided = F.lit(0), F.lit(0)
    elif rule.kind == "reference":
        violations, undecided = F.lit(0), F.count_if(F.isnull(value))
    else:
        holds = _holds(rule)
        violations = F.count_if(applies & ~holds)
        undecided = F.count_if(applies & F.isnull(holds))
    return {"violations": violations, "undecided": undecided, "checked": F.count_if(applies)}


def _counts(rule: Rule, tables: Mapping[str, DataFrame]) -> dict[str, Column]:
    """Aggregates of a rule over its own table; orphans come as a scalar subquery."""
    counts = row_sums(rule)
    if rule.kind == "unique":
        counts["violations"] = surplus_rows(F.col(rule.column))
    elif rule.kind == "reference":
        parent, parent_key = rule.args
        lost = orphans(tables[rule.table], tables[parent], rule.column, parent_key)
        counts["violations"] = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).scalar()
    return counts


def scorecard(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: violations, undecided rows (missing values), rows checked, verdict.

    The rules of one table share one aggregate, so the table is scanned once for all of them.
    Uniqueness rules have a scan of their key column each, references one of theirs.
    """
    results = []
    for table in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == table]
        together = [r for r in mine if r.kind != "unique"]
        for batch in ([together] if together else []) + [[r] for r in mine if r.kind == "unique"]:
            results.append(_shared_aggregate(batch, tables))
    whole = reduce(DataFrame.unionByName, results)
    return whole.withColumn("passed", F.col("violations") == 0)


def _shared_aggregate(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    measures = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.table).alias("table_name"),
            *(c.cast("bigint").alias(n) for n, c in _counts(r, tables).items()),
        )
        for r in rules
    ]
    rows = tables[rules[0].table].agg(F.array(*measures).alias("results"))
    return rows.select(F.inline("results"))


def gate_verdicts(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, str] = GATE,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """One row per gating check: its violations and whether it lets the load go on."""
    by_rule = {rule: check for check, rule in checks.items()}
    wanted = [r for r in rules if r.name in by_rule]
    names = F.create_map(*(F.lit(x) for pair in by_rule.items() for x in pair))
    return scorecard(wanted, tables).select(
        F.element_at(names, F.col("rule")).alias("check_name"), "violations", "passed"
    )


def gate(verdicts: DataFrame) -> None:
    """Raise, naming every failed check, if one of the (few-row) verdicts failed."""
    failed = verdicts.filter("NOT passed").orderBy("check_name").collect()
    if failed:
        raise DataQualityError(
            "; ".join(f"{r.check_name}: {r.violations} violations" for r in failed)
        )
