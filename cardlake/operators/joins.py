"""Join helpers. Spark chooses broadcast or shuffle from table sizes; nothing is forced here
except where the small side has a fixed size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row counts. Missing keys are left out.

    The child is first reduced to one row per key, so a key held by many rows costs one row in
    the join.
    """
    held = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count("*").alias("rows"))
    )
    return held.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def blank_if_null(columns: Sequence[str], prefix: str = "_k") -> list[Column]:
    """Text join keys in which NULL and '' are the same value."""
    return [F.coalesce(F.col(c), F.lit("")).alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def blank_safe_lookup(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], take: Sequence[str]
) -> DataFrame:
    """Left join on text columns where a missing value and '' are the same.

    ``right`` must be unique in that sense, or rows of ``left`` multiply.
    """
    marks = [f"_k{i}" for i in range(len(pairs))]
    lhs = left.select("*", *blank_if_null([a for a, _ in pairs]))
    rhs = right.select(*blank_if_null([b for _, b in pairs]), *take)
    return lhs.join(rhs, marks, "left").drop(*marks)


def null_safe_lookup(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], take: Sequence[str]
) -> DataFrame:
    """Left join on columns where NULL matches NULL and nothing else."""
    rhs = right.select(*(F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(pairs)), *take)
    same = reduce(
        lambda a, b: a & b,
        (left[name].eqNullSafe(F.col(f"_k{i}")) for i, (name, _) in enumerate(pairs)),
    )
    return left.join(rhs, same, "left").select(*left.columns, *take)
