"""One row per key, with a survivor that does not depend on the run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.operators.layout import narrow_first, quoted
from cardlake.sources.shared import settle


def one_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = (), varying: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row per key: by ``prefer``, then by all other columns ascending, NULL first.

    The ``row_number() = 1`` filter is also applied before the shuffle (Spark's window group
    limit), so each task sends at most one row per key however many copies a key has. ``varying`` names
    the texts whose lengths vary most; rows are shuffled with these and the keys last.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*prefer, *rest)
    moved = narrow_first(df, [*varying, *keys]).withColumn("_rank", F.row_number().over(ranked))
    return moved.filter("_rank = 1").select(*quoted(df.columns))


def one_per_key_counted(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()
) -> DataFrame:
    """The rows of :func:`one_per_key`, for wide stored tables in which few keys are repeated.

    Keys are counted first, without the other columns, and the repeated ones are written. Rows with a
    key of their own are neither sorted nor, while Spark broadcasts the repeated keys by their size,
    shuffled; only rows with a repeated key are ranked. ``df`` is read three times (once for the keys
    alone), so a table that is costly to derive should be written before.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    counted = df.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names))).count()
    repeated = settle(counted.filter("count > 1").select(*names), "repeated_keys")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)))
    alone = df.join(repeated, same, "left_anti")
    return alone.unionByName(one_per_key(df.join(repeated, same, "left_semi"), keys, prefer))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; a missing key counts as one value."""
    return df.agg(surplus_rows(F.col(key)).alias("duplicates"))


def surplus_rows(key: Column) -> Column:
    """Aggregate expression behind :func:`duplicate_count`."""
    any_missing = F.coalesce(F.max(F.isnull(key).cast("bigint")), F.lit(0))
    return F.count("*") - F.count_distinct(key) - any_missing
