"""Ordinals and surrogate keys without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.operators.layout import narrow_first
from cardlake.sources.shared import settle

# The row position within its partition is kept in the low 33 bits of this built-in id.
_POSITION_BITS = (1 << 33) - 1


def dense_key(df: DataFrame, order: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Add ``name`` = start, start+1, … in the given order.

    The rows are range-partitioned, sorted and settled once (range bounds come from a sample, so a
    second evaluation could split differently). Each partition's offset is the number of rows
    before it; that table has one row per partition, which bounds what is broadcast. ``order``
    should be unique per row, which also keeps the ranges even.
    """
    if not order:
        raise ValueError("an ordinal needs an order")
    ranged = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(_POSITION_BITS).alias("_pos"),
        ),
        "ranged",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    key = F.col("_offset") + F.col("_pos") + F.lit(start)
    return ranged.join(F.broadcast(offsets), "_part").select(
        key.cast("bigint").alias(name), *df.columns
    )


def number_by_id(
    df: DataFrame, ids: DataFrame, id_column: str, name: str, varying: Sequence[str] = ()
) -> DataFrame:
    """Add the dense ordinal of a unique id, and what else ``ids`` holds, to wide rows.

    Only the narrow ``ids`` table is sampled, range-partitioned and settled; the wide rows are
    computed once and meet their number in a join on the id, shuffled with the ``varying`` texts last.
    """
    others = [c for c in ids.columns if c != id_column and c not in df.columns]
    numbered = dense_key(
        ids.select(F.col(id_column).alias("_id"), *others), [F.col("_id").asc_nulls_first()], name
    )
    same = F.col(id_column).eqNullSafe(F.col("_id"))
    moved = narrow_first(df, [id_column, *varying])
    return moved.join(numbered, same).select(name, *df.columns, *others)


def ordinal_by_number(df: DataFrame, id_column: str, name: str) -> DataFrame:
    """Number entities 1, 2, … by their numeric id (ids that are no number come first).

    Only the distinct ids are numbered, so an id that many rows share stays one row there and
    all its rows get the same number.
    """
    ids = df.select(F.col(id_column).alias("_id")).distinct()
    numbered = dense_key(ids, [F.col("_id").try_cast("bigint"), F.col("_id")], name)
    same = F.col(id_column).eqNullSafe(F.col("_id"))
    return df.join(numbered, same).select(name, *df.columns)
