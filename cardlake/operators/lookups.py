"""Lookups of many rows in a table with unique keys, where a few keys may hold most of the rows.

Keys that many rows share are found first: each task keeps a bounded summary of frequent items, and the
summaries are merged. Rows with such a key, and rows without one, don't enter the shuffle. They meet the
few table rows that are theirs, a table that is bounded by the number of frequent keys and so can be
broadcast; only the other rows are shuffled, and no key among them is large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent keys kept apart at most, items that a summary tracks, and the share of rows that makes a key
#: frequent.
MOST, TRACKED, SHARE = 128, 4096, 0.002


def key_hash(columns: Sequence[str | Column]) -> Column:
    return F.xxhash64(*columns)


def frequent_hashes(df: DataFrame, columns: Sequence[str], most: int = MOST, share: float = SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, ``most`` of them at most.

    Counts are those of the merged summaries, which overestimate a little: a key taken for frequent
    by mistake is looked up the other way, with the same result.
    """
    summary = F.expr(f"approx_top_k(h, {most}, {TRACKED})")
    row = df.select(key_hash(columns).alias("h")).agg(summary.alias("top"), F.count("*").alias("n")).first()
    return [item["item"] for item in row["top"] if item["count"] >= share * row["n"]]


def is_broadcast(table: DataFrame) -> bool:
    """Whether Spark takes the table as small enough to send to all executors by itself."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit


def lookup(
    rows: DataFrame,
    table: DataFrame,
    pairs: Sequence[tuple[str, str]],
    take: Sequence[str],
    missing_matches: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Left join on (row column, table column) pairs, which are unique in ``table``; adds ``take``.

    ``missing_matches``: a missing value equals a missing one. Otherwise rows that miss a part of the key
    get NULL without a join. ``rows`` is read twice unless the table is small; ``small`` says so for a
    table that is itself a join, whose size Spark can't tell beforehand. Such a table is broadcast by a hint,
    or Spark would shuffle the rows before it learns the size.
    """
    mine, theirs = [a for a, _ in pairs], [b for _, b in pairs]
    right = table.select(*(F.col(b).alias(f"_t{i}") for i, b in enumerate(theirs)), *take)
    if missing_matches:
        same = reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(f"_t{i}")) for i, a in enumerate(mine)))
    else:
        same = reduce(lambda a, b: a & b, (F.col(a) == F.col(f"_t{i}") for i, a in enumerate(mine)))
    out = [*(F.col(f"`{c}`") for c in rows.columns), *take]
    if small:
        return rows.join(F.broadcast(right), same, "left").select(*out)
    if small is None and is_broadcast(right):
        return rows.join(right, same, "left").select(*out)
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in mine))
    keyed = rows if missing_matches else rows.filter(whole)
    # a key is split off where it would be more than one task's share
    share = max(SHARE, 1 / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.col("_h").isin(frequent_hashes(keyed, mine, share=share))
    left = keyed.withColumn("_h", key_hash(mine))
    right = right.withColumn("_h", key_hash([f"_t{i}" for i in range(len(pairs))]))
    few, rest = right.filter(hot).drop("_h"), right.filter(~hot).drop("_h")
    parts = [
        left.filter(hot).join(F.broadcast(few), same, "left").select(*out),
        left.filter(~hot).join(rest, same, "left").select(*out),
    ]
    if not missing_matches:
        nothing = [F.lit(None).cast(table.schema[c].dataType).alias(c) for c in take]
        parts.append(rows.filter(~whole).select(*out[: len(rows.columns)], *nothing))
    return reduce(DataFrame.unionByName, parts)
