"""Shards of nearly equal size: a minimax cut of an ordered row of groups. DataFrame functions only.

Equal texts form one group, which no cut divides. Groups stand in the order of their content key.
The smallest capacity is sought for which greedy filling needs no more than the wanted shards; the
search tries many capacities at once, and each greedy step is one aggregate over the few groups
whose running size can be the next cut (a range that Parquet statistics narrow). What reaches the
driver is one row per step. Groups that hold a large part of all rows stay whole by definition;
their rows are spread over many tasks by (key, doc_id).

Cases: a null text has no bytes (size 1) and shares the group of the empty text; repeated rows are
rows like any other; a null doc_id sorts first; an empty table gives no rows; fewer groups than
shards leave the last shards empty; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import dense_key, documents, running_totals, settle

PROBES = 12
_KEY = ("_key", "_crc", "_size")


def smallest_capacity(groups: DataFrame, end: str, total: int, largest: int, shards: int):
    """The least capacity for greedy filling, and the running sizes at which its shards end.

    groups: one row per group with its inclusive running size ``end``.
    """

    def fill(capacities: list[int]) -> dict[int, list[int]]:
        """Cuts of greedy filling for those capacities that need no more than ``shards``."""
        cuts: dict[int, list[int]] = {c: [] for c in capacities}
        done: dict[int, list[int]] = {}
        for left in range(shards, 0, -1):
            limits = {c: (cut[-1] if cut else 0) + c for c, cut in cuts.items()}
            done |= {c: cuts.pop(c) for c, limit in limits.items() if limit >= total}
            if not cuts or left == 1:
                return done
            asked = sorted({limits[c] for c in cuts})
            near = F.lit(False)
            for limit in asked:
                near = near | F.col(end).between(limit - largest + 1, limit)
            found = (
                groups.filter(near)
                .agg(*(F.max(F.when(F.col(end) <= x, F.col(end))).alias(f"c{x}") for x in asked))
                .first()
            )
            for c in cuts:
                cuts[c].append(found[f"c{limits[c]}"])
        return done

    low = max(math.ceil(total / shards), largest)
    high = max(low, math.ceil(total / shards) + largest)  # always enough: no shard but the last stays emptier
    best, best_cuts = None, None
    while best is None or low < best:
        top = high if best is None else best - 1
        count = min(PROBES, top - low + 1)
        tried = sorted({low + (top - low) * i // max(1, count - 1) for i in range(count)})
        works = fill(tried)
        if works:
            best = min(works)
            best_cuts = works[best]
        failed = [c for c in tried if c not in works and (best is None or c < best)]
        low = max(failed) + 1 if failed else low
        if not failed and best == tried[0]:
            break
    return best, best_cuts


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: whole groups of equal texts, the largest shard least."""
    text = documents(docs)
    narrow = settle(
        text.select(
            "doc_id",
            F.xxhash64("text").alias("_key"),
            F.crc32(F.col("text").cast("binary")).alias("_crc"),
            (F.octet_length("text") + F.lit(1)).cast("bigint").alias("_size"),
        ),
        "shard_rows",
    )
    groups = narrow.groupBy(*_KEY).agg(F.count("*").alias("_rows"))
    groups = groups.withColumn("_weight", F.col("_rows") * F.col("_size"))
    order = [F.col(c) for c in _KEY]
    ends = settle(
        running_totals(groups, order, {"_end": F.col("_weight"), "_rows_end": F.col("_rows")}),
        "shard_groups",
    )
    whole = ends.agg(F.max("_end"), F.max("_weight")).first()
    cuts: list[int] = []
    if whole[0]:
        cuts = smallest_capacity(ends, "_end", whole[0], whole[1], shards)[1]
    marks = (
        ends.filter(F.col("_end").isin(cuts)).orderBy("_end").collect() if cuts else []
    )  # one row for each cut
    shard, first = F.lit(0), F.lit(0).cast("bigint")
    for number, mark in enumerate(marks, 1):
        beyond = F.struct(*_KEY) > F.struct(*(F.lit(mark[c]).cast("bigint").alias(c) for c in _KEY))
        shard = F.when(beyond, F.lit(number)).otherwise(shard)
        first = F.when(beyond, F.lit(mark["_rows_end"]).cast("bigint")).otherwise(first)
    rows = dense_key(narrow, [*order, F.col("doc_id")], "_row", 0)
    return rows.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        shard.cast("int").alias("shard"),
        (F.col("_row") - first).cast("bigint").alias("slot"),
    )
