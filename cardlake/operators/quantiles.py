"""Exact interpolating quantiles that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.sources.shared import settle


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    slice_width: int,
) -> DataFrame:
    """One row per group with an exact, linearly interpolated quantile per given name.

    ``value`` is an integer column. Ranks are found by refinement. The values are cut into slices of
    ``slice_width``, and rows are counted by slice, so a row for each slice and task is all that is
    shuffled. Running totals over the slices tell which of them hold a wanted rank, at most two for
    each quantile. Only rows of these are read again, counted by value and placed; the few wanted
    slices are written first, so Spark knows that they are small and keeps other rows from the
    shuffle. Pick the width near the square root of the value range, or 1 where there are few
    different values: the slices are the values then, and one pass is enough.
    """
    groups = list(groups)
    held = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    sliced = held.withColumn("_slice", F.floor(F.col("_v") / F.lit(slice_width)))
    counted = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = counted.select(
        *groups, "_slice", "_n", F.sum("_n").over(upto).alias("_end"), F.sum("_n").over(whole).alias("_total")
    )
    if slice_width == 1:
        spans = slices.withColumnRenamed("_slice", "_v")
    else:
        first, places = F.col("_end") - F.col("_n"), []
        for p in probabilities.values():
            at = F.lit(p) * (F.col("_total") - 1)
            places += [F.floor(at), F.ceil(at)]
        holds = reduce(lambda a, b: a | b, ((at >= first) & (at < F.col("_end")) for at in places))
        wanted = slices.filter(holds).select(*groups, "_slice", first.alias("_before"), "_total")
        inside = Window.partitionBy(*groups, "_slice").orderBy("_v")
        spans = (
            _join_groups(sliced, settle(wanted, "wanted_slices"), [*groups, "_slice"])
            .groupBy(*groups, "_slice", "_v", "_before", "_total")
            .agg(F.count("*").alias("_n"))
            .select(
                *groups, "_v", "_total", "_n", (F.col("_before") + F.sum("_n").over(inside)).alias("_end")
            )
        )
    # A value covers the zero-based positions [end - n, end); a quantile sits at p * (total - 1).
    first = F.col("_end") - F.col("_n")
    picks = []
    for name, p in probabilities.items():
        at = F.lit(p) * (F.col("_total") - 1)
        for suffix, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (position >= first) & (position < F.col("_end"))
            picks.append(F.max(F.when(covers, F.col("_v"))).alias(f"_{name}_{suffix}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_share"))
    found = spans.groupBy(*groups).agg(*picks)
    results = [
        (
            F.col(f"_{n}_lo").cast("double")
            + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")).cast("double") * F.col(f"_{n}_share")
        ).alias(n)
        for n in probabilities
    ]
    return found.select(*groups, *results)


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join in which NULL group values match."""
    right = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), "_before", "_total")
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, match).drop(*(f"_r_{k}" for k in keys))
