"""The scorecard over time: states of the rules for each folder of a dataset, merged without its rows.

A state is what a rule needs of one folder: sums of violations, undecided and checked rows, and for
uniqueness and references the distinct keys with their row counts. Sums and counts merge by addition, so
the scorecard of a whole dataset follows from the states of its folders. A refresh lists the folders,
reads those whose files changed since the notes of the last one, and replaces their states; notes are
published last, so a refresh that fails is simply repeated. Merging reads the keys of all folders, in
which a hot key is one row a folder, and no other column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake.operators.quality import Rule, row_sums
from cardlake.sources import versions
from cardlake.sources.datasets import write_dataset
from cardlake.sources.raw import path_exists
from cardlake.sources.shared import settle

_KEYED = ("unique", "reference")
_SUMS = "rule string, violations bigint, undecided bigint, checked bigint, _part string"
_KEYS = "rule string, key string, rows bigint, _part string"
_NOTES = "part string, folder string, files bigint, latest timestamp, bytes bigint"


def _part(file_path: Column) -> Column:
    """The ``name=value`` segments of a file's path, ``-`` where there are none."""
    return F.concat(F.lit("-"), F.concat_ws("/", F.filter(F.split(file_path, "/"), lambda s: s.contains("="))))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """Folders that hold Parquet files; the files are not opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(
        _part(F.col("_metadata.file_path")).alias("part"),
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
    ).agg(
        F.count("*").alias("files"), F.max("modificationTime").alias("latest"), F.sum("length").alias("bytes")
    )


def row_states(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Sums of each rule for each ``_part`` of the rows, from one scan for all rules."""
    measures = [
        F.struct(F.lit(r.name).alias("rule"), *(c.cast("bigint").alias(n) for n, c in row_sums(r).items()))
        for r in rules
    ]
    found = rows.groupBy("_part").agg(F.array(*measures).alias("sums"))
    return found.select("_part", F.inline("sums")).select(*[c.split()[0] for c in _SUMS.split(", ")])


def key_states(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Distinct keys of the uniqueness and reference rules with their row counts, for each ``_part``."""
    counted = [
        rows.groupBy("_part", F.col(r.column).cast("string").alias("key"))
        .agg(F.count("*").alias("rows"))
        .select(F.lit(r.name).alias("rule"), "key", "rows", "_part")
        for r in rules
    ]
    return reduce(DataFrame.unionByName, counted)


def refresh(
    spark: SparkSession, rules: Sequence[Rule], table: str, path: str, schema: StructType, state: str
) -> int:
    """Bring the states of one table's folders up to date; the number of folders read.

    Paths of folders that changed reach the driver, and no others.
    """
    mine = [r for r in rules if r.table == table]
    keyed = [r for r in mine if r.kind in _KEYED]
    notes = versions.read_current(spark, f"{state}/{table}/notes")
    listed = settle(_listed(spark, path), "quality_folders")
    seen = spark.createDataFrame([], _NOTES) if notes is None else notes
    fresh = [r["folder"] for r in listed.join(seen, [c.split()[0] for c in _NOTES.split(", ")], "left_anti").collect()]
    if fresh:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*fresh)
        rows = rows.withColumn("_part", _part(F.col("_metadata.file_path")))
        write_dataset(row_states(rows, mine), f"{state}/{table}/sums", ["_part"], replace="touched")
        if keyed:
            write_dataset(key_states(rows, keyed), f"{state}/{table}/keys", ["_part"], replace="touched")
    versions.publish(listed, f"{state}/{table}/notes")
    return len(fresh)


def _states(spark: SparkSession, table: str, state: str, kind: str, columns: str) -> DataFrame:
    """States of the folders that the last refresh listed; those of folders since dropped don't count."""
    path = f"{state}/{table}/{kind}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    live = versions.read_current(spark, f"{state}/{table}/notes").select(F.col("part").alias("_part")).distinct()
    return spark.read.schema(columns).parquet(path).join(live, "_part", "left_semi")


def merged(spark: SparkSession, rules: Sequence[Rule], parents: Mapping[str, DataFrame], state: str) -> DataFrame:
    """The scorecard of all tables as of their last refresh: what ``quality.scorecard`` gives for all rows.

    ``parents`` holds the tables that references point to; only their key column is read.
    """
    cards = []
    for table in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == table]
        keys = _states(spark, table, state, "keys", _KEYS)
        sums = _states(spark, table, state, "sums", _SUMS)
        totals = sums.groupBy("rule").agg(*(F.sum(n).alias(n) for n in ("violations", "undecided", "checked")))
        found = spark.createDataFrame([(r.name, table) for r in mine], "rule string, table_name string")
        card = found.join(F.broadcast(totals), "rule", "left")
        for r in (r for r in mine if r.kind in _KEYED):
            held = keys.filter(F.col("rule") == r.name).groupBy("key").agg(F.sum("rows").alias("rows"))
            if r.kind == "unique":
                lost = held.agg(F.sum(F.col("rows") - 1).alias("lost"))
            else:
                parent, parent_key = r.args
                known = parents[parent].select(F.col(parent_key).cast("string").alias("key"))
                lost = held.filter("key IS NOT NULL").join(known, "key", "left_anti").agg(F.sum("rows").alias("lost"))
            violations = F.when(F.col("rule") == r.name, lost.scalar()).otherwise(F.col("violations"))
            card = card.withColumn("violations", violations)
        cards.append(card.na.fill(0, ["violations", "undecided", "checked"]))
    return reduce(DataFrame.unionByName, cards).withColumn("passed", F.col("violations") == 0)
