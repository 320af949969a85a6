"""Curated Parquet datasets: writing, reading, catalogue tables, row metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardlake.operators.layout import narrow_first, quoted
from cardlake.sources.raw import path_exists
from cardlake.sources.shared import dropping_shuffles


#: Of stored tables: a quarter smaller than Spark's default on curated rows and facts.
COMPRESSION = "zstd"


def write_dataset(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace: str = "all",
    varying: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Overwrite a Parquet dataset and read it back.

    ``replace="all"`` replaces the whole dataset, ``"touched"`` only the partitions present in
    ``df``. Partitioned rows are rebalanced on the partition columns: adaptive execution merges
    small partition values and splits a heavy one over several tasks, so neither many tiny files
    nor one huge task results. They are shuffled with the ``varying`` texts last. ``finish`` adds what follows
    from the columns of the same row, after that shuffle; it must not change the partition columns.
    ``dealt`` says that the rows are read from folders of the same columns: each file holds one value of
    them already, so nothing is shuffled, and a task writes no more files than it reads.
    """
    if partition_by and not dealt:
        names = quoted(df.columns)
        df = narrow_first(df, varying).hint("rebalance", *(F.col(c) for c in partition_by)).select(*names)
    if finish:
        df = finish(df)
    scope = {"all": "static", "touched": "dynamic"}[replace]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", scope).option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        writer.parquet(path)
    return read_dataset(df.sparkSession, path, df)


def read_dataset(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a dataset; ``like`` gives the schema, so partition text such as ``09`` stays text."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path)


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (), **how) -> tuple:
    """Write and return ``(dataset, rows)``; rows are observed during the write itself.

    ``how`` goes to :func:`write_dataset`.
    """
    seen = Observation()
    written = write_dataset(df.observe(seen, F.count("*").alias("rows")), path, partition_by, **how)
    return written, seen.get["rows"]


def read_first(
    spark: SparkSession, curated_path: str, like: DataFrame | None, fallback
) -> DataFrame:
    """The curated dataset if it exists, else ``fallback()``."""
    if path_exists(spark, curated_path):
        return read_dataset(spark, curated_path, like)
    return fallback()


def load_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select by name into target columns (target → source); nested values become JSON text."""
    nested = {f.name for f in df.schema if f.dataType.typeName() in ("struct", "array", "map")}
    picked = (
        (F.to_json(src) if src in nested else F.col(src)).alias(dst)
        for dst, src in mapping.items()
    )
    return df.select(*picked)


def register_tables(spark: SparkSession, datasets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Register external tables and list their columns.

    ``datasets`` maps a table name to (format, path). Parquet footers are read and columns that only
    later files have are merged. CSV columns are those of one header; reading the table fails on a
    file with another one. An external table of the same name is replaced; a managed one, whose rows
    would be lost, is refused.
    """
    listings = []
    for name, (fmt, path) in datasets.items():
        reader = spark.read.option("header", True).option("mergeSchema", fmt == "parquet")
        found = reader.format(fmt).load(path)
        drop_external(spark, name)
        options = {"path": path, "header": "true", "mergeSchema": str(fmt == "parquet").lower()}
        if fmt == "csv":
            options["enforceSchema"] = "false"
        spark.catalog.createTable(name, source=fmt, schema=found.schema, **options)
        partitions = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
        if partitions:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        rows = [(name, f.name, f.dataType.simpleString(), i) for i, f in enumerate(found.schema, 1)]
        listing = spark.createDataFrame(
            rows, "table_name string, column_name string, column_type string, position int"
        )
        listings.append(listing)
    return reduce(DataFrame.unionByName, listings)


def drop_external(spark: SparkSession, name: str) -> None:
    """Forget an external table, whose files stay; refuse a managed one, whose rows would be lost."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"a managed table has this name: {name}")
        spark.sql(f"DROP TABLE {name}")


def union_versions(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack files or batches whose columns differ; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
