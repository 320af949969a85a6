"""The shared folder for intermediate tables.

A cluster names it in ``spark.checkpoint.dir``. Only where that is unset, as in tests on one
machine, a fresh local folder is taken and set as checkpoint folder.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of an execution at its end, where this is set as the execution begins.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_dropping: dict[int, list] = {}
_scopes = threading.local()


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cardlake-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/cardlake/{uuid.uuid4().hex}/{label}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage so that several later passes see the very same rows, survives the loss of
    executors, and later readers still get column pruning and filter pushdown.
    """
    path = fresh_path(df.sparkSession, label)
    if (noted := getattr(_scopes, "paths", None)) is not None:
        noted.append(path)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside leave no shuffle files: a write's plan is its own, so nothing reads them later.

    Otherwise they lie on the executors' disks until the driver happens to collect its garbage. The session's
    setting returns with the last open block, so tables that a caller evaluates are not concerned.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        state = _dropping.setdefault(session, [0, spark.conf.get(_CLEANUP, "false")])
        state[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                del _dropping[session]
                spark.conf.set(_CLEANUP, state[1])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread settles inside are deleted at the end: for work whose result is written elsewhere."""
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = mine = []
    try:
        yield
    finally:
        _scopes.paths = outer
        for path in mine:
            _delete(spark, path)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``settle`` wrote, with the one above it that was made for it alone."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
