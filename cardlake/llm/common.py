"""Helpers that several operators of this folder share."""

from __future__ import annotations

import gc
import hashlib
import math
import tempfile
import time
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.operators.keys import dense_key
from cardlake.sources.shared import settle

__all__ = [
    "byte_hashes", "collapse_sorted", "dense_key", "documents", "forget", "mix64", "null_id", "read",
    "real_id", "running_totals", "settle", "ship_code", "tasks_for", "word_hashes", "word_spans",
]

_NULL_ID = -(1 << 63)
_POSITION_BITS = (1 << 33) - 1
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15


def forget(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more, and let Spark drop finished shuffles.

    Only folders below the shared one that ``settle`` made are deleted.
    """
    spark = tables[0].sparkSession
    jvm = spark.sparkContext._jvm
    for table in tables:
        folders = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
        for folder in folders:
            if "/cardlake/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):  # Spark removes shuffle files once nothing refers to them, here or in the JVM
        gc.collect()
        jvm.System.gc()
        time.sleep(0.5)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="cardlake-code-")) / "cardlake_code.zip"
    with zipfile.ZipFile(name, "w") as target:
        for source in package.rglob("*.py"):
            target.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(name))
    _shipped.add(application)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns can't clash, a null text is an empty one."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def null_id(column: str | Column) -> Column:
    """A document id that joins and sorts with plain equality; null becomes the smallest number."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(_NULL_ID))


def real_id(column: str | Column) -> Column:
    """The reverse of ``null_id``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != _NULL_ID, c)


def tasks_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Enough tasks to hold ``rows_each`` rows each, and at least one for each core's share."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_each), 1)


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums in the given order, without a one-partition window.

    Rows are range-partitioned and settled; each partition sums on its own and starts from the sum
    of those before it. That table of starts has one row per partition.
    """
    ranged = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            *(c.cast("bigint").alias(f"_v_{n}") for n, c in totals.items()),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(_POSITION_BITS).alias("_pos"),
        ),
        "ranged_totals",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals))
        .select(
            "_part", *(F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in totals)
        )
    )
    inside = (
        Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = ranged.select(
        *df.columns, "_part", *(F.sum(f"_v_{n}").over(inside).alias(f"_i_{n}") for n in totals)
    )
    return summed.join(F.broadcast(starts), "_part").select(
        *df.columns, *((F.col(f"_i_{n}") + F.col(f"_b_{n}")).alias(n) for n in totals)
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _MIX_1
        x = (x ^ (x >> np.uint64(33))) * _MIX_2
        return x ^ (x >> np.uint64(33))


#: What each byte value counts in a sum over places.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least n of them."""
    if _powers.get("n", 0) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.ones(size, dtype=np.uint64)
            step, have = base, 1
            while have < size:
                table[have : 2 * have] = table[:have] * np.uint64(step)
                step, have = step * step % (1 << 64), 2 * have
            _powers[name] = table
        _powers["n"] = size
    return _powers["up"], _powers["down"]


#: The first k bytes of a little-endian word.
_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_LONG = 64


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end]; equal strings hash alike anywhere.

    Eight bytes at a time enter a scrambled state that starts from the length, so strings of up to eight
    bytes and one length never collide. Strings of over 64 bytes are hashed by BLAKE2b. A sum of powers
    would not do here: modulo 2**64 it gives some different strings, as the two halves of a long
    Thue-Morse sequence, one hash.
    """
    lengths = ends - starts
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    with np.errstate(over="ignore"):
        hashes = mix64(lengths.astype(np.uint64) * np.uint64(_BASE))
        hashes = mix64(hashes ^ (eight[starts] & _HEAD[np.minimum(lengths, 8)]))
        more, at = np.flatnonzero(lengths > 8), 8
        while len(more) and at < _LONG:
            part = eight[starts[more] + at] & _HEAD[np.minimum(lengths[more] - at, 8)]
            hashes[more] = mix64(hashes[more] * np.uint64(_BASE) ^ part)
            at += 8
            more = more[lengths[more] > at]
    for i in more.tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without bytes 0x20 and 0x09 to 0x0D)."""
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(text: str | None, lower: bool) -> np.ndarray:
    """One 64-bit hash per word; ``lower`` folds A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw.lower() if lower else raw, dtype=np.uint8)
    starts, ends = word_spans(data)
    return byte_hashes(data, starts, ends)


def collapse_sorted(keys: np.ndarray, counts: np.ndarray | None = None):
    """Distinct keys in order, with how often (or how much) each came."""
    if counts is None:
        keys = np.sort(keys)
        counts = None
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)
