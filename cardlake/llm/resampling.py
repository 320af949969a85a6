"""Drawing the documents that look most like a target, by importance weights of hashed n-grams.

Each task works on Arrow columns: ``ascii_lower``, ``split_pattern_regex`` and ``list_flatten`` give the
words of a slice of texts, ``dictionary_encode`` numbers them. Shifted against each other, the numbers
form pairs and triples; these are numbered again, and only distinct ones get a CRC, which carries on from
that of the shorter run. ``take`` spreads the values over the texts, and differences of running sums
reduce them by text.

The counts of all buckets cover every row of both tables. They are a table of ``BUCKETS`` rows whatever
the input, so they may be collected and handed to the tasks.

Cases. A null text has no words, no features and weight 0. Words and texts of any length are taken
whole. Each row counts, repeated ones too; rows of equal score and doc_id share no rank: they are ordered
by weight and features, and rows equal in all of these take the next ranks in any order, which can't be
told apart. A null doc_id is hashed as '42:' and comes first among ties. An empty table gives no rows; an
empty target has counts of 0. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.columns import slices
from cardlake.llm.common import dense_key, settle

BUCKETS = 10_000
#: Text bytes whose n-grams are numbered at once.
SLICE_BYTES = 4 << 20
#: Between words: all of ASCII but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and for each key which of them it is."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


def _crcs(words: list[bytes], which: np.ndarray, so_far: np.ndarray) -> np.ndarray:
    carried = zip(which.tolist(), so_far.tolist())
    return np.fromiter((crc32(words[w], c) for w, c in carried), dtype=np.int64, count=len(which))


class Features:
    """Buckets of the runs of one to three words of some texts.

    ``levels`` holds for each length of run: the buckets of its distinct runs, for each run which of them
    it is, and the place of its first word.
    """

    def __init__(self, texts: pa.Array):
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        split = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN)
        words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
        real = pc.greater(pc.binary_length(words), 0)
        coded = words.filter(real).dictionary_encode()
        self.owner = owner.filter(real).to_numpy()
        self.texts = len(texts)
        number = coded.indices.to_numpy().astype(np.int64)
        vocabulary = coded.dictionary.cast(pa.binary()).to_pylist()
        crc = np.fromiter((crc32(w) for w in vocabulary), dtype=np.int64, count=len(vocabulary))
        self.levels = [(crc % BUCKETS, number, np.arange(len(number)))]
        after = [b" " + w for w in vocabulary]
        place, run = np.arange(len(number)), number
        for length in (2, 3):
            whole = place + length - 1 < len(number)
            place, run = place[whole], run[whole]
            whole = self.owner[place] == self.owner[place + length - 1]
            place, run = place[whole], run[whole]
            base = np.int64(max(1, len(vocabulary)))
            keys, run = _numbered(run.astype(np.int64) * base + number[place + length - 1])
            crc = _crcs(after, keys % base, crc[keys // base])
            self.levels.append((crc % BUCKETS, run, place))

    def words(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.owner, minlength=self.texts)

    def counts(self) -> np.ndarray:
        """Features in each bucket."""
        total = np.zeros(BUCKETS, dtype=np.int64)
        for bucket, run, _ in self.levels:
            np.add.at(total, bucket, np.bincount(run, minlength=len(bucket)))
        return total

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """The sum of the gains of each text's features."""
        each = np.zeros(len(self.owner), dtype=np.int64)
        for bucket, run, place in self.levels:
            each[place] += gains[bucket].take(run)
        running = np.concatenate(([0], np.cumsum(each)))
        ends = np.cumsum(self.words())
        return running[ends] - running[ends - self.words()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each bucket that the rows of a task have features in."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for part in slices(batches, "text", SLICE_BYTES):
        total += Features(part.column(0)).counts()
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all rows in each bucket: a table of at most BUCKETS rows."""
    counted = (
        texts.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_count, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    total = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.collect():
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(everywhere: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / share everywhere)) with one count added to each bucket."""
    above = (target + 1.0) * (everywhere.sum() + float(BUCKETS))
    below = (everywhere + 1.0) * (target.sum() + float(BUCKETS))
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def _weigh(gains: np.ndarray) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            found = Features(part.column(1))
            words = found.words().astype(np.int64)
            features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words), pa.array(features), pa.array(found.weights(gains))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weigh


def _noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit("42:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; rank is null where it isn't drawn.

    Ranks come from ranges of scores, numbered range by range; no task holds all rows.
    """
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    weighed = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_weigh(gains), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
        .withColumn("score", F.col("weight") + _noise(F.col("doc_id")))
    )
    weighed = settle(weighed, "importance")
    eligible = F.col("n_words") >= least_words
    drawn = weighed.filter(eligible).count() * percent // 100
    order = [
        eligible.desc(), F.desc("score"), F.col("doc_id").asc_nulls_first(), F.desc("weight"), F.desc("n_features"),
    ]
    placed = dense_key(weighed, order, "place")
    return placed.select(
        "doc_id",
        "n_features",
        "weight",
        "score",
        F.when(eligible & (F.col("place") <= drawn), F.col("place")).alias("rank"),
    )
