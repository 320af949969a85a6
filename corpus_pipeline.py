"""The corpus pipeline: stages run one after the other, each written as Parquet and read again.

Low-quality documents go, one document of each near-duplicate group stays, repeated passages are cut,
and what is left is packed into sequences. No stage drops a row for any other reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlake.llm import neardup, packing, quality, substrings
from cardlake.llm.common import read, settle, ship_code
from cardlake.llm.queries import tokenizer

#: Packing has no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with the columns they came with."""
    ship_code(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group (five-word shingles, likeness 0.8 or more)."""
    ship_code(spark)
    return neardup.keep_first(docs, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a smaller doc_id has as well are cut from the text."""
    ship_code(spark)
    return substrings.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    ship_code(spark)
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", first_of_near_duplicates),
    ("substrings", without_repeats),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
