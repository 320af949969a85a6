"""The registered queries of this folder: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm import (
    ann, audit, expected, fingerprints, lm, neardup, packing, quality, resampling, secret_scan, sharding, spiece,
    substrings, suffixes,
)
from cardlake.llm.common import read


def tokenizer(name: str) -> str:
    """Where a public tokenizer lies; queries pass the path on as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pruned_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, top=5)


def op2_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents"))


def op7_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_words(read(spark, sf_dir, "documents"), window=50)


def op8_setsketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"), window=100, with_bytes=False)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spiece.encode_documents(
        read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), with_ids=False
    )


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read(spark, sf_dir, "documents"))


def op6_minimum_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.divergence(read(spark, sf_dir, "documents"), least_docs=30, top=50)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5, least_words=20
    )


def op13_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pruned_graph_ann": op1_pruned_graph_ann,
    "op2_syncmer_fingerprints": op2_syncmer_fingerprints,
    "op3_bwt_merge_dedup": op3_bwt_merge_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_minimum_slack_packing": op6_minimum_slack_packing,
    "op7_countmin_substrings": op7_countmin_substrings,
    "op8_setsketch_neardup": op8_setsketch_neardup,
    "op9_minimax_shards": op9_minimax_shards,
    "op10_fourier_quality": op10_fourier_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_crf_secrets": op13_crf_secrets,
}
ORACLE: dict[str, str] = {
    "op3_bwt_merge_dedup": expected.BYTES_SQL,
    "op7_countmin_substrings": expected.SUBSTRINGS_SQL,
    "op8_setsketch_neardup": expected.NEAR_DUPLICATES_SQL,
    "op11_source_divergence": audit.DIVERGENCE_SQL,
}
