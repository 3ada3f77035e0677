"""The registered queries of this subpackage: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tissuemill.llm import alignment, centroids, decontaminate, langid, licenses, mixing, order_minhash, recompression, sharding, simhash, suffix_dedup, tokens, warc
from tissuemill.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``simhash.near_duplicates`` of whole ``documents``."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``decontaminate.leaks`` of whole ``documents`` against whole ``benchmark``."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``langid.identify`` of whole ``documents``."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``suffix_dedup.dedup`` of whole ``documents``."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mixing.mix`` of all ``documents`` by source."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    """``tokens.section_counts`` of the lines of whole ``documents``."""
    return tokens.section_counts(table(spark, sf_dir, "documents"), vocabulary)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``warc.round_trip`` of whole ``pages``."""
    return warc.round_trip(spark, sf_dir)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``recompression.dedup`` of whole ``documents``."""
    return recompression.dedup(table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_minhash.fingerprints`` of whole ``documents``."""
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``licenses.scan`` of whole ``documents``."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sharding.shard`` of whole ``documents`` into 24 shards."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``centroids.cluster`` over whole ``embeddings``."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str, a_file: str = "/opt/tokenizers/byte_bpe_50k.json", b_file: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    """``alignment.align`` over whole ``documents``."""
    return alignment.align(table(spark, sf_dir, "documents"), a_file, b_file)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_language_id": op3_language_id,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_mixing_sources": op5_mixing_sources,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_license_scans": op10_license_scans,
    "op11_sharding": op11_sharding,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}

ORACLES: dict[str, str] = {
    "op5_mixing_sources": mixing.ORACLE,
    "op10_license_scans": licenses.oracle(),
    "op11_sharding": sharding.ORACLE,
    "op12_centroid_clustering": centroids.oracle(),
}
