"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

All stages but the last return the columns of ``documents``; the last adds the place of each document in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tissuemill.llm import decontaminate, langid, mixing, simhash, suffix_dedup
from tissuemill.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go. Profiles are learned from the stage's own input."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash blocks; five-word shingles, similarity 0.8 or more), the document with the smallest doc_id."""
    return simhash.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 100-byte strings that start earlier in the corpus."""
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no part of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their block, slot and position in the mixture of sources."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", language_id),
    ("near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
]

#: Language profiles, suffix arrays and alignments have no SQL form; a brute-force version checks them in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each keeps is written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
