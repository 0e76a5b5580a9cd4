"""From documents to tokens: the stages in order, each one's output written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspan.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from tallyspan.llm.common import kept, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose SimHash fingerprints connect, the one with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes or more that stand earlier are cut out of the texts."""
    return suffix_dedup.dedup(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly, go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the digests of each text's tokens and of the text they decode to."""
    return bpe.encoded_digests(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeats),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

# SQL has no suffix arrays, fingerprints or tokenizer: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir))
    return docs
