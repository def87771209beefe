"""Documents to packed training sequences: classify, deduplicate, decontaminate, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberlog.llm import decontaminate, packing, paragraphs, quality_mil, simhash


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on ``docs`` and the labels, does not reject."""
    return quality_mil.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return simhash.keep_one(docs)


def repeats_cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated paragraphs cut out of the texts, all rows kept."""
    return paragraphs.without_repeats(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("substring_dedup", repeats_cut),
    ("benchmark_decontamination", no_benchmark),
    ("packing", packed),
]

#: Tokenizers and a trained model are not SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each on what the one before has written."""
    from emberlog.llm.work import written

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
