"""The corpus pipeline: each stage reads what the one before it has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvec.llm.block_names import drop_copies
from flowvec.llm.common import wide_rows, write_table
from flowvec.llm.deobfuscation import mask_personal
from flowvec.llm.divergence_rules import keep_good
from flowvec.llm.retrieval_packing import retrieval_pack
from flowvec.llm.trie_join import drop_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    wide_rows(spark)
    return keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words, similarity 0.8 or more."""
    wide_rows(spark)
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked by the name of their kind."""
    wide_rows(spark)
    return mask_personal(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of related documents: one row per piece."""
    wide_rows(spark)
    return retrieval_pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Hashing and packing with a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
