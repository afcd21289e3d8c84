"""A training corpus from raw documents: quality, near copies, benchmark leaks, mixture, shards.

Each stage gets all rows that its predecessor kept. ``run`` writes every stage as Parquet below the shared
scratch folder and reads it back, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import decontamination, jaccard, mixing, quality, sharding
from tallymart.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy v1 rejects."""
    return quality.kept_documents(docs, quality.POLICIES["v1"])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; weights and share as in the mixing query."""
    return mixing.mixed(docs, mixing.repeating_weights((5, 2, 1)))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard, shard after growth, and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Mixing and jump hashing have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
