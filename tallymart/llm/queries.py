"""Registered queries of the text operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (balltree, decontamination, fim, jaccard, mixing, quality, recompression, sharding, suffixdedup, tokencount, urlfilter,
               vectorcodes, warc)
from ..session import scratch_dir
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_to_weights(spark: SparkSession, path: str) -> DataFrame:
    return mixing.digest(table(spark, path, "documents"))


def op2_decontaminate(spark: SparkSession, path: str) -> DataFrame:
    return decontamination.digest(table(spark, path, "documents"), table(spark, path, "benchmark"))


def op3_warc_revisits(spark: SparkSession, path: str) -> DataFrame:
    return warc.digest(warc.deduplicate(table(spark, path, "pages"), scratch_dir(spark, "warc")))


def op4_quality_ledger(spark: SparkSession, path: str) -> DataFrame:
    return quality.digest(table(spark, path, "documents"))


def op5_url_filter(spark: SparkSession, path: str) -> DataFrame:
    return urlfilter.digest(spark, path)


def op6_token_counts(spark: SparkSession, path: str) -> DataFrame:
    return tokencount.token_counts(table(spark, path, "documents"), tokencount.vocabulary(spark))


def op7_jaccard_join(spark: SparkSession, path: str) -> DataFrame:
    return jaccard.digest(table(spark, path, "documents"))


def op8_jump_shards(spark: SparkSession, path: str) -> DataFrame:
    return sharding.digest(table(spark, path, "documents"))


def op9_suffix_dedup(spark: SparkSession, path: str) -> DataFrame:
    return suffixdedup.digest(table(spark, path, "documents"))


def op10_recompression(spark: SparkSession, path: str) -> DataFrame:
    return recompression.digest(table(spark, path, "documents"))


def op11_vector_codes(spark: SparkSession, path: str) -> DataFrame:
    return vectorcodes.digest(table(spark, path, "embeddings"))


def op12_ball_tree_search(spark: SparkSession, path: str) -> DataFrame:
    return balltree.digest(table(spark, path, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, path: str) -> DataFrame:
    return fim.digest(table(spark, path, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_mix_to_weights, op2_decontaminate, op3_warc_revisits, op4_quality_ledger, op5_url_filter, op6_token_counts, op7_jaccard_join, op8_jump_shards,
        op9_suffix_dedup, op10_recompression, op11_vector_codes, op12_ball_tree_search, op13_fill_in_middle,
    )
}
ORACLE: dict[str, str] = {
    "op2_decontaminate": decontamination.SQL,
    "op3_warc_revisits": warc.SQL,
    "op4_quality_ledger": quality.SQL,
    "op5_url_filter": urlfilter.SQL,
    "op7_jaccard_join": jaccard.SQL,
    "op10_recompression": recompression.SQL,
    "op11_vector_codes": vectorcodes.SQL,
    "op12_ball_tree_search": balltree.SQL,
    "op13_fill_in_middle": fim.SQL,
}
