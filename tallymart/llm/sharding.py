"""Stable shards by jump consistent hashing, with gapless slots inside each shard.

A 64-bit hash of the key walks the jump sequence; no ring or table is kept. Going from n to n + 1
shards moves one key in n + 1, always into the new shard.

Edge cases: a null key hashes like any other key, so all null keys share a shard. Rows that repeat a
key share its shard and get different slots. Columns named like a result column are replaced. An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbering works on this many hash buckets per shard, each a group of its own.
SLOT_BUCKETS = 2048


def jump(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit hash by the jump sequence."""
    key = hashes.astype(np.uint64)
    shard = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = ahead[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        divisor = (key[live] >> np.uint64(33)).astype(np.float64) + 1
        ahead[live] = ((shard[live] + 1) * (float(1 << 31) / divisor)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard.astype(np.int32)


def shard_of(hashed, shards: int):
    """Column expression for the shard of a 64-bit hash column."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def by_jump(values: pd.Series) -> pd.Series:
        return pd.Series(jump(values.to_numpy(np.int64).view(np.uint64), shards))

    return by_jump(hashed)


def assign(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard``, the shard of the same row once one more shard exists."""
    hashed = F.xxhash64(F.col(key))
    return df.withColumns({"shard": shard_of(hashed, shards), "grown_shard": shard_of(hashed, shards + 1)})


def with_slots(df: DataFrame, order: list[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each shard from 0 without a gap: add ``slot``.

    Rows go to hash buckets of ``order``, a full order up to identical rows; buckets are counted, the
    counts summed up within each shard, and each bucket numbers its own rows from its offset. No task
    holds a shard: the largest group is one bucket, and only counts are summed in one place.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name != "slot"]
    keyed = df.select(F.struct(*kept).alias("row"), F.col("shard").alias("of"), F.struct(*order).alias("at"))
    return _numbered(keyed, buckets).select("row.*", "slot")


def _numbered(keyed: DataFrame, buckets: int) -> DataFrame:
    """Add ``slot`` to rows of (row, of, at), ``at`` being the order inside the shard ``of``."""
    bucketed = keyed.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(buckets)).cast("int"))
    before = W.partitionBy("of").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("of", "bucket").agg(F.count("*").alias("n"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    place = F.row_number().over(W.partitionBy("of", "bucket").orderBy("at")) - 1
    return bucketed.withColumn("place", place).join(offsets, ["of", "bucket"]).withColumn("slot", F.col("offset") + F.col("place"))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard``, ``grown_shard`` and ``slot``; order inside a shard follows key and text."""
    hashed = F.xxhash64(F.col(f"`{key}`"))
    own = [F.col(f"`{name}`") for name in docs.columns if name not in ("shard", "grown_shard", "slot")]
    placed = docs.select(
        F.struct(*own, shard_of(hashed, shards).alias("shard"), shard_of(hashed, shards + 1).alias("grown_shard")).alias("row"),
        F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64("text").alias("text_hash")).alias("at"),
    )
    return _numbered(placed.select("row", F.col("row.shard").alias("of"), "at"), SLOT_BUCKETS).select("row.*", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    (
        sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )


def digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per document: size, checksum, shard, slot and the shard after growth, without carrying the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    small = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return with_slots(assign(small, "doc_id", shards), ["doc_id", "text_crc32", "size"])
