"""Exact distinct users that merge: a dictionary numbers the users, and bitmaps hold who was seen.

Users are dealt into hash buckets and numbered inside each, so a dictionary grows by appending and no task numbers all users. A
bitmap covers 32,768 neighbouring numbers of a bucket (4 KiB), per date and hour. Bitmaps of several batches, hours or days
merge by OR, so a day's distinct users come from its hours' bitmaps without the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 64
#: Numbers of one bucket; the bucket makes the upper part of a user's number.
_SPAN = 1 << 40


def new_users(logs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, bucket, place) of the users of ``logs`` that the dictionary ``known`` lacks; null is no user."""
    users = logs.where("user_id is not null").select("user_id").distinct()
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS))
    place = F.row_number().over(W.partitionBy("bucket").orderBy("user_id")).cast("long") - 1
    if known is None:
        return users.withColumn("bucket", bucket).withColumn("place", place)
    taken = known.groupBy("bucket").agg((F.max("place") + 1).alias("taken"))
    fresh = users.join(known.select("user_id"), "user_id", "left_anti").withColumn("bucket", bucket).withColumn("place", place)
    return fresh.join(taken, "bucket", "left").select("user_id", "bucket", (F.col("place") + F.coalesce("taken", F.lit(0))).alias("place"))


def hourly_bitmaps(logs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(request_date, request_hour, part, users): a bitmap of each part of the numbers that has users."""
    number = (F.col("bucket") * F.lit(_SPAN) + F.col("place")).alias("number")
    # each user once an hour before the join, so that a busy user is one row per hour and partition
    seen = logs.where("user_id is not null").select("request_date", "request_hour", "user_id").distinct()
    numbered = seen.join(dictionary, "user_id").select("request_date", "request_hour", number)
    return numbered.groupBy("request_date", "request_hour", F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def unique_users(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """(keys, unique_users): exact distinct users of any grouping of the bitmaps."""
    merged = bitmaps.groupBy(*keys, "part").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias("unique_users"))
