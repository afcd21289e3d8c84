"""Hourly activity kept up to date by the stream itself: event-time windows, a watermark and a state store.

State is one small row per open hour. In append mode an hour is written once, when the watermark has passed its end, and
a later event of it is dropped; its date folder then never changes. In complete mode all hours are written after every batch.
Additive columns equal those of ``mart_hourly_activity``; ``approx_users`` is a sketch, as exact distinct users
would need every user in state (``operators.distinct`` has them exactly, from the log).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import USD_SCALE, off_grid, to_units, total
from ..operators.staging import stg_llm_logs
from ..schemas import CONSUMED_LOG
from .ingest import OK, stamp

#: Relative standard deviation of ``approx_users``.
SKETCH_ERROR = 0.02


def _instant(column: str) -> Column:
    """A wall-clock time as the same time in UTC: watermarks need an instant, and no session zone may shift the hours."""
    time = F.col(column)
    fields = [F.year(time), F.month(time), F.dayofmonth(time), F.hour(time), F.minute(time), F.extract(F.lit("SECOND"), time)]
    return F.make_timestamp_ltz(*fields, F.lit("UTC"))


def hourly_activity(messages: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Activity per hour of request, of a stream of messages; events that come more than ``lateness`` late are dropped.

    Wall-clock times are windowed as they are. Events without a time belong to no hour; undecodable ones are left to the log's quarantine.
    """
    log = stamp(messages).where((F.col("status") == OK) & F.col("timestamp").isNotNull()).select(*CONSUMED_LOG.names)
    staged = stg_llm_logs(log).select(_instant("request_timestamp").alias("moment"), "user_id", "total_tokens", "cost_usd", "latency_ms")
    cost = F.col("cost_usd")
    hours = (
        staged.withWatermark("moment", lateness)
        .groupBy(F.window("moment", "1 hour"))
        .agg(
            F.count("*").alias("total_requests"),
            F.approx_count_distinct("user_id", SKETCH_ERROR).alias("approx_users"),
            F.sum("total_tokens").alias("total_tokens"),
            F.sum(to_units(cost, USD_SCALE)).alias("_units"), F.sum(off_grid(cost, USD_SCALE)).alias("_rest"),
            F.round(F.avg("latency_ms"), 0).alias("avg_latency_ms"),
        )
    )
    start = F.unix_seconds("window.start")
    return hours.select(
        F.date_from_unix_date(F.floor(start / 86_400).cast("int")).alias("request_date"),
        F.floor(start % 86_400 / 3_600).cast("int").alias("request_hour"), "total_requests", "approx_users", "total_tokens",
        total(F.col("_units"), F.col("_rest"), 4, USD_SCALE).alias("total_cost_usd"), "avg_latency_ms",
    )


def write_closed_hours(activity: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append every hour once it is closed, in date folders; without ``interval``, for what is available now."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        activity.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy("request_date").trigger(**trigger).start()
    )


def write_all_hours(activity: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Write all hours after every batch to a folder of the batch's own; a repeated batch writes its folder anew."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}

    def write(hours: DataFrame, batch: int) -> None:
        hours.write.mode("overwrite").parquet(f"{path}/batch={batch:012d}")

    return activity.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(write).start()


def read_all_hours(spark, path: str) -> DataFrame:
    """The hours as the last complete batch left them."""
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch")).first()[0]
    return batches.where(F.col("batch") == F.lit(last)).drop("batch")
