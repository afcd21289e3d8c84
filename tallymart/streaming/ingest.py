"""Continuous ingestion of request events into the append-only log.

One query parses, stamps and appends. The checkpoint holds the source progress and the file sink
records each batch once, so a restarted query neither loses nor repeats an event.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from ..schemas import CONSUMED_LOG, REQUEST_LOG
from ..sources.events import decode_events
from ..sources.tables import Warehouse

OK, QUARANTINE = "ok", "quarantine"

SINK = StructType(
    CONSUMED_LOG.fields
    + [
        StructField("source", StringType()),
        StructField("source_partition", IntegerType()),
        StructField("source_offset", LongType()),
        StructField("rejected_value", StringType()),
        StructField("status", StringType()),
        StructField("event_date", DateType()),
    ]
)


def stamp(messages: DataFrame) -> DataFrame:
    """Decoded events with their ingestion time and origin; undecodable text is kept for inspection."""
    valid = F.col("is_valid")
    return decode_events(messages).select(
        *REQUEST_LOG.names,
        F.current_timestamp().cast("timestamp_ntz").alias("consumed_at"),
        "source",
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.when(~valid, F.col("value")).alias("rejected_value"),
        F.when(valid, OK).otherwise(QUARANTINE).alias("status"),
        F.when(valid, F.to_date("timestamp")).alias("event_date"),
    )


def ingest(messages: DataFrame, log: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append the stream to the log folder.

    Without ``interval`` everything available now is ingested and the query stops; with one (such
    as ``"30 seconds"``) it keeps running. The folder is split by status and event date, so readers
    of valid events or of recent days open only those files.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stamp(messages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .partitionBy("status", "event_date")
        .trigger(**trigger)
        .start()
    )


def once_per_offset(messages: DataFrame, moment: str, within: str = "1 day") -> DataFrame:
    """The stream without messages that were delivered again: each (source, partition, offset) passes once.

    Places are remembered in the state store until ``moment``, the time the broker appended a message, is ``within`` behind the
    newest one, so state is bounded by the traffic of that time. The same place has the same ``moment`` in every delivery.
    """
    return messages.withWatermark(moment, within).dropDuplicatesWithinWatermark(["source", "partition", "offset"])


def declare_log(warehouse: Warehouse, log: str, domain: str = "requests", table: str = "llm_logs_kafka") -> str:
    """Give the log folder a name in the catalog: a view of its valid events, with their partition and offset.

    A view over the folder sees the batches that the sink has committed and no files of a lost one, and new batches need no
    registration. The folder must hold a batch.
    """
    name = warehouse.name(f"raw_{domain}", table)
    columns = ", ".join(f"`{c}`" for c in [*CONSUMED_LOG.names, "source", "source_partition", "source_offset", "event_date"])
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{log}` WHERE status = '{OK}'")
    return name


def messages_processed(spark: SparkSession, log: str) -> int:
    """Messages that a log holds, valid or in quarantine, over all runs and restarts."""
    return spark.read.schema(SINK).parquet(log).count()


def valid_events(rows: DataFrame, since: date | None = None) -> DataFrame:
    """The valid events among a log's rows, from ``since`` on if given, and those without a date."""
    rows = rows.filter(F.col("status") == OK)
    if since:
        rows = rows.filter((F.col("event_date") >= F.lit(since)) | F.col("event_date").isNull())
    return rows.select(*CONSUMED_LOG.names)


def read_log(spark: SparkSession, log: str, since: date | None = None) -> DataFrame:
    """The valid events, from ``since`` on if given, and those without a date: the log that staging reads.

    Both conditions are on folder columns, so other folders are not opened.
    """
    return valid_events(spark.read.schema(SINK).parquet(log), since)


def read_quarantine(spark: SparkSession, log: str) -> DataFrame:
    rejected = spark.read.schema(SINK).parquet(log).filter(F.col("status") == QUARANTINE)
    return rejected.select("rejected_value", "consumed_at", "source", "source_partition", "source_offset")
