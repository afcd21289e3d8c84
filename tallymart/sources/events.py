"""Request events as keyed JSON: encoding, decoding with quarantine, and the Kafka connector options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EVENT_TOPIC
from ..schemas import CORRUPT_FIELD, EVENT_JSON, REQUEST_LOG

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode_events(log: DataFrame, keyed: bool = True) -> DataFrame:
    """Events as (key, value): the user id, and all columns as a JSON object.

    Without a key the sink spreads events over all topic partitions, which also avoids one
    overloaded partition when a single user sends a large share of them.
    """
    fields = [
        F.date_format(name, ISO_MICROS).alias(name) if name == "timestamp" else F.col(name)
        for name in log.columns
    ]
    key = F.col("user_id") if keyed else F.lit(None).cast("string")
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return log.select(key.alias("key"), value.alias("value"))


def decode_events(messages: DataFrame) -> DataFrame:
    """Parse ``value``; adds the event fields and ``is_valid``, keeps all other columns.

    Valid means: JSON of the declared types, every required field present (a present NULL is a
    value), numbers finite, and a readable timestamp. Fields beyond the schema, such as routing details, drop out.
    """
    text = F.col("value").cast("string")
    carried = [name for name in messages.columns if name != "value"]
    parsed = messages.select(
        *carried,
        text.alias("value"),
        F.from_json(text, EVENT_JSON, {"columnNameOfCorruptRecord": CORRUPT_FIELD}).alias("_event"),
    )
    event = {name: F.col(f"_event.{name}") for name in REQUEST_LOG.names}
    required = F.array(*[F.lit(name) for name in REQUEST_LOG.names])
    moment = event["timestamp"].try_cast("timestamp_ntz")
    complete = F.greatest(*[value.isNull() for value in event.values()]) == F.lit(False)
    keys_present = F.size(F.array_except(required, F.json_object_keys("value"))) == 0
    readable = moment.isNotNull() | event["timestamp"].isNull()
    finite = F.coalesce(F.abs(event["cost_usd"]) < F.lit(float("inf")), F.lit(True))
    # the second look at the text is only taken for events with a NULL field
    valid = F.col(f"_event.{CORRUPT_FIELD}").isNull() & F.when(complete, True).otherwise(keys_present) & readable & finite
    return parsed.select(
        *carried,
        "value",
        moment.alias("timestamp"),
        *[event[name].alias(name) for name in REQUEST_LOG.names if name != "timestamp"],
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
    )


def usage_tokens(body: Column, field: str) -> Column:
    """A token counter of a JSON response body; an absent, null or unreadable counter is 0."""
    return F.coalesce(F.get_json_object(body, f"$.{field}").try_cast("int"), F.lit(0))


# --- connectors -------------------------------------------------------------------


def kafka_source(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, **options: str) -> DataFrame:
    """Streaming messages of a topic from its earliest offset: value, source, partition, offset.

    Needs the Kafka connector package on the class path. Progress lives in the query's checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return reader.options(**options).load().select(
        F.col("value").cast("string").alias("value"), F.col("topic").alias("source"), "partition", "offset"
    )


def kafka_sink(events: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> None:
    """Write encoded events to a topic in one distributed batch."""
    events.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def file_source(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Streaming messages of a landing directory, one JSON event per line."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("source"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("long").alias("offset"),
    )


def write_events(events: DataFrame, path: str) -> None:
    """Append encoded events to a landing directory, one JSON object per line."""
    events.select("value").write.mode("append").text(path)
