"""The request log as segments: every batch is committed once, counted while it is written, and merged later.

A segment is a folder with the messages of a range of batches, split by status and event date. A batch writes its segment and
then, inside it, an empty marker whose name tells how many messages the write observed and how many of them are valid.
The marker is the commit: a segment without one is not read, and is written anew when its batch is repeated; a batch that has
one is not written again. ``compact`` merges neighbouring segments into one of their whole range; from its marker on the smaller
ones inside that range are superseded, so no reader misses a message or sees it twice. One listing of folder names tells all of
this: neither the running count nor the choice of folders opens a data file.

Ranges are aligned blocks of ``FAN_IN``, ``FAN_IN`` ** 2, ... batches up to ``LARGEST``, so a message is rewritten once a tier, and
a log of n batches has about n / ``LARGEST`` segments and fewer than ``FAN_IN`` more a tier.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .ingest import OK, SINK, stamp, valid_events

FAN_IN = 10
LARGEST = 1000
_DIGITS = 12


@dataclass(frozen=True)
class Segment:
    """The batches ``first`` to ``last``, and how many messages they have."""

    first: int
    last: int
    messages: int
    valid: int

    def place(self, log: str) -> str:
        return _place(log, self.first, self.last)


def _place(log: str, first: int, last: int) -> str:
    return f"{log.rstrip('/')}/segment={first:0{_DIGITS}d}-{last:0{_DIGITS}d}"


def _folder(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _committed(spark: SparkSession, log: str) -> list[Segment]:
    """Every segment with a marker, superseded ones too, by range; the larger first where two begin together."""
    files, place = _folder(spark, log)
    found = []
    for marker in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, "segment=*/_messages-*")) or []:
        path = marker.getPath()
        first, last = path.getParent().getName().split("=")[1].split("-")
        messages, valid = path.getName().split("-")[1:]
        found.append(Segment(int(first), int(last), int(messages), int(valid)))
    return sorted(found, key=lambda s: (s.first, -s.last))


def live_segments(spark: SparkSession, log: str) -> list[Segment]:
    """The segments that make up the log: those that lie in no other one. Blocks are aligned, so ranges nest or are apart."""
    live: list[Segment] = []
    for segment in _committed(spark, log):
        if not live or segment.first > live[-1].last:
            live.append(segment)
    return live


def _write(rows: DataFrame, log: str, segment: Segment) -> None:
    place = segment.place(log)
    rows.write.mode("overwrite").partitionBy("status", "event_date").parquet(place)


def _commit(spark: SparkSession, log: str, segment: Segment) -> None:
    files, place = _folder(spark, f"{segment.place(log)}/_messages-{segment.messages}-{segment.valid}")
    files.create(place, True).close()


def append_batch(rows: DataFrame, batch: int, log: str) -> None:
    """Write and commit one batch of stamped messages, unless an earlier attempt has.

    The observed counts are those of the job that writes the segment, so counting needs no second pass.
    """
    spark = rows.sparkSession
    if any(s.first <= batch <= s.last for s in _committed(spark, log)):
        return
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("status") == OK).alias("valid"))
    _write(counted, log, Segment(batch, batch, 0, 0))
    _commit(spark, log, Segment(batch, batch, seen.get["messages"], seen.get["valid"]))


def ingest_segments(messages: DataFrame, log: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append the stream to a log of segments; without ``interval``, what is available now.

    A log belongs to one checkpoint, as batch numbers are that checkpoint's: a new one beside an old log would take its batches for
    written, so it is refused.
    """
    spark = messages.sparkSession
    files, begun = _folder(spark, f"{checkpoint.rstrip('/')}/metadata")
    if not files.exists(begun) and _committed(spark, log):
        raise ValueError(f"{log} was written with another checkpoint than {checkpoint}")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stamp(messages).writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
        .foreachBatch(lambda rows, batch: append_batch(rows, batch, log)).start()
    )


def read_messages(spark: SparkSession, log: str) -> DataFrame:
    """All messages of the log, valid or not, as of this call."""
    return _read(spark, log, live_segments(spark, log))


def _read(spark: SparkSession, log: str, parts: list[Segment]) -> DataFrame:
    places = [segment.place(log) for segment in parts if segment.messages]
    if not places:
        return spark.createDataFrame([], SINK)
    return spark.read.schema(SINK).option("basePath", log).parquet(*places).select(*SINK.names)


def read_segments(spark: SparkSession, log: str, since: date | None = None) -> DataFrame:
    """The valid events, as ``read_log`` gives them of a plain log."""
    return valid_events(read_messages(spark, log), since)


def message_counts(spark: SparkSession, log: str) -> tuple[int, int]:
    """(messages, valid ones) over all runs and restarts, from the names of the markers."""
    live = live_segments(spark, log)
    return sum(s.messages for s in live), sum(s.valid for s in live)


def compact(spark: SparkSession, log: str, fan_in: int = FAN_IN, largest: int = LARGEST) -> None:
    """Merge complete blocks of segments, the largest blocks first, so that each message moves at most once.

    A block is complete when a batch of its end, or a later one, is committed: batches are committed in order. Folders that an earlier call
    superseded are deleted first; those superseded now stay until the next call, for readers that have listed them.
    A lost call leaves a folder without marker, which the next one writes anew. One call at a time; the stream may run meanwhile.
    """
    drop_superseded(spark, log)
    live = live_segments(spark, log)
    if not live:
        return
    sizes = [fan_in]
    while sizes[-1] * fan_in <= largest:
        sizes.append(sizes[-1] * fan_in)
    done = 0  # batches before this one lie in blocks that are settled
    for size in reversed(sizes):
        while done + size - 1 <= live[-1].last:
            inside = [s for s in live if done <= s.first and s.last < done + size]
            if len(inside) > 1:
                _merge(spark, log, inside, Segment(done, done + size - 1, sum(s.messages for s in inside), sum(s.valid for s in inside)))
            done += size


def _merge(spark: SparkSession, log: str, parts: list[Segment], whole: Segment) -> None:
    _write(_read(spark, log, parts).hint("rebalance", "status", "event_date"), log, whole)
    _commit(spark, log, whole)


def drop_superseded(spark: SparkSession, log: str) -> None:
    """Delete the segments that lie in a larger committed one."""
    live = set(live_segments(spark, log))
    for segment in _committed(spark, log):
        if segment not in live:
            files, place = _folder(spark, segment.place(log))
            files.delete(place, True)
