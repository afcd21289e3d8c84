"""The request log as segments: commits, replays, compaction, counts."""

import glob
import json
import shutil
from datetime import date

import pytest
from conftest import SMALL
from test_sources import event

from tallymart.plans import registry
from tallymart.plans.registry import QUERIES
from tallymart.session import scratch_dir
from tallymart.sources import adapters, events
from tallymart.streaming import segments

BATCHES = 14


def send(base, *numbers):
    (base / "landing").mkdir(exist_ok=True)
    for i in numbers:
        rows = [json.dumps(event(user_id=f"u{i}", timestamp=f"2024-01-{1 + i % 3:02d}T00:00:00")), "broken" if i % 5 == 0 else json.dumps(event())]
        (base / "landing" / f"{i:04d}.json").write_text("\n".join(rows))


def run(spark, base):
    source = events.file_source(spark, f"{base}/landing", max_files=1)
    segments.ingest_segments(source, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return f"{base}/log"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    send(base, *range(BATCHES))
    return run(spark, base)


@pytest.fixture
def log(written, tmp_path):
    return str(shutil.copytree(written, tmp_path / "log"))


def users(spark, log):
    return sorted((r.user_id, str(r.timestamp)) for r in segments.read_segments(spark, log).collect())


def test_batches_are_counted_without_reading(spark, log):
    assert segments.message_counts(spark, log) == (2 * BATCHES, 2 * BATCHES - 3)
    assert segments.read_messages(spark, log).count() == 2 * BATCHES
    assert [(s.first, s.last) for s in segments.live_segments(spark, log)] == [(i, i) for i in range(BATCHES)]


def test_compaction_keeps_every_message_and_bounds_the_folders(spark, log):
    before = users(spark, log)
    segments.compact(spark, log, fan_in=3, largest=9)
    assert [(s.first, s.last) for s in segments.live_segments(spark, log)] == [(0, 8), (9, 11), (12, 12), (13, 13)]
    assert users(spark, log) == before
    assert segments.message_counts(spark, log) == (2 * BATCHES, 2 * BATCHES - 3)
    # superseded folders stay for readers that listed them, until the next call
    assert len(segments._committed(spark, log)) == 4 + 12
    segments.compact(spark, log, fan_in=3, largest=9)
    assert len(segments._committed(spark, log)) == 4
    assert users(spark, log) == before


def test_a_lost_commit_replays_the_batch_once(spark, tmp_path):
    """The batch is written and committed, the checkpoint is not: before and after the batch was merged into a larger segment."""
    send(tmp_path, *range(4))
    log = run(spark, tmp_path)
    before = users(spark, log)
    for merged in (False, True):
        if merged:
            segments.compact(spark, log, fan_in=2, largest=2)
        for file in (tmp_path / "checkpoint" / "commits").glob("*3*"):
            file.unlink()
        run(spark, tmp_path)
        assert users(spark, log) == before and segments.message_counts(spark, log) == (8, 7)


def test_a_half_written_segment_is_not_read(spark, log, tmp_path):
    segments.compact(spark, log, fan_in=7, largest=7)
    whole = users(spark, log)
    half = segments._place(log, 0, 13)
    shutil.copytree(segments._place(log, 0, 6), half)
    for marker in (tmp_path / "log").glob("segment=*-000000000013/*_messages-*"):
        if marker.parent.name == half.rsplit("/", 1)[1]:
            marker.unlink()
    assert users(spark, log) == whole
    segments.compact(spark, log, fan_in=14, largest=14)
    assert [(s.first, s.last) for s in segments.live_segments(spark, log)] == [(0, 13)]
    assert users(spark, log) == whole


def test_the_stream_goes_on_after_compaction_and_counts_past_the_progress_buffer(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        send(tmp_path, *range(5))
        log = run(spark, tmp_path)
        segments.compact(spark, log, fan_in=2, largest=4)
        send(tmp_path, *range(5, 9))
        run(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert segments.message_counts(spark, log)[0] == 18 == segments.read_messages(spark, log).count()


def test_a_new_checkpoint_beside_an_old_log_is_refused(spark, log, tmp_path):
    send(tmp_path, 0)
    with pytest.raises(ValueError, match="another checkpoint"):
        segments.ingest_segments(events.file_source(spark, f"{tmp_path}/landing"), log, f"{tmp_path}/other")


def test_recent_dates_open_only_their_folders(spark, log):
    segments.compact(spark, log, fan_in=7, largest=7)
    recent = segments.read_segments(spark, log, date(2024, 1, 3))
    assert {r.timestamp.day for r in recent.collect()} <= {3} and recent.count() == 4
    assert "event_date" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_an_empty_log(spark, tmp_path):
    log = f"{tmp_path}/nothing"
    segments.compact(spark, log)
    assert segments.message_counts(spark, log) == (0, 0) and segments.read_segments(spark, log).count() == 0


@pytest.mark.parametrize("name", ["stream_log_table", "stream_hourly_activity", "stream_message_count"])
def test_landing_files_grow_with_the_log(spark, monkeypatch, name):
    """No file holds a fixed share of the log, and the stream still takes them in several batches."""
    log = adapters.llm_logs_kafka(spark, SMALL).count()
    monkeypatch.setattr(registry, "FILE_MESSAGES", 50)
    folder, seen = [], []

    def kept(session, label):
        folder.append(scratch_dir(session, label))
        return folder[-1]

    monkeypatch.setattr(registry, "scratch_dir", kept)
    query = QUERIES[name](spark, SMALL)
    rows = query.collect()
    landed = glob.glob(f"{folder[0]}/landing/part-*")
    for place in landed:
        read = spark.read.parquet if place.endswith(".parquet") else spark.read.text
        seen.append(read(place).count())
    assert max(seen) < log / 4 and len(landed) >= log // 50
    assert 3 <= len(glob.glob(f"{folder[0]}/checkpoint/commits/[0-9]*")) <= 12
    monkeypatch.undo()
    assert sorted(map(str, rows)) == sorted(map(str, QUERIES[name](spark, SMALL).collect()))


def test_files_and_batches_are_bounded():
    assert registry.landing_files(0, 3) == (3, 1) and registry.landing_files(100_000, 2) == (2, 1)
    assert registry.landing_files(6_000_000, 2) == (60, 30)
    assert registry.landing_files(36_000_000, 3) == (360, registry.BATCH_FILES)


def test_trailing_days_reach_the_scan(spark):
    found = QUERIES["weather_city_7d"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in found.split("\n") if "FileScan parquet" in line]
    assert any(">= Subquery" in line and "DataFilters: [isnotnull(ts" in line for line in scans)
    assert any(line.endswith("ReadSchema: struct<ts:timestamp_ntz>") for line in scans)


def test_order_lines_move_once_per_lookup(spark):
    """Without broadcasts the lines are shuffled by product and by order, never by customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES["order_line_enrich"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = found.split("\n")[:found.split("\n").index(next(line for line in found.split("\n") if "lineitem.parquet" in line)) + 1]
    assert sum("Exchange hashpartitioning" in line for line in top) == 2
