import json
import shutil
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_sources import event

from tallymart import schemas
from tallymart.operators import staging
from tallymart.plans import refresh
from tallymart.session import side_by_side
from tallymart.sources import events
from tallymart.streaming.ingest import ingest, messages_processed, read_log, read_quarantine


def run(spark, base):
    query = ingest(events.file_source(spark, f"{base}/landing"), f"{base}/log", f"{base}/checkpoint")
    query.awaitTermination()
    return messages_processed(spark, f"{base}/log")


def test_each_event_is_ingested_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text("\n".join(json.dumps(event(user_id=u)) for u in "ab"))
    assert run(spark, tmp_path) == 2
    assert run(spark, tmp_path) == 2  # nothing new; the count spans runs
    (landing / "2.json").write_text(json.dumps(event(user_id="c", timestamp="2024-01-02T00:00:00")) + "\nbroken")
    assert run(spark, tmp_path) == 4

    log = read_log(spark, str(tmp_path / "log"))
    assert log.schema.names == schemas.CONSUMED_LOG.names
    assert sorted(r.user_id for r in log.collect()) == ["a", "b", "c"]
    assert log.filter("consumed_at IS NULL").count() == 0
    recent = read_log(spark, str(tmp_path / "log"), datetime(2024, 1, 2).date())
    assert [r.user_id for r in recent.collect()] == ["c"]
    assert "event_date" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    (rejected,) = read_quarantine(spark, str(tmp_path / "log")).collect()
    assert rejected.rejected_value == "broken" and rejected.source.endswith("2.json")


def test_continuous_ingestion(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps(event()))
    source = events.file_source(spark, str(landing))
    query = ingest(source, f"{tmp_path}/log", f"{tmp_path}/checkpoint", interval="1 second")
    query.processAllAvailable()
    assert query.isActive and messages_processed(spark, f"{tmp_path}/log") == 1
    (landing / "2.json").write_text(json.dumps(event(user_id="later")))
    query.processAllAvailable()
    query.stop()
    assert read_log(spark, f"{tmp_path}/log").count() == 2


def test_stream_equals_batch_and_feeds_staging(spark, tmp_path, logs):
    sent = logs({}, {"user_id": "u2", "prompt": None}, {"timestamp": datetime(2024, 1, 3)}).select(*schemas.REQUEST_LOG.names)
    events.write_events(events.encode_events(sent), str(tmp_path / "landing"))
    run(spark, tmp_path)
    log = read_log(spark, str(tmp_path / "log"))
    names = schemas.REQUEST_LOG.names
    assert sorted(map(tuple, log.select(*names).collect()), key=str) == sorted(map(tuple, sent.collect()), key=str)
    assert staging.stg_llm_logs(log).filter("kafka_lag_ms > 0").count() == 3


def test_a_lost_checkpoint_batch_is_not_repeated(spark, tmp_path):
    """A query that stopped after writing a batch but before committing it replays the same batch."""
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps(event()))
    run(spark, tmp_path)
    shutil.rmtree(tmp_path / "checkpoint" / "commits")
    run(spark, tmp_path)
    assert read_log(spark, str(tmp_path / "log")).count() == 1


def test_refresh_reports_rows_and_checks(store, logs):
    report = refresh.refresh(store, "requests", {"llm_logs_kafka": logs({}, {"user_id": None})})
    got = {(r.relation, r.column_name, r.measure): r.value for r in report.collect()}
    assert got[("llm_logs_kafka", None, "rows")] == 2
    assert got[("mart_cost_per_user", None, "rows")] == 2
    assert got[("stg_llm_logs", "user_id", "not_null")] == 1
    assert got[("stg_llm_logs", "latency_category", "accepted_values")] == 0
    assert store.read("marts", "mart_model_comparison").first().total_requests == 2
    assert store.spark.table("stg_llm_logs").count() == 2


def test_marts_of_a_refresh_are_written_side_by_side(store, logs, monkeypatch):
    """Every write waits for the other three, so one after the other would never get past the first."""
    meet, write = threading.Barrier(4), refresh.write_mart

    def together(*arguments):
        meet.wait(timeout=60)
        return write(*arguments)

    monkeypatch.setattr(refresh, "write_mart", together)
    report = refresh.refresh(store, "requests", {"llm_logs_kafka": logs({}, {"user_id": "u2"})}, load=False)
    rows = {r.relation: r.value for r in report.collect() if r.measure == "rows"}
    assert rows == {
        "llm_logs_kafka": 2, "mart_cost_per_user": 2, "mart_hourly_activity": 1, "mart_latency_analysis": 1, "mart_model_comparison": 1,
    }


def test_steps_side_by_side_keep_their_order_and_all_end_before_a_failure(spark):
    assert side_by_side([]) == []
    assert side_by_side([lambda n=n: spark.range(n).count() for n in (3, 1, 2)]) == [3, 1, 2]
    ended = []

    def fails():
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        side_by_side([fails, lambda: ended.append(spark.range(5).count())])
    assert ended == [5]


def test_strict_refresh_raises_after_writing_the_marts(store, logs):
    with pytest.raises(refresh.QualityError, match="stg_llm_logs.user_id not_null: 1"):
        refresh.refresh(store, "requests", {"llm_logs_kafka": logs({"user_id": None})}, strict=True)
    assert store.read("marts", "mart_cost_per_user").count() == 1
    clean = refresh.refresh(store, "requests", {"llm_logs_kafka": logs({})}, strict=True)
    assert clean.filter("measure <> 'rows'").agg(F.count("*"), F.sum("value")).first()[:] == (4, 0)


def test_refresh_of_a_growing_log_is_not_reloaded(store, spark, tmp_path, logs):
    for user in ("u1", "u2"):
        sent = logs({"user_id": user}).select(*schemas.REQUEST_LOG.names)
        events.write_events(events.encode_events(sent), str(tmp_path / "landing"))
        run(spark, tmp_path)
        refresh.refresh(store, "requests", {"llm_logs_kafka": read_log(spark, str(tmp_path / "log"))}, load=False)
    assert store.read("marts", "mart_cost_per_user").count() == 2
    assert "llm_logs_kafka" not in [t.name for t in spark.catalog.listTables(store.database("raw_requests"))]


def test_recent_dates_are_rebuilt_alone(store, logs):
    first = logs(*[{"timestamp": datetime(2024, 1, d)} for d in (1, 2, 3)])
    long_ago = datetime(2024, 1, 1).date()  # without tables yet, everything is built
    refresh.refresh(store, "requests", {"llm_logs_kafka": first}, load=False, since=long_ago)
    later = first.unionByName(logs({"timestamp": datetime(2024, 1, 3, 5)}, {"timestamp": datetime(2024, 1, 4)}))
    # a first day changed behind the mart's back shows that its folder is left alone
    later = later.filter("timestamp > '2024-01-01'")
    since = datetime(2024, 1, 3).date()
    report = refresh.refresh(store, "requests", {"llm_logs_kafka": later}, load=False, since=since)
    rows = {(r.relation, r.measure): r.value for r in report.collect() if r.measure == "rows"}
    assert rows[("mart_hourly_activity", "rows")] == 5 and rows[("mart_cost_per_user", "rows")] == 1
    hours = {(str(r.request_date), r.request_hour) for r in store.read("marts", "mart_hourly_activity").collect()}
    assert hours == {("2024-01-01", 0), ("2024-01-02", 0), ("2024-01-03", 0), ("2024-01-03", 5), ("2024-01-04", 0)}
    assert store.read("marts", "mart_cost_per_user").first().total_requests == 4


def test_rows_without_a_date_are_rebuilt_too(store, logs):
    refresh.refresh(store, "requests", {"llm_logs_kafka": logs({}, {"timestamp": None})}, load=False)
    grown = logs({}, {"timestamp": None}, {"timestamp": None, "user_id": "u2"})
    refresh.refresh(store, "requests", {"llm_logs_kafka": grown}, load=False, since=datetime(2024, 1, 2).date())
    found = {r.request_date is None: r.total_requests for r in store.read("marts", "mart_hourly_activity").collect()}
    assert found == {True: 2, False: 1}


def test_recent_rows_are_cut_in_the_scan(spark, tmp_path, logs):
    logs({}).write.parquet(str(tmp_path / "log"))
    raw = spark.read.parquet(str(tmp_path / "log")).filter(F.col("timestamp") >= F.lit(datetime(2024, 1, 3).date()))
    assert "GreaterThanOrEqual(timestamp" in raw._jdf.queryExecution().executedPlan().toString()


def test_mart_layouts_keep_every_row(store, spark, orders, logs):
    """Both layouts, with one date holding a third of the rows."""
    many = orders(*[
        {"country": f"c{i}", "order_date": datetime(2024, 1, 1 if i % 3 == 0 else 1 + i % 28).date()} for i in range(300)
    ])
    mart = refresh.MODELS["mart_revenue_daily"][0](staging.stg_orders(many))
    assert refresh.write_mart(store, "mart_revenue_daily", mart).exceptAll(mart).count() == 0
    assert store.read("marts", "mart_revenue_daily").count() == 300

    hours = logs(*[{"timestamp": datetime(2024, 1, 1 + i % 5, i % 24)} for i in range(240)])
    mart = refresh.MODELS["mart_hourly_activity"][0](staging.stg_llm_logs(hours))
    written = refresh.write_mart(store, "mart_hourly_activity", mart)
    assert written.columns == mart.columns
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, mart.collect()))
    assert written.filter(F.col("request_date") == "2024-01-02").count() == mart.filter(
        F.col("request_date") == "2024-01-02"
    ).count()
