"""Staging views, generations of tables, incremental marts, mergeable distinct users, the alert in the refresh, and stream windows."""

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F
from test_sources import event

from tallymart.operators import anomaly, distinct, marts, partials, staging
from tallymart.plans import refresh, views
from tallymart.sources import adapters, events
from tallymart.sources.tables import Warehouse
from tallymart.streaming import hourly, ingest


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture
def mixed(logs):
    """Three days with null keys, null times, amounts off the grid, unknown models and a free request."""
    changes = [
        {"timestamp": datetime(2024, 1, 1 + i % 3, i % 24, i % 60), "user_id": None if i % 7 == 0 else f"u{i % 5}", "latency_ms": None if i == 3 else 700 * i,
         "model": ["phi3", "mistral", "other", None][i % 4], "cost_usd": 0.1234567 * i, "prompt": "p" * (i % 3 * 60), "total_tokens": i or None}
        for i in range(40)
    ]
    return logs(*changes, {"timestamp": None}, {"timestamp": None, "user_id": "u1"}, {"cost_usd": 0.0, "model": "free"})


# --- partials ---------------------------------------------------------------------


@pytest.mark.parametrize("mart", sorted(partials.KEYS))
def test_partials_merge_to_the_mart(mixed, mart):
    staged = staging.stg_llm_logs(mixed)
    days = partials.daily(staged, mart)
    halves = partials.daily(staged.where("total_tokens % 2 = 0"), mart).unionByName(partials.daily(staged.where("NOT (total_tokens % 2 <=> 0)"), mart))
    whole = getattr(marts, mart)(staged)
    assert partials.merged(days, mart).columns == whole.columns
    assert rows(partials.merged(days, mart)) == rows(whole) == rows(partials.merged(halves, mart))


@pytest.mark.parametrize("name", [*sorted(partials.KEYS), "mart_hourly_activity"])
def test_incremental_equals_full_refresh(store, mixed, logs, name):
    """Dates gain, lose and change rows, appear and vanish; rows without a time change too."""
    since = date(2024, 1, 2)
    before = mixed.where("timestamp IS NULL OR timestamp < '2024-01-02' OR hour(timestamp) % 2 = 0").unionByName(
        logs({"timestamp": datetime(2024, 1, 9), "user_id": "gone", "model": "gone"}))
    refresh.refresh(store, "requests", {"llm_logs_kafka": before}, load=False, incremental=True)
    assert rows(store.read("marts", name)) == rows(refresh.MODELS[name][0](staging.stg_llm_logs(before)).select(*store.read("marts", name).columns))
    after = mixed.where("timestamp IS NOT NULL").unionByName(logs({"timestamp": datetime(2024, 1, 8), "user_id": "new"}))
    refresh.refresh(store, "requests", {"llm_logs_kafka": after}, load=False, incremental=True, since=since)
    expected = refresh.MODELS[name][0](staging.stg_llm_logs(after))
    assert rows(store.read("marts", name), *expected.columns) == rows(expected)
    nothing = after.where("timestamp < '2024-01-02'")
    refresh.refresh(store, "requests", {"llm_logs_kafka": nothing}, load=False, incremental=True, since=since)
    expected = refresh.MODELS[name][0](staging.stg_llm_logs(nothing))
    assert rows(store.read("marts", name), *expected.columns) == rows(expected)


def test_older_raw_rows_are_not_read(store, spark, tmp_path, mixed):
    """Older folders of the log may be gone: only recent ones are opened, and their cut reaches the scan."""
    log = str(tmp_path / "log")
    mixed.where("timestamp IS NOT NULL").withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(log)
    refresh.refresh(store, "requests", {"llm_logs_kafka": spark.read.parquet(log).drop("day")}, load=False, incremental=True)
    whole = rows(store.read("marts", "mart_cost_per_user"))
    recent = spark.read.parquet(log).where("day >= '2024-01-03'").drop("day")
    refresh.refresh(store, "requests", {"llm_logs_kafka": recent}, load=False, incremental=True, since=date(2024, 1, 3))
    assert rows(store.read("marts", "mart_cost_per_user")) == whole
    cut = refresh._recent({"log": spark.read.parquet(log)}, "timestamp", date(2024, 1, 3))["log"]
    assert "GreaterThanOrEqual(timestamp" in plan(partials.daily(staging.stg_llm_logs(cut), "mart_cost_per_user"))


# --- generations ------------------------------------------------------------------


def test_a_failure_between_write_and_swap_leaves_the_table(store, orders, monkeypatch):
    store.replace("raw", "orders", orders({}))
    dated = orders({}, {"order_date": date(2024, 2, 1)})
    store.replace("raw", "dated", dated, ["order_date"])

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Warehouse, "_form", lost)  # files are written, the catalog not yet changed
    for name, layout in (("orders", None), ("dated", ["order_date"])):
        with pytest.raises(RuntimeError, match="driver lost"):
            store.replace("raw", name, orders({"order_id": "new"}), layout)
    assert [r.order_id for r in store.read("raw", "orders").collect()] == ["o1"] and store.read("raw", "dated").count() == 2
    monkeypatch.undo()
    store.replace("raw", "orders", orders({"order_id": "new"}))
    assert [r.order_id for r in store.read("raw", "orders").collect()] == ["new"]


def test_a_replaced_table_is_never_dropped(store, orders, monkeypatch):
    store.replace("raw", "orders", orders({}))
    store.replace("raw", "dated", orders({}, {"order_date": None}, {"order_date": date(2024, 3, 1)}), ["order_date"])
    said, sql = [], type(store.spark).sql
    monkeypatch.setattr(type(store.spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(self, text, *a, **k))
    store.replace("raw", "orders", orders({"order_id": "new"}))
    store.replace("raw", "dated", orders({"order_id": "a", "order_date": None}, {"order_id": "b", "order_date": date(2024, 4, 1)}), ["order_date"])
    assert not [s for s in said if s.startswith(("DROP TABLE", "CREATE TABLE"))]
    assert rows(store.read("raw", "dated"), "order_id") == [("a",), ("b",)]
    store.replace("raw", "orders", orders({}).withColumn("extra", F.lit(1)))  # other columns
    assert store.read("raw", "orders").first()["extra"] == 1
    store.replace("raw", "dated", orders({}).limit(0), ["order_date"])
    assert store.read("raw", "dated").count() == 0


def test_folders_on_disk_stay_bounded(store, mixed, tmp_path):
    for _ in range(4):
        refresh.refresh(store, "requests", {"llm_logs_kafka": mixed}, incremental=True, since=date(2024, 1, 3))
    assert {d.name.split("__")[0]: len(list((tmp_path / "store" / layer).glob(f"{d.name.split('__')[0]}__*")))
            for layer in ("marts", "raw_requests") for d in (tmp_path / "store" / layer).glob("*__*")} == {
        "mart_cost_per_user": 2, "mart_latency_analysis": 2, "mart_model_comparison": 2, "mart_hourly_activity": 3, "llm_logs_kafka": 2}
    store.drop_superseded("marts", "mart_hourly_activity")
    kept = list((tmp_path / "store" / "marts").glob("mart_hourly_activity__*/*=*"))
    assert len(kept) == store.read("marts", "mart_hourly_activity").select("request_date").distinct().count()


# --- staging views ----------------------------------------------------------------


@pytest.mark.parametrize("domain", sorted(adapters.BY_DOMAIN))
def test_views_equal_the_staging_functions(store, spark, domain):
    raw = adapters.raw_tables(spark, SMALL, domain)
    store.load(domain, raw)
    other = Warehouse(spark.newSession(), store.root, store.prefix)
    for name in views.create_staging(store, domain):
        build, (source,) = refresh.STAGING[domain][name]
        expected, found = build(store.read(f"raw_{domain}", source)), other.read("staging", name)
        assert found.dtypes == expected.dtypes
        assert rows(found) == rows(expected)


def test_views_cast_what_was_loaded_otherwise(store, spark, logs, orders):
    odd = logs({}, {"timestamp": None, "latency_ms": None, "model": None}, {"consumed_at": datetime(2024, 1, 1, 9, 59, 59, 999_500)}).withColumn(
        "latency_ms", F.col("latency_ms").cast("double") + 0.5).withColumn("total_tokens", F.col("total_tokens").cast("decimal(10,2)"))
    store.load("requests", {"llm_logs_kafka": odd})
    views.create_staging(store, "requests")
    expected = staging.stg_llm_logs(store.read("raw_requests", "llm_logs_kafka"))
    assert rows(store.read("staging", "stg_llm_logs")) == rows(expected)
    assert store.read("staging", "stg_llm_logs").dtypes == expected.dtypes


def test_prefixes_keep_views_apart(spark, tmp_path, logs):
    one, two = (Warehouse(spark, str(tmp_path / p), f"v{abs(hash(str(tmp_path)))}_{p}_") for p in "ab")
    for store, users in ((one, ["x"]), (two, ["y", "z"])):
        refresh.refresh(store, "requests", {"llm_logs_kafka": logs(*[{"user_id": u} for u in users])})
    assert rows(one.read("staging", "stg_llm_logs"), "user_id") == [("x",)]
    assert rows(two.read("staging", "stg_llm_logs"), "user_id") == [("y",), ("z",)]


# --- distinct users ---------------------------------------------------------------


def test_bitmaps_count_users_exactly(spark, mixed, monkeypatch):
    staged = staging.stg_llm_logs(mixed)
    known, maps = None, None
    for batch in range(3):
        part = staged.where(F.pmod(F.coalesce("total_tokens", F.lit(0)), F.lit(3)) == batch)
        fresh = distinct.new_users(part, known)
        known = fresh if known is None else known.unionByName(fresh)
        more = distinct.hourly_bitmaps(part, known)
        maps = more if maps is None else maps.unionByName(more)
    assert known.count() == known.select("user_id").distinct().count() == known.select("bucket", "place").distinct().count() == 5
    assert distinct.new_users(staged, known).isEmpty()
    for keys in (["request_date", "request_hour"], ["request_date"], []):
        exact = staged.where("user_id IS NOT NULL").groupBy(*keys).agg(F.count_distinct("user_id").alias("n"))
        assert rows(distinct.unique_users(maps, *keys)) == rows(exact)


# --- alert ------------------------------------------------------------------------


def alert_of(store, log, as_of, **options):
    report = refresh.refresh(store, "requests", {"llm_logs_kafka": log}, load=False, as_of=as_of, **options)
    return {r.measure: (r.column_name, r.value) for r in report.collect() if r.measure.endswith(("_e4", "_e1", "anomaly"))}


@pytest.mark.parametrize("incremental", [False, True])
def test_alert_is_the_last_step(store, logs, incremental):
    """Costs of an unknown model are kept as they are, so the mean is set here."""
    as_of = datetime(2024, 1, 1, 12)
    old = [{"model": "x", "user_id": "b", "cost_usd": 1.0, "timestamp": datetime(2024, 1, 1, 3)} for _ in range(4)]
    exactly = logs(*old, {"model": "x", "user_id": "a", "cost_usd": 6.0, "timestamp": as_of})  # mean 2, exactly 3 times
    found = alert_of(store, exactly, as_of, incremental=incremental)
    assert found == {"avg_cost_e4": ("cost_usd", 20_000), "max_cost_last_hour_e4": ("cost_usd", 60_000), "cost_ratio_e1": ("cost_usd", 30),
                     "is_anomaly": ("cost_usd", 0), "top_cost_e4": ("a", 60_000)}
    above = logs(*old, *old, {"model": "x", "user_id": "a", "cost_usd": 6.0, "timestamp": as_of})
    found = alert_of(store, above, as_of, incremental=incremental, since=date(2024, 1, 1))
    assert found["is_anomaly"][1] == 1 and found["top_cost_e4"] == ("b", 80_000)
    empty_hour = alert_of(store, above, as_of + timedelta(days=1), incremental=incremental)
    assert empty_hour["is_anomaly"][1] == 0 and empty_hour["max_cost_last_hour_e4"][1] is None
    free = alert_of(store, logs({"model": "x", "cost_usd": 0.0, "timestamp": as_of}), as_of, incremental=incremental)
    assert free["is_anomaly"][1] == 0 and free["cost_ratio_e1"][1] is None and free["avg_cost_e4"][1] == 0


def test_alert_from_partials_equals_the_scan(spark):
    staged = staging.stg_llm_logs(adapters.llm_logs_kafka(spark, SMALL))
    days = partials.daily(staged, "mart_model_comparison")
    as_of = F.lit(staged.agg(F.max("request_timestamp")).first()[0])
    assert rows(anomaly.alert_from_partials(days, staged, as_of)) == rows(anomaly.cost_anomaly(staged, as_of))


# --- the log by name --------------------------------------------------------------


def test_redelivered_messages_pass_once_and_the_log_has_a_name(store, spark, tmp_path):
    schema = "value string, source string, partition int, offset long, appended_at timestamp"

    def send(*places):
        moment = datetime(2024, 1, 1)
        sent = [(json.dumps(event(user_id=f"{p}-{o}")), "topic", p, o, moment) for p, o in places]
        spark.createDataFrame(sent, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        messages = spark.readStream.schema(schema).parquet(str(tmp_path / "landing"))
        ingest.ingest(ingest.once_per_offset(messages, "appended_at"), str(tmp_path / "log"), str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.table(ingest.declare_log(store, str(tmp_path / "log"))), "source_partition", "source_offset", "user_id")

    assert send((0, 1), (0, 2), (1, 1), (0, 1)) == [(0, 1, "0-1"), (0, 2, "0-2"), (1, 1, "1-1")]
    assert len(send((0, 2), (0, 3), (1, 1))) == 4  # across batches and restarts
    assert len(send((1, 2))) == 5
    (tmp_path / "log" / "status=ok" / "event_date=2024-01-01" / "stray.parquet").write_bytes(b"a file of a lost batch")
    assert store.read("raw_requests", "llm_logs_kafka").count() == 5
    views.create_staging(store, "requests")
    assert store.read("staging", "stg_llm_logs").count() == 5


# --- stream windows ---------------------------------------------------------------


def land(folder, name, *sent):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(event(**e)) for e in sent))


def test_only_closed_hours_are_appended_and_late_events_dropped(spark, tmp_path):
    landing = tmp_path / "landing"

    def run():
        source = events.file_source(spark, str(landing), max_files=1)
        hourly.write_closed_hours(hourly.hourly_activity(source, "1 hour"), f"{tmp_path}/hours", f"{tmp_path}/state").awaitTermination()
        out = spark.read.parquet(f"{tmp_path}/hours") if list((tmp_path / "hours").glob("*=*")) else None
        return sorted((r.request_hour, r.total_requests, r.approx_users) for r in out.collect()) if out else []

    land(landing, "1.json", {"timestamp": "2024-01-01T10:05:00", "user_id": "a"}, {"timestamp": "2024-01-01T10:50:00", "user_id": "b"},
         {"timestamp": None})
    assert run() == []  # the hour is open
    land(landing, "2.json", {"timestamp": "2024-01-01T11:30:00", "user_id": "a"}, {"timestamp": "2024-01-01T10:10:00", "user_id": "a"})
    assert run() == []  # the watermark is at 10:30
    land(landing, "3.json", {"timestamp": "2024-01-01T12:59:00", "user_id": "c"})
    assert run() == [(10, 3, 2)]  # the watermark is at 11:59
    land(landing, "4.json", {"timestamp": "2024-01-01T10:59:00", "user_id": "late"}, {"timestamp": "2024-01-01T16:00:00", "user_id": "d"})
    assert run() == [(10, 3, 2), (11, 1, 1), (12, 1, 1)]


def test_complete_mode_counts_every_hour_over_restarts(spark, tmp_path, logs):
    landing = tmp_path / "landing"
    for n in range(3):
        land(landing, f"{n}.json", *[{"timestamp": f"2024-01-01T{10 + n:02d}:00:00", "user_id": u} for u in "abc"], {"timestamp": "2024-01-01T10:30:00"})
        source = events.file_source(spark, str(landing), max_files=1)
        hourly.write_all_hours(hourly.hourly_activity(source), f"{tmp_path}/hours", f"{tmp_path}/state").awaitTermination()
    found = {r.request_hour: r.total_requests for r in hourly.read_all_hours(spark, f"{tmp_path}/hours").collect()}
    assert found == {10: 6, 11: 3, 12: 3}
