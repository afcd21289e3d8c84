import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.operators import enrich
from tallymart.session import scratch_dir
from tallymart.sources import dimensions, events, payloads

NAMES = schemas.REQUEST_LOG.names


def decoded(spark, *texts):
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    return events.decode_events(messages).collect()


def event(**changes):
    fields = dict(
        timestamp="2024-01-01T10:00:00.123456", user_id="u", model="m", prompt="p", response="r",
        prompt_tokens=1, output_tokens=2, total_tokens=3, latency_ms=4, cost_usd=0.5,
    )
    fields.update(changes)
    return {k: v for k, v in fields.items() if v is not ...}


def test_valid_event(spark):
    (row,) = decoded(spark, json.dumps(event(model_strength="s", routed_by="x")))
    assert row.is_valid and row.timestamp == datetime(2024, 1, 1, 10, 0, 0, 123456) and row.cost_usd == 0.5
    assert "routed_by" not in row.asDict()


@pytest.mark.parametrize(
    "text, valid",
    [
        (json.dumps(event(timestamp="2024-01-01T10:00:00")), True),
        (json.dumps(event(prompt=None)), True),  # present NULL
        (json.dumps(event(timestamp=None)), True),
        (json.dumps(event(prompt=...)), False),  # missing field
        (json.dumps(event(timestamp="yesterday")), False),
        (json.dumps(event(latency_ms="soon")), False),
        (json.dumps(event())[:-1], False),
        ("[]", False), ("", False), (None, False), ("{}", False), ("null", False),
    ],
)
def test_event_validity(spark, text, valid):
    (row,) = decoded(spark, text)
    assert row.is_valid is valid and row.value == text


def test_encoding_round_trip(spark, logs):
    log = logs({}, {"response": None, "prompt": 'quote " é \n'}).select(*NAMES)
    encoded = events.encode_events(log)
    first = encoded.first()
    assert first.key == "u1" and list(json.loads(first.value)) == NAMES
    assert json.loads(first.value)["timestamp"] == "2024-01-01T10:00:00.000000"
    assert events.encode_events(log, keyed=False).first().key is None
    back = events.decode_events(encoded).filter("is_valid").select(*NAMES)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, log.collect()), key=str)


def test_routed_event_has_twelve_fields(spark, logs):
    log = logs({"model": "?", "prompt": "word " * 12}).select(*NAMES)
    routed = enrich.routed_events(log, dimensions.model_rates(spark))
    fields = json.loads(events.encode_events(routed).first().value)
    assert len(fields) == 12 and fields["model"] == "llama3.2" and fields["cost_usd"] == 0.0005
    assert fields["model_strength"].startswith("balanced")


def test_absent_counter_is_zero(one):
    body = F.lit('{"response": "x", "eval_count": 7}')
    assert one(events.usage_tokens(body, "eval_count"), events.usage_tokens(body, "prompt_eval_count")) == (7, 0)


class Recorder:
    """Stands in for the stream reader, whose Kafka connector is not installed here."""

    def __init__(self, result):
        self.calls, self.result, self.readStream = {}, result, self

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **values):
        self.calls.update(values)
        return self

    def load(self):
        return self.result

    def save(self):
        self.calls["saved"] = True


def test_kafka_options(spark):
    messages = spark.createDataFrame(
        [(b"k", bytearray(b"{}"), "llm_events", 2, 40)], "key binary, value binary, topic string, partition int, offset long"
    )
    recorder = Recorder(messages)
    row = events.kafka_source(recorder, "broker:9092", maxOffsetsPerTrigger="1000").first()
    assert tuple(row) == ("{}", "llm_events", 2, 40)
    assert recorder.calls == {
        "format": "kafka", "kafka.bootstrap.servers": "broker:9092", "subscribe": "llm_events",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000",
    }


def test_kafka_sink_options():
    writer = Recorder(None)
    events.kafka_sink(type("Frame", (), {"write": writer})(), "broker:9092")
    assert writer.calls == {
        "format": "kafka", "kafka.bootstrap.servers": "broker:9092", "topic": "llm_events", "saved": True,
    }


def payload(**hourly):
    arrays = dict(
        time=["2024-01-01T00:00", "2024-01-01T13:00"], temperature_2m=[1.5, 2.5], relative_humidity_2m=[50, 60],
        wind_speed_10m=[3.0, 4.0], precipitation=[0.0, 0.1], cloud_cover=[10, 20], is_day=[0, 1],
    )
    arrays.update(hourly)
    return json.dumps({"city": "Iasi", "latitude": 1, "hourly": arrays})


def flattened(spark, tmp_path, *documents):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "part.json").write_text("\n".join(documents))
    read = payloads.read_payloads(spark, str(tmp_path / "landing"))
    return payloads.flatten_hourly(read, dimensions.cities(spark)).orderBy("timestamp").collect()


def test_flatten(spark, tmp_path):
    night, day = flattened(spark, tmp_path, payload())
    assert (night.city, night.latitude, night.longitude, night.hour, night.is_day) == ("Iasi", 47.1585, 27.6014, 0, False)
    assert (day.timestamp, day.day_of_week, day.is_day) == (datetime(2024, 1, 1, 13), "Monday", True)
    assert (day.temperature_c, day.humidity_pct, day.precipitation_mm, day.cloud_cover_pct) == (2.5, 60.0, 0.1, 20.0)


def test_short_array_gives_null_and_long_one_no_rows(spark, tmp_path):
    rows = flattened(spark, tmp_path, payload(temperature_2m=[1.5], cloud_cover=[1, 2, 3]))
    assert [r.temperature_c for r in rows] == [1.5, None]


def test_malformed_payload_fails_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        flattened(spark, tmp_path, payload(), '{"city": "Iasi", "hourly":')


def test_fixed_dimensions(spark):
    assert dimensions.sites(spark).count() == 5 and dimensions.cities(spark).count() == 5
    assert {r.site_type: r.base_kwh for r in dimensions.base_loads(spark).collect()}["commercial"] == 2.5
    assert dimensions.model_rates(spark).filter("model = 'mistral'").first().output_rate == 0.006


def test_scratch_dir_follows_the_cluster_setting(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if before:
        assert first.startswith(before)


def test_replace_load(store, orders):
    store.replace("raw", "orders", orders({}, {}))
    store.replace("raw", "orders", orders({"order_id": "new"}))
    assert [r.order_id for r in store.read("raw", "orders").collect()] == ["new"]


def test_failed_replace_keeps_the_old_contents(store, orders):
    store.replace("raw", "orders", orders({}))
    broken = orders({}).withColumn("total_eur", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.replace("raw", "orders", broken)
    assert store.read("raw", "orders").count() == 1


def test_superseded_contents_are_dropped_on_request(store, orders, tmp_path):
    for _ in range(3):
        store.replace("raw", "orders", orders({}))
    folder = tmp_path / "store" / "raw"
    assert len(list(folder.glob("orders__*"))) == 3
    store.drop_superseded("raw", "orders")
    assert len(list(folder.glob("orders__*"))) == 1 and store.read("raw", "orders").count() == 1


def test_partitioned_replace_prunes(store, orders):
    rows = orders({}, {"order_date": datetime(2024, 2, 1).date()})
    store.replace("raw", "orders", rows, ["order_date"])
    read = store.read("raw", "orders").filter(F.col("order_date") == "2024-02-01")
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(order_date" in read._jdf.queryExecution().executedPlan().toString()


def test_declare_and_append(store, logs):
    store.declare("raw", "llm_logs", schemas.REQUEST_LOG)
    store.declare("raw", "llm_logs", schemas.REQUEST_LOG)  # keeps the table
    store.append("raw", "llm_logs", logs({}).select(*reversed(NAMES)))
    store.append("raw", "llm_logs", logs({"user_id": "u2"}))
    assert sorted(r.user_id for r in store.read("raw", "llm_logs").collect()) == ["u1", "u2"]
    assert store.read("raw", "llm_logs").schema == schemas.REQUEST_LOG
