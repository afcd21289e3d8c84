"""Registered queries: every operator over the bundled tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, pricing, prompts
from ..operators import anomaly, distinct, enrich, marts, quality
from ..schemas import REQUEST_LOG
from ..session import scratch_dir, side_by_side, use_utc
from ..sources import adapters, dimensions, events, payloads
from ..sources.tables import Warehouse
from ..streaming import hourly, segments
from ..streaming.ingest import declare_log, ingest, once_per_offset, read_log
from . import refresh, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Messages in a landing file, about, and landing files in a batch, at most: what a task or a batch takes in is bounded.
FILE_MESSAGES = 100_000
BATCH_FILES = 64


def query(build: Query) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        use_utc(spark)
        return build(spark, path)

    QUERIES[build.__name__] = run
    return build


def relations(spark: SparkSession, path: str) -> Callable[[str], DataFrame]:
    """Any raw table, staging relation or mart over the test tables, built when it is asked for."""
    built: dict[str, DataFrame] = {}
    return lambda name: refresh.relation(name, lambda raw: adapters.RAW[raw](spark, path), built)


def _register_models() -> None:
    """One query per staging relation and mart."""

    def register(name: str) -> None:
        def build(spark: SparkSession, path: str) -> DataFrame:
            return relations(spark, path)(name)

        build.__name__ = name
        query(build)

    for name in refresh.MODELS:
        register(name)


def warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, label), f"{label}_{uuid.uuid4().hex[:8]}_")


def landing_files(messages: int, batches: int) -> tuple[int, int]:
    """(files, files a batch) that ``messages`` land in: as many files as the messages fill, taken in ``batches`` or more."""
    files = max(batches, -(-messages // FILE_MESSAGES))
    return files, min(BATCH_FILES, files // batches)


_register_models()


# --- ad-hoc reports ---------------------------------------------------------------


@query
def presentation_sort(spark: SparkSession, path: str) -> DataFrame:
    return marts.present(relations(spark, path)("mart_revenue_daily"), "mart_revenue_daily")


@query
def revenue_by_category(spark: SparkSession, path: str) -> DataFrame:
    return marts.revenue_by_category(adapters.orders(spark, path))


@query
def weather_city_7d(spark: SparkSession, path: str) -> DataFrame:
    raw = adapters.hourly_weather(spark, path)
    return marts.weather_city_7d(raw, since=marts.trailing_start(raw, "timestamp"))


@query
def cost_anomaly(spark: SparkSession, path: str) -> DataFrame:
    logs = relations(spark, path)("stg_llm_logs")
    latest = adapters.table(spark, path, "events").agg(F.max("ts")).scalar()
    return anomaly.cost_anomaly(logs, as_of=latest)


@query
def top_cost_user(spark: SparkSession, path: str) -> DataFrame:
    return anomaly.top_cost_user(relations(spark, path)("stg_llm_logs"))


@query
def llm_log_totals(spark: SparkSession, path: str) -> DataFrame:
    return marts.log_totals(adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names))


@query
def load_counts(spark: SparkSession, path: str) -> DataFrame:
    return marts.load_counts({name: build(spark, path) for name, build in adapters.RAW.items()})


# --- enrichment -------------------------------------------------------------------


@query
def order_line_enrich(spark: SparkSession, path: str) -> DataFrame:
    return enrich.order_lines_of(
        adapters.order_heads(spark, path), adapters.order_items(spark, path), adapters.customers(spark, path), adapters.products(spark, path)
    )


@query
def energy_expected_load(spark: SparkSession, path: str) -> DataFrame:
    staged = relations(spark, path)("stg_meter_readings")
    return enrich.expected_load(staged, dimensions.base_loads(spark))


@query
def calendar_features(spark: SparkSession, path: str) -> DataFrame:
    return enrich.calendar_features(adapters.table(spark, path, "events").select("event_id", "ts"), "ts")


@query
def build_keys(spark: SparkSession, path: str) -> DataFrame:
    site = F.format_string("SITE_%03d", F.col("l_suppkey"))
    return adapters.table(spark, path, "lineitem").select(
        "l_linenumber",
        calendar.order_key(F.col("l_orderkey")).alias("order_key"),
        calendar.product_key(F.col("l_partkey")).alias("product_key"),
        calendar.customer_key(F.col("l_suppkey")).alias("customer_key"),
        calendar.reading_key(site, F.col("l_shipdate")).alias("reading_key"),
    )


@query
def llm_cost_recompute(spark: SparkSession, path: str) -> DataFrame:
    log = adapters.llm_logs_kafka(spark, path)
    repriced = enrich.recompute_cost(log, dimensions.model_rates(spark))
    return repriced.select("timestamp", "user_id", "model", "prompt_tokens", "output_tokens", "cost_usd")


@query
def llm_cost_flat(spark: SparkSession, path: str) -> DataFrame:
    log = adapters.llm_logs_kafka(spark, path)
    cost = pricing.flat_cost(F.col("prompt_tokens"), F.col("output_tokens"))
    return log.select("timestamp", "user_id", "prompt_tokens", "output_tokens", cost.alias("cost_usd"))


@query
def llm_transport_lag(spark: SparkSession, path: str) -> DataFrame:
    return marts.transport_lag(relations(spark, path)("stg_llm_logs"))


# --- prompts ----------------------------------------------------------------------


@query
def prompt_preview(spark: SparkSession, path: str) -> DataFrame:
    return adapters.prompts(spark, path).select(
        "source", "prompt_id", prompts.preview(F.col("prompt")).alias("prompt_preview")
    )


@query
def prompt_filter(spark: SparkSession, path: str) -> DataFrame:
    return enrich.drop_empty_prompts(adapters.prompts(spark, path)).select("source", "prompt_id")


@query
def route_prompts(spark: SparkSession, path: str) -> DataFrame:
    routed = enrich.route(adapters.prompts(spark, path), words="words")
    return routed.select("source", "prompt_id", "words", "model")


@query
def routed_events(spark: SparkSession, path: str) -> DataFrame:
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    return enrich.routed_events(log, dimensions.model_rates(spark))


@query
def routing_summary(spark: SparkSession, path: str) -> DataFrame:
    return marts.routing_summary(routed_events(spark, path))


# --- events and payloads ----------------------------------------------------------


@query
def json_encode_events(spark: SparkSession, path: str) -> DataFrame:
    """Routed events encoded with their key; the value is shown through its own JSON fields."""
    encoded = events.encode_events(routed_events(spark, path))
    names = ["timestamp", "user_id", "model", "model_strength", "prompt", "total_tokens", "routed_by"]
    n_fields = F.size(F.json_object_keys("value")).alias("n_fields")
    shown = encoded.select("key", n_fields, F.json_tuple("value", *names))
    return shown.toDF("key", "n_fields", *[f"json_{name}" for name in names])


@query
def json_decode_events(spark: SparkSession, path: str) -> DataFrame:
    """Log rows to JSON and back, and the token counters of the response body with 0 for absent ones."""
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    decoded = events.decode_events(events.encode_events(log))
    return decoded.select(
        *REQUEST_LOG.names,
        "is_valid",
        events.usage_tokens(F.col("response"), "k").alias("usage_present"),
        events.usage_tokens(F.col("response"), "eval_count").alias("usage_absent"),
    )


@query
def json_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Events whose text was damaged: unclosed for one event type, missing a field for another."""
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    value, kind = F.col("value"), F.get_json_object("value", "$.model")
    damaged = (
        F.when(kind == "error", F.expr("left(value, length(value) - 1)"))
        .when(kind == "signup", F.expr("replace(value, '\"latency_ms\"', '\"latency\"')"))
        .otherwise(value)
    )
    messages = events.encode_events(log).select(kind.alias("sent_as"), damaged.alias("value"))
    return events.decode_events(messages).groupBy("sent_as", "is_valid").agg(F.count("*").alias("events"))


@query
def weather_flatten(spark: SparkSession, path: str) -> DataFrame:
    """Payloads written to a landing folder as JSON, read back with the nested schema and flattened."""
    landing = scratch_dir(spark, "payloads")
    adapters.weather_payloads(spark, path).write.partitionBy("city").json(landing)
    return payloads.flatten_hourly(payloads.read_payloads(spark, landing), dimensions.cities(spark))


# --- loads ------------------------------------------------------------------------


@query
def load_replace(spark: SparkSession, path: str) -> DataFrame:
    """A domain's raw tables loaded twice; the second load replaces the first."""
    store = warehouse(spark, "load_replace")
    raw = adapters.raw_tables(spark, path, "ecommerce")
    store.load("ecommerce", raw)
    store.load("ecommerce", raw)
    for name in raw:
        store.drop_superseded("raw_ecommerce", name)
    return marts.load_counts({name: store.read("raw_ecommerce", name) for name in raw})


@query
def load_append(spark: SparkSession, path: str) -> DataFrame:
    """The request log appended to a declared table in two batches, read back per model."""
    store = warehouse(spark, "load_append")
    store.declare("raw_requests", "llm_logs", REQUEST_LOG)
    log = adapters.llm_logs_kafka(spark, path)
    known = F.col("model").isin("phi3", "llama3.2", "mistral")
    store.append("raw_requests", "llm_logs", log.filter(known))
    store.append("raw_requests", "llm_logs", log.filter(~known))
    return store.read("raw_requests", "llm_logs").groupBy("model").agg(
        F.count("*").alias("log_rows"), F.sum("total_tokens").alias("total_tokens")
    )


@query
def mart_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    """A mart written to its table, one folder per date, and read back."""
    mart = relations(spark, path)("mart_energy_daily")
    return refresh.write_mart(warehouse(spark, "roundtrip"), "mart_energy_daily", mart)


@query
def stream_ingest(spark: SparkSession, path: str) -> DataFrame:
    """The request log sent as JSON files, ingested by the stream and read back from its log."""
    base = scratch_dir(spark, "stream")
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    events.write_events(events.encode_events(log), f"{base}/landing")
    for _ in range(2):  # the second run finds nothing new
        source = events.file_source(spark, f"{base}/landing")
        ingest(source, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    stored = read_log(spark, f"{base}/log")
    return stored.select(*REQUEST_LOG.names, F.col("consumed_at").isNotNull().alias("is_stamped"))


@query
def refresh_report(spark: SparkSession, path: str) -> DataFrame:
    """Every domain refreshed end to end: row counts of raw tables and marts, and all checks."""
    store = warehouse(spark, "refresh")
    reports = side_by_side([
        partial(refresh.refresh, store, domain, adapters.raw_tables(spark, path, domain)) for domain in adapters.BY_DOMAIN
    ])
    return reduce(DataFrame.unionByName, reports)


@query
def refresh_incremental(spark: SparkSession, path: str) -> DataFrame:
    """The request marts after a refresh of recent dates only, in one long form.

    The first log is the true one up to a date; from there on it lacks rows, has others at wrong times, and has a date that
    will vanish. The second refresh gets the true log and the date, and rebuilds from partials.
    """
    store = warehouse(spark, "incremental")
    log = adapters.llm_logs_kafka(spark, path)
    first, last = adapters.table(spark, path, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    since = first + (last - first) / 2
    recent = F.col("timestamp") >= F.lit(since)
    odd = F.col("prompt_tokens") % 2 == 1
    wrong = log.where(~recent | odd).withColumn(
        "timestamp", F.when(recent & (F.col("prompt_tokens") % 4 == 1), F.col("timestamp") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("timestamp"))
    )
    refresh.refresh(store, "requests", {"llm_logs_kafka": wrong}, load=False, incremental=True)
    refresh.refresh(store, "requests", {"llm_logs_kafka": log}, load=False, incremental=True, since=since)

    def long(mart: str, key: str, second: str, requests: str, cost: str, tokens: str) -> DataFrame:
        return store.read("marts", mart).select(
            F.lit(mart).alias("mart"), F.col(key).cast("string").alias("key"), F.expr(second).cast("string").alias("second_key"),
            F.col(requests).alias("requests"), F.col(cost).alias("cost_usd"), F.col(tokens).cast("double").alias("tokens"),
            F.col("avg_latency_ms").alias("avg_latency_ms"),
        )

    return (
        long("mart_cost_per_user", "user_id", "CAST(max_cost_usd AS STRING) IS NULL", "total_requests", "avg_cost_per_request", "total_tokens")
        .unionByName(long("mart_latency_analysis", "prompt_preview", "latency_category", "times_asked", "total_cost_usd", "avg_tokens"))
        .unionByName(long("mart_model_comparison", "model", "speed_category", "total_requests", "total_cost_usd", "tokens_per_dollar"))
        .unionByName(long("mart_hourly_activity", "request_date", "request_hour", "total_requests", "total_cost_usd", "unique_users"))
    )


@query
def staging_views(spark: SparkSession, path: str) -> DataFrame:
    """All staging relations as views of the catalog, read by another session: rows and a total of each."""
    store = warehouse(spark, "views")
    other = Warehouse(spark.newSession(), store.root, store.prefix)
    shown = {
        "stg_meter_readings": "SUM(reading_hour)", "stg_orders": "SUM(CAST(rint(revenue_eur * 100) AS BIGINT))", "stg_customers": "COUNT(DISTINCT segment)",
        "stg_products": "COUNT(DISTINCT brand)", "stg_weather": "SUM(reading_hour)", "stg_llm_logs": "SUM(CAST(rint(cost_usd * 1000000) AS BIGINT) + kafka_lag_ms)",
    }
    parts = []
    for domain in adapters.BY_DOMAIN:
        store.load(domain, adapters.raw_tables(spark, path, domain))
        for name in views.create_staging(store, domain):
            parts.append(other.read("staging", name).agg(
                F.lit(name).alias("relation"), F.count("*").alias("staged_rows"), F.expr(shown[name]).cast("long").alias("total")))
    return reduce(DataFrame.unionByName, parts)


@query
def unique_users_merged(spark: SparkSession, path: str) -> DataFrame:
    """Exact distinct users per hour and per day (hour -1) from bitmaps that three batches appended."""
    store = warehouse(spark, "bitmaps")
    logs = relations(spark, path)("stg_llm_logs")
    dictionary = distinct.new_users(logs.limit(0))
    store.declare("partials", "users", dictionary.schema)
    store.declare("partials", "hourly_users", distinct.hourly_bitmaps(logs, dictionary).schema)
    for batch in range(3):
        rows = logs.where(F.coalesce(F.pmod(F.hash("request_timestamp", "prompt_tokens"), F.lit(3)), F.lit(0)) == batch)
        known = store.read("partials", "users")
        fresh = scratch_dir(spark, "new_users")  # numbered before the table grows
        distinct.new_users(rows, known).write.parquet(fresh)
        store.append("partials", "users", spark.read.schema(dictionary.schema).parquet(fresh))
        store.append("partials", "hourly_users", distinct.hourly_bitmaps(rows, store.read("partials", "users")))
    bitmaps = store.read("partials", "hourly_users")
    per_day = distinct.unique_users(bitmaps, "request_date").withColumn("request_hour", F.lit(-1))
    return distinct.unique_users(bitmaps, "request_date", "request_hour").unionByName(per_day)


@query
def stream_log_table(spark: SparkSession, path: str) -> DataFrame:
    """Messages with partitions and offsets, a third of them delivered twice, ingested in several batches and read by the log's name."""
    store = warehouse(spark, "stream_log")
    landing = f"{store.root}/landing"
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    sent = events.encode_events(log).select(
        "value", F.lit("requests").alias("source"), F.pmod(F.get_json_object("value", "$.latency_ms").cast("int"), F.lit(4)).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("appended_at"),
    )
    files, a_batch = landing_files(log.count(), 2)
    sent.repartition(files).write.parquet(landing)
    again = spark.read.parquet(landing)
    again.where(F.pmod(F.xxhash64("offset"), F.lit(3)) == 0).write.mode("append").parquet(landing)
    messages = spark.readStream.schema(again.schema).option("maxFilesPerTrigger", a_batch).parquet(landing)
    log_folder = f"{store.root}/log"
    ingest(once_per_offset(messages, "appended_at"), log_folder, f"{store.root}/checkpoint").awaitTermination()
    return spark.table(declare_log(store, log_folder)).groupBy("source_partition").agg(
        F.count("*").alias("messages"), F.count_distinct("source_offset").alias("offsets"), F.sum("total_tokens").alias("total_tokens")
    )


@query
def stream_hourly_activity(spark: SparkSession, path: str) -> DataFrame:
    """Hourly activity counted by the stream, in complete mode over several batches; the approximate user count is left out."""
    base = scratch_dir(spark, "hourly")
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    files, a_batch = landing_files(log.count(), 3)
    events.write_events(events.encode_events(log).repartition(files), f"{base}/landing")
    source = events.file_source(spark, f"{base}/landing", max_files=a_batch)
    hourly.write_all_hours(hourly.hourly_activity(source), f"{base}/hours", f"{base}/checkpoint").awaitTermination()
    return hourly.read_all_hours(spark, f"{base}/hours").drop("approx_users")


def _segment_log(spark: SparkSession, path: str) -> str:
    """A log of segments after two runs of the stream, each in several batches and followed by a compaction.

    The request log is sent in two parts; events of one type arrive damaged.
    """
    base = scratch_dir(spark, "segments")
    log = adapters.llm_logs_kafka(spark, path).select(*REQUEST_LOG.names)
    value, kind = F.col("value"), F.get_json_object("value", "$.model")
    sent = events.encode_events(log).select(F.when(kind == "error", F.expr("left(value, length(value) - 1)")).otherwise(value).alias("value"))
    even = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    files, a_batch = landing_files(log.count() // 2, 3)
    for part in (even, ~even):
        events.write_events(sent.where(part).repartition(files), f"{base}/landing")
        source = events.file_source(spark, f"{base}/landing", max_files=a_batch)
        segments.ingest_segments(source, f"{base}/log", f"{base}/checkpoint").awaitTermination()
        segments.compact(spark, f"{base}/log", fan_in=2, largest=4)
    return f"{base}/log"


@query
def stream_message_count(spark: SparkSession, path: str) -> DataFrame:
    """Messages and valid ones over batches, a restart and compactions, from what the batches observed; no log file is opened."""
    messages, valid = segments.message_counts(spark, _segment_log(spark, path))
    return spark.range(1).select(F.lit(messages).cast("long").alias("messages"), F.lit(valid).cast("long").alias("valid_messages"))


@query
def stream_compacted_log(spark: SparkSession, path: str) -> DataFrame:
    """Events per date and model in the compacted log, and the messages in quarantine."""
    rows = segments.read_messages(spark, _segment_log(spark, path))
    return rows.groupBy("status", "event_date", "model").agg(F.count("*").alias("messages"), F.sum(F.coalesce("total_tokens", F.lit(0))).cast("long").alias("total_tokens"))


# --- data quality -----------------------------------------------------------------


@query
def dq_unique(spark: SparkSession, path: str) -> DataFrame:
    """Duplicated keys of the orders and readings."""
    orders = relations(spark, path)("stg_orders")
    readings = relations(spark, path)("stg_meter_readings")
    found = quality.duplicates(orders, "order_id").select(F.lit("order_id").alias("key_column"), "*")
    return found.unionByName(
        quality.duplicates(readings, "reading_id").select(F.lit("reading_id").alias("key_column"), "*")
    )


@query
def dq_not_null(spark: SparkSession, path: str) -> DataFrame:
    staged = relations(spark, path)("stg_llm_logs")
    return quality.null_counts(staged, staged.columns)


@query
def dq_accepted_values(spark: SparkSession, path: str) -> DataFrame:
    """Customer segments outside the accepted list."""
    staged = relations(spark, path)("stg_customers")
    accepted = quality.SUITE["ecommerce"]["stg_customers"].accepted["segment"]
    return quality.unaccepted(staged, "segment", accepted)


@query
def dq_report(spark: SparkSession, path: str) -> DataFrame:
    return quality.report(relations(spark, path))
