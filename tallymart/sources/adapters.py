"""The bundled test tables in the shape of the raw tables.

``raw_tables(spark, path)`` returns one lazy DataFrame per raw table. Readings, weather and request
logs are projections of ``events``; order rows come from joining the order tables on their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import calendar, pricing
from ..functions.numeric import sql_round
from .events import ISO_MICROS

READINGS_PER_PAYLOAD = 24

# declared, so that opening a table needs no job to infer its schema
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "benchmark": "item_id bigint, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}.parquet")


def _pick(rows: list[tuple], position: int, index: Column) -> Column:
    """Attribute ``position`` of the fixed row chosen by a zero-based index column."""
    return F.element_at(F.array(*[F.lit(row[position]) for row in rows]), (index + 1).cast("int"))


# --- e-commerce -------------------------------------------------------------------


def customers(spark: SparkSession, path: str) -> DataFrame:
    nation = table(spark, path, "nation")
    age = (F.col("c_custkey") % 700).cast("int")
    return (
        table(spark, path, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
            F.date_sub(F.lit("2000-01-01").cast("date"), age).alias("registration_date"),
        )
    )


def products(spark: SparkSession, path: str) -> DataFrame:
    price = F.col("p_retailprice")
    cost = sql_round(price * F.lit(0.55), 2)
    return table(spark, path, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        price.alias("price_eur"),
        cost.alias("cost_eur"),
        pricing.margin_percent(price, cost).alias("margin_pct"),
    )


def _status() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "N", "completed").when(flag == "R", "returned").when(flag == "A", "cancelled")


def _order_id() -> Column:
    return F.concat_ws("_", F.lit("ORD"), "l_orderkey", "l_linenumber")


def order_heads(spark: SparkSession, path: str) -> DataFrame:
    """Orders with keys only, before customer attributes are copied onto them."""
    return table(spark, path, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").cast("string").alias("customer_id"), F.to_date("o_orderdate").alias("order_date")
    )


def order_items(spark: SparkSession, path: str) -> DataFrame:
    """Order lines with keys only, before product attributes are copied onto them."""
    return table(spark, path, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        _order_id().alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        _status().alias("status"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def orders(spark: SparkSession, path: str) -> DataFrame:
    """Order rows. The lines meet their parts while the order heads meet their customers.

    Both results are then joined on the order key, so the long table is shuffled once per key it
    is looked up by and never with the customer attributes on board. Small sides are broadcast,
    and oversized partitions split, from the sizes AQE measures.
    """
    nation = table(spark, path, "nation").select("n_nationkey", "n_name")
    buyers = (
        table(spark, path, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_name")
    )
    heads = (
        table(spark, path, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    parts = table(spark, path, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
    joined = (
        table(spark, path, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    total = F.col("l_extendedprice")
    cost = sql_round(F.col("l_quantity") * F.col("p_retailprice") * F.lit(0.55), 2)
    day = F.to_date("o_orderdate")
    return joined.select(
        _order_id().alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        _status().alias("status"),
        calendar.is_weekend(day).alias("is_weekend"),
        day.alias("order_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        sql_round(total / F.col("l_quantity"), 2).alias("unit_price_eur"),
        total.alias("total_eur"),
        cost.alias("total_cost_eur"),
        pricing.margin(total, cost).alias("margin_eur"),
    )


# --- energy -------------------------------------------------------------------------


def meter_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings whose stored hour differs from the clock hour, as in the raw table."""
    site = F.col("user_id") % len(C.SITES)
    site_id = _pick(C.SITES, 0, site)
    ts, kwh = F.col("ts"), F.col("value")
    return table(spark, path, "events").select(
        calendar.reading_key(site_id, ts).alias("reading_id"),
        site_id.alias("site_id"),
        _pick(C.SITES, 1, site).alias("city"),
        _pick(C.SITES, 2, site).alias("site_type"),
        calendar.day_name(ts).alias("day_of_week"),
        ts.alias("timestamp"),
        (F.col("event_id") % 24).cast("int").alias("hour"),
        calendar.is_weekend(ts).alias("is_weekend"),
        kwh.alias("consumption_kwh"),
        pricing.tariff_cost(kwh).alias("cost_eur"),
    )


# --- weather ------------------------------------------------------------------------


def _weather_values() -> dict[str, Column]:
    event, value = F.col("event_id"), F.col("value")
    return {
        "temperature_c": sql_round(value - F.lit(10.0), 2),
        "humidity_pct": (event % 101).cast("double"),
        "wind_speed_kmh": sql_round(value * F.lit(0.5), 2),
        "precipitation_mm": F.when(event % 4 == 0, value).otherwise(F.lit(0.0)),
        "cloud_cover_pct": (event % 97).cast("double"),
    }


def hourly_weather(spark: SparkSession, path: str) -> DataFrame:
    city = F.col("user_id") % len(C.CITIES)
    ts = F.col("ts")
    return table(spark, path, "events").select(
        _pick(C.CITIES, 0, city).alias("city"),
        _pick(C.CITIES, 1, city).alias("latitude"),
        _pick(C.CITIES, 2, city).alias("longitude"),
        ts.alias("timestamp"),
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        calendar.day_name(ts).alias("day_of_week"),
        (F.col("event_id") % 2).cast("boolean").alias("is_day"),
        *[value.alias(name) for name, value in _weather_values().items()],
    )


def weather_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Events as nested payloads of 24 readings each.

    The grouping key is the unique event id divided by 24, so no group exceeds 24 rows however the
    users or types are distributed.
    """
    values = _weather_values()
    payload = F.expr(f"event_id div {READINGS_PER_PAYLOAD}")
    reading = F.struct(
        "event_id",
        F.date_format("ts", ISO_MICROS).alias("time"),
        values["temperature_c"].alias("temperature_2m"),
        values["humidity_pct"].alias("relative_humidity_2m"),
        values["wind_speed_kmh"].alias("wind_speed_10m"),
        values["precipitation_mm"].alias("precipitation"),
        values["cloud_cover_pct"].alias("cloud_cover"),
        (F.col("event_id") % 2).cast("int").alias("is_day"),
    )
    grouped = table(spark, path, "events").groupBy(payload.alias("payload")).agg(
        F.array_sort(F.collect_list(reading)).alias("r")
    )
    names = [
        "time", "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "precipitation",
        "cloud_cover", "is_day",
    ]
    return grouped.select(
        _pick(C.CITIES, 0, F.col("payload") % len(C.CITIES)).alias("city"),
        F.struct(*[F.col(f"r.{name}").alias(name) for name in names]).alias("hourly"),
    )


# --- request logs -------------------------------------------------------------------


def llm_logs_kafka(spark: SparkSession, path: str) -> DataFrame:
    """Request log: every event carries a prompt of ``benchmark``, taken in turn."""
    log_events = table(spark, path, "events")
    prompts = table(spark, path, "benchmark").select("item_id", "text")
    turn = F.col("event_id") % prompts.agg(F.count("*")).scalar()
    kind, event, value = F.col("event_type"), F.col("event_id"), F.col("value")
    input_tokens, output_tokens = F.col("input_tokens"), (event % 997).cast("int")
    delay = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), ((event % 5000 * 1000 + 500) / F.lit(1e6)).cast("decimal(18,6)")
    )
    return (
        log_events
        .withColumn("item_id", turn)
        .withColumn("input_tokens", F.get_json_object("props", "$.k").cast("int"))
        .join(prompts, "item_id")
        .select(
            F.col("ts").alias("timestamp"),
            F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
            F.when(kind == "view", "phi3")
            .when(kind == "click", "llama3.2")
            .when(kind == "purchase", "mistral")
            .otherwise(kind)
            .alias("model"),
            F.col("text").alias("prompt"),
            F.col("props").alias("response"),
            input_tokens.alias("prompt_tokens"),
            output_tokens.alias("output_tokens"),
            (input_tokens + output_tokens).alias("total_tokens"),
            F.floor(value * F.lit(100.0)).cast("int").alias("latency_ms"),
            (value / F.lit(1000.0)).alias("cost_usd"),
            (F.col("ts") + delay).alias("consumed_at"),
        )
    )


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """Every conversation turn and every document as a prompt to route: (source, prompt_id, prompt)."""
    turns = table(spark, path, "conversations").select(
        F.lit("conversations").alias("source"),
        F.concat_ws("-", "conv_id", "turn").alias("prompt_id"),
        F.col("text").alias("prompt"),
    )
    documents = table(spark, path, "documents").select(
        F.lit("documents").alias("source"),
        F.col("doc_id").cast("string").alias("prompt_id"),
        F.col("text").alias("prompt"),
    )
    return turns.unionByName(documents)


BY_DOMAIN = {
    "energy": {"meter_readings": meter_readings},
    "ecommerce": {"products": products, "customers": customers, "orders": orders},
    "weather": {"hourly_weather": hourly_weather},
    "requests": {"llm_logs_kafka": llm_logs_kafka},
}


RAW = {name: build for tables in BY_DOMAIN.values() for name, build in tables.items()}


def raw_tables(spark: SparkSession, path: str, domain: str) -> dict[str, DataFrame]:
    return {name: build(spark, path) for name, build in BY_DOMAIN[domain].items()}
