"""Declared schemas. A staged field may name the raw column it comes from in its metadata."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampNTZType(),
}


def table(**columns: str) -> StructType:
    """``name="type"`` or ``name="type raw_name"`` for a renamed column."""
    fields = []
    for name, spec in columns.items():
        kind, *source = spec.split()
        fields.append(StructField(name, _TYPES[kind], True, {"source": source[0]} if source else None))
    return StructType(fields)


# --- staged relations ---------------------------------------------------------

METER_READINGS = table(
    reading_id="string", site_id="string", city="string", site_type="string", day_of_week="string",
    reading_timestamp="timestamp timestamp", reading_hour="int hour", is_weekend="boolean",
    consumption_kwh="double", cost_eur="double",
)

ORDERS = table(
    order_id="string", customer_id="string", product_id="string", country="string", segment="string",
    category="string", brand="string", status="string", is_weekend="boolean", order_date="date",
    quantity="int", unit_price_eur="double", total_eur="double", total_cost_eur="double",
    margin_eur="double",
)

CUSTOMERS = table(
    customer_id="string", country="string", segment="string", registration_date="date",
)

PRODUCTS = table(
    product_id="string", product_name="string name", category="string", brand="string",
    price_eur="double", cost_eur="double", margin_pct="double",
)

WEATHER = table(
    city="string", latitude="double", longitude="double", reading_timestamp="timestamp timestamp",
    reading_date="date date", reading_hour="int hour", day_of_week="string", is_day="boolean",
    temperature_c="double", humidity_pct="double", wind_speed_kmh="double",
    precipitation_mm="double", cloud_cover_pct="double",
)

# --- request logs ---------------------------------------------------------------

# the log written directly by a client, and the fields required in every event
REQUEST_LOG = table(
    timestamp="timestamp", user_id="string", model="string", prompt="string", response="string",
    prompt_tokens="int", output_tokens="int", total_tokens="int", latency_ms="int", cost_usd="double",
)

# the log filled from the event stream
CONSUMED_LOG = StructType(REQUEST_LOG.fields + [StructField("consumed_at", TimestampNTZType())])

# the event as JSON: its timestamp is ISO text, and Spark puts undecodable text in the last field
CORRUPT_FIELD = "_corrupt"
EVENT_JSON = StructType(
    [StructField("timestamp", StringType())]
    + REQUEST_LOG.fields[1:]
    + [StructField(CORRUPT_FIELD, StringType())]
)

# --- weather payload ------------------------------------------------------------

HOURLY_READINGS = StructType(
    [StructField("time", ArrayType(StringType()))]
    + [
        StructField(name, ArrayType(DoubleType()))
        for name in ("temperature_2m", "relative_humidity_2m", "wind_speed_10m", "precipitation", "cloud_cover")
    ]
    + [StructField("is_day", ArrayType(IntegerType()))]
)
WEATHER_PAYLOAD = StructType([StructField("city", StringType()), StructField("hourly", HOURLY_READINGS)])

# --- raw tables by domain -------------------------------------------------------


def raw_form(staged: StructType) -> StructType:
    """The schema of the raw table behind a staged one: same types under the raw names."""
    return StructType(
        [StructField((f.metadata or {}).get("source", f.name), f.dataType, True) for f in staged.fields]
    )


RAW_TABLES = {
    "energy": {"meter_readings": raw_form(METER_READINGS)},
    "ecommerce": {
        "products": raw_form(PRODUCTS),
        "customers": raw_form(CUSTOMERS),
        "orders": raw_form(ORDERS),
    },
    "weather": {"hourly_weather": raw_form(WEATHER)},
    "requests": {"llm_logs_kafka": CONSUMED_LOG},
}
