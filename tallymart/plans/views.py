"""Staging relations as views of the catalog, so that other sessions can query them.

A view is SQL text over the stored raw table, generated from the declared schemas and the fixed values; it says the same as
:mod:`tallymart.operators.staging` (``tests/test_views_incremental.py`` compares every column). Raw columns keep the
type they were loaded with, so casts are chosen from the table's own schema.
"""

from __future__ import annotations

from pyspark.sql.types import DecimalType, FractionalType, IntegralType, StructField, StructType

from .. import constants as C
from .. import schemas
from ..sources.tables import Warehouse

#: view -> (domain, raw table)
SOURCES = {
    "stg_meter_readings": ("energy", "meter_readings"),
    "stg_orders": ("ecommerce", "orders"),
    "stg_customers": ("ecommerce", "customers"),
    "stg_products": ("ecommerce", "products"),
    "stg_weather": ("weather", "hourly_weather"),
    "stg_llm_logs": ("requests", "llm_logs_kafka"),
}
_PLAIN = {
    "stg_meter_readings": schemas.METER_READINGS, "stg_orders": schemas.ORDERS, "stg_customers": schemas.CUSTOMERS,
    "stg_products": schemas.PRODUCTS, "stg_weather": schemas.WEATHER,
}


def _cast(raw: StructType, source: str, field: StructField) -> str:
    current, target, column = raw[source].dataType, field.dataType, f"`{source}`"
    if isinstance(target, IntegralType):
        if isinstance(current, DecimalType):
            column = f"round({column}, 0)"
        elif isinstance(current, FractionalType):
            column = f"rint({column})"
    return column if current == target else f"CAST({column} AS {target.simpleString()})"


def _round(value: str, places: int) -> str:
    return f"round(({value}) * {float(10**places)!r}D, 0) / {float(10**places)!r}D"


def _micros(moment: str) -> str:
    return f"CAST(extract(SECOND FROM {moment}) * 1000000 AS BIGINT)"


def _lag(earlier: str, later: str) -> str:
    span = f"({later} - {earlier})"
    hours = f"CAST(extract(DAY FROM {span}) AS BIGINT) * 24 + extract(HOUR FROM {span})"
    micros = f"(({hours}) * 60 + extract(MINUTE FROM {span})) * 60000000 + {_micros(span)}"
    return f"CAST(({micros} + {_micros(earlier)} % 1000 - {_micros(later)} % 1000) / 1000 AS BIGINT)"


def _log_columns(raw: StructType) -> dict[str, str]:
    fields = {f.name: f for f in schemas.CONSUMED_LOG.fields}
    requested, consumed = (_cast(raw, name, fields[name]) for name in ("timestamp", "consumed_at"))
    cards = " ".join(
        f"WHEN model = '{model}' THEN (prompt_tokens / 1000.0D) * {float(price_in)!r}D + (output_tokens / 1000.0D) * {float(price_out)!r}D"
        for model, price_in, price_out, _ in C.MODEL_RATES
    )
    whole = {name: _cast(raw, name, fields[name]) for name in ("prompt_tokens", "output_tokens", "total_tokens", "latency_ms")}
    return {
        "user_id": "user_id", "model": "model", "request_timestamp": requested, "consumed_timestamp": consumed,
        "request_date": f"to_date({requested})", "request_hour": f"hour({requested})", "prompt": "prompt",
        "prompt_preview": f"left(prompt, {C.PREVIEW_CHARS})", **whole, "latency_sec": _round("latency_ms / 1000.0D", 2),
        "cost_usd": _round(f"CASE {cards} ELSE cost_usd END", 6), "kafka_lag_ms": _lag(requested, consumed),
        "latency_category": f"CASE WHEN latency_ms < {C.REQUEST_FAST_BELOW_MS} THEN 'fast' WHEN latency_ms < {C.SLOW_FROM_MS} THEN 'medium' ELSE 'slow' END",
    }


def staging_sql(name: str, raw: StructType, source: str) -> str:
    """The SELECT behind a staging view over the table ``source`` with the schema ``raw``."""
    if name in _PLAIN:
        columns = {f.name: _cast(raw, (f.metadata or {}).get("source", f.name), f) for f in _PLAIN[name].fields}
    else:
        columns = _log_columns(raw)
    if name == "stg_orders":
        for amount, source_column in (("revenue_eur", "total_eur"), ("profit_eur", "margin_eur")):
            columns[amount] = f"CASE WHEN status = '{C.COMPLETED}' THEN CAST(`{source_column}` AS DOUBLE) ELSE 0.0D END"
    return f"SELECT {', '.join(f'{value} AS `{column}`' for column, value in columns.items())} FROM {source}"


def create_staging(warehouse: Warehouse, domain: str) -> list[str]:
    """Create or replace the views of a domain in ``<prefix>staging``; its raw tables must be stored."""
    made = []
    for name, (of, table) in SOURCES.items():
        if of == domain:
            source = warehouse.name(f"raw_{domain}", table)
            text = staging_sql(name, warehouse.spark.table(source).schema, source)
            warehouse.spark.sql(f"CREATE OR REPLACE VIEW {warehouse.name('staging', name)} AS {text}")
            made.append(name)
    return made
