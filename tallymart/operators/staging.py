"""Staging relations: typed, renamed projections of the raw tables.

Each is one ``select``. Columns not declared in the schema, such as a loader's bookkeeping, drop
out, and the parquet scan below reads only what the consumer of the relation uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, StructType

from .. import constants as C
from .. import schemas
from ..functions import calendar, pricing, prompts


def _cast(df: DataFrame, source: str, target: DataType) -> Column:
    """Cast by SQL rules: a fraction cast to an integer is rounded, never truncated."""
    column, current = F.col(source), df.schema[source].dataType
    if isinstance(target, IntegralType):
        if isinstance(current, DecimalType):
            column = F.round(column, 0)
        elif isinstance(current, FractionalType):
            column = F.rint(column)
    return column if current == target else column.cast(target)


def conform(df: DataFrame, schema: StructType) -> list[Column]:
    """The columns of ``schema`` taken from ``df``, renamed and cast."""
    columns = []
    for field in schema.fields:
        source = (field.metadata or {}).get("source", field.name)
        columns.append(_cast(df, source, field.dataType).alias(field.name))
    return columns


def stg_meter_readings(raw: DataFrame) -> DataFrame:
    return raw.select(*conform(raw, schemas.METER_READINGS))


def stg_orders(raw: DataFrame) -> DataFrame:
    """Orders with the amounts that count as revenue and profit, zero unless completed."""

    def if_completed(amount: str) -> Column:
        return F.when(F.col("status") == C.COMPLETED, F.col(amount).cast("double")).otherwise(F.lit(0.0))

    return raw.select(
        *conform(raw, schemas.ORDERS),
        if_completed("total_eur").alias("revenue_eur"),
        if_completed("margin_eur").alias("profit_eur"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(*conform(raw, schemas.CUSTOMERS))


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(*conform(raw, schemas.PRODUCTS))


def stg_weather(raw: DataFrame) -> DataFrame:
    return raw.select(*conform(raw, schemas.WEATHER))


def latency_class(latency_ms: Column, fast_below: int) -> Column:
    """``fast`` / ``medium`` / ``slow``; an unknown latency counts as slow."""
    return (
        F.when(latency_ms < fast_below, "fast").when(latency_ms < C.SLOW_FROM_MS, "medium").otherwise("slow")
    )


def stg_llm_logs(raw: DataFrame) -> DataFrame:
    """Request log with uniform per-model cost, latency class, transport lag and calendar parts.

    Every derived column reads the raw column of the same name, not the alias next to it.
    """
    requested = _cast(raw, "timestamp", schemas.REQUEST_LOG["timestamp"].dataType)
    consumed = _cast(raw, "consumed_at", schemas.CONSUMED_LOG["consumed_at"].dataType)
    whole = {
        name: _cast(raw, name, schemas.REQUEST_LOG[name].dataType).alias(name)
        for name in ("prompt_tokens", "output_tokens", "total_tokens", "latency_ms")
    }
    latency = F.col("latency_ms")
    return raw.select(
        "user_id",
        "model",
        requested.alias("request_timestamp"),
        consumed.alias("consumed_timestamp"),
        F.to_date(requested).alias("request_date"),
        F.hour(requested).alias("request_hour"),
        "prompt",
        prompts.preview(F.col("prompt")).alias("prompt_preview"),
        *whole.values(),
        calendar.seconds(latency).alias("latency_sec"),
        pricing.model_cost(
            F.col("model"), F.col("prompt_tokens"), F.col("output_tokens"), F.col("cost_usd")
        ).alias("cost_usd"),
        calendar.lag_millis(requested, consumed).alias("kafka_lag_ms"),
        latency_class(latency, C.REQUEST_FAST_BELOW_MS).alias("latency_category"),
    )
