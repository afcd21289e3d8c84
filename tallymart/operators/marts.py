"""Marts: one grouped aggregation each, map-side combined, one shuffle on the grouping keys.

All measures merge associatively (counts, integer sums, extremes), so a key holding a large share
of the rows is reduced to one partial row per input partition before it is shuffled. Exact distinct
counts are spread over the counted value first for the same reason.

Marts come back unordered: a total order costs a second, range-partitioned shuffle that a consumer
filtering the mart does not need. ``present`` applies the presentation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.numeric import (
    USD_SCALE, exact_avg, exact_sum, off_grid, ratio, sql_round, to_units, total, whole_avg,
)
from .staging import latency_class

# mart -> presentation order, "-" for descending
PRESENTATION_ORDER = {
    "mart_energy_daily": ["reading_date", "site_id"],
    "mart_revenue_daily": ["order_date", "-net_revenue_eur"],
    "mart_customer_segments": ["-total_revenue_eur"],
    "mart_weather_daily": ["reading_date", "city"],
    "mart_cost_per_user": ["-total_cost_usd"],
    "mart_hourly_activity": ["request_date", "request_hour"],
    "mart_latency_analysis": ["-avg_latency_ms"],
    "mart_model_comparison": ["avg_cost_usd"],
    "revenue_by_category": ["-revenue_eur"],
    "weather_city_7d": ["-avg_temp_c"],
}


def sort_columns(mart: str) -> list[Column]:
    return [
        F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc_nulls_last(key)
        for key in PRESENTATION_ORDER[mart]
    ]


def present(df: DataFrame, mart: str) -> DataFrame:
    return df.orderBy(*sort_columns(mart))


def _count_where(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


# --- energy ---------------------------------------------------------------------


def mart_energy_daily(readings: DataFrame) -> DataFrame:
    """Daily consumption and cost per site."""
    kwh = F.col("consumption_kwh")
    return readings.groupBy(
        F.to_date("reading_timestamp").alias("reading_date"),
        "day_of_week", "is_weekend", "site_id", "city", "site_type",
    ).agg(
        F.count("*").alias("total_readings"),
        exact_sum(kwh, 3).alias("total_kwh"),
        exact_avg(kwh, 3).alias("avg_kwh_per_hour"),
        sql_round(F.max(kwh), 3).alias("peak_kwh"),
        sql_round(F.min(kwh), 3).alias("min_kwh"),
        exact_sum(F.col("cost_eur"), 2).alias("total_cost_eur"),
    )


# --- e-commerce -----------------------------------------------------------------


def mart_revenue_daily(orders: DataFrame) -> DataFrame:
    """Daily revenue by country, category, brand and segment.

    ``avg_order_value_eur`` is the mean unit price here, unlike in ``mart_customer_segments``.
    """
    return orders.groupBy("order_date", "country", "category", "brand", "segment", "is_weekend").agg(
        F.count("*").alias("total_orders"),
        F.sum("quantity").alias("total_units"),
        exact_sum(F.col("total_eur"), 2).alias("gross_revenue_eur"),
        exact_sum(F.col("revenue_eur"), 2).alias("net_revenue_eur"),
        exact_sum(F.col("profit_eur"), 2).alias("profit_eur"),
        exact_avg(F.col("unit_price_eur"), 2).alias("avg_order_value_eur"),
        _count_where("status", "completed").alias("completed_orders"),
        _count_where("status", "returned").alias("returned_orders"),
        _count_where("status", "cancelled").alias("cancelled_orders"),
    )


def mart_customer_segments(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Completed revenue per segment and country of the customer dimension.

    The left join of customers to orders keeps completed orders only, so it is an inner join.
    Orders are reduced to one row per customer before it: a customer with a third of all orders
    then joins as a single row, and the join and the per-customer regrouping reuse the
    partitioning that the reduction made. Only tiny (segment, country) partials are shuffled after.
    """
    per_customer = (
        orders.filter(F.col("status") == C.COMPLETED)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum(to_units(F.col("revenue_eur"))).alias("revenue"),
            F.sum(off_grid(F.col("revenue_eur"))).alias("revenue_rest"),
            F.count("revenue_eur").alias("revenue_values"),
            F.sum(to_units(F.col("profit_eur"))).alias("profit"),
            F.sum(off_grid(F.col("profit_eur"))).alias("profit_rest"),
        )
    )
    sums = [F.sum(name).alias(name) for name in (
        "orders", "revenue", "revenue_rest", "revenue_values", "profit", "profit_rest"
    )]
    by_member = (
        customers.join(per_customer, "customer_id").groupBy("customer_id", "segment", "country").agg(*sums)
    )
    summary = by_member.groupBy("segment", "country").agg(F.count("*").alias("total_customers"), *sums)
    revenue, revenue_rest = F.col("revenue"), F.col("revenue_rest")
    return summary.select(
        "segment",
        "country",
        "total_customers",
        F.col("orders").alias("total_orders"),
        total(revenue, revenue_rest, 2).alias("total_revenue_eur"),
        total(F.col("profit"), F.col("profit_rest"), 2).alias("total_profit_eur"),
        ratio(revenue, revenue_rest, F.col("revenue_values"), 2).alias("avg_order_value_eur"),
        ratio(revenue, revenue_rest, F.col("total_customers"), 2).alias("revenue_per_customer_eur"),
    )


def revenue_by_category(raw_orders: DataFrame) -> DataFrame:
    """Completed orders, revenue and profit per category, from the raw amounts."""
    return raw_orders.filter(F.col("status") == C.COMPLETED).groupBy("category").agg(
        F.count("*").alias("orders"),
        exact_sum(F.col("total_eur"), 2).alias("revenue_eur"),
        exact_sum(F.col("margin_eur"), 2).alias("profit_eur"),
    )


# --- weather --------------------------------------------------------------------


def mart_weather_daily(weather: DataFrame) -> DataFrame:
    """Daily weather per city."""
    return weather.groupBy("reading_date", "day_of_week", "city", "latitude", "longitude").agg(
        exact_avg(F.col("temperature_c"), 1).alias("avg_temp_c"),
        sql_round(F.max("temperature_c"), 1).alias("max_temp_c"),
        sql_round(F.min("temperature_c"), 1).alias("min_temp_c"),
        exact_avg(F.col("humidity_pct"), 1).alias("avg_humidity_pct"),
        exact_avg(F.col("wind_speed_kmh"), 1).alias("avg_wind_kmh"),
        sql_round(F.max("wind_speed_kmh"), 1).alias("max_wind_kmh"),
        exact_sum(F.col("precipitation_mm"), 1).alias("total_precipitation_mm"),
        exact_avg(F.col("cloud_cover_pct"), 1).alias("avg_cloud_cover_pct"),
        F.count("*").alias("hourly_readings"),
        F.sum(F.when(F.col("precipitation_mm") > 0, 1).otherwise(0)).alias("rainy_hours"),
    )


def weather_city_7d(raw_weather: DataFrame, as_of: Column | None = None, days: int = 7, since: Column | None = None) -> DataFrame:
    """Weather per city over the trailing days, counted back from ``as_of`` (today by default).

    ``date`` is compared as it is stored, so a date-typed column reaches the scan as a pushed filter. Where it is computed from
    ``timestamp``, give ``since``, the first moment that counts, in place of ``as_of``: it is compared with ``timestamp``.
    """
    recent = F.col("timestamp") >= since if since is not None else None
    if recent is None:
        day = F.col("date")
        if raw_weather.schema["date"].dataType.typeName() != "date":
            day = day.cast("date")
        recent = day >= F.date_sub(as_of if as_of is not None else F.current_date(), days)
    return raw_weather.filter(recent).groupBy("city").agg(
        exact_avg(F.col("temperature_c"), 1).alias("avg_temp_c"),
        sql_round(F.max("temperature_c"), 1).alias("max_temp_c"),
        sql_round(F.min("temperature_c"), 1).alias("min_temp_c"),
        exact_avg(F.col("humidity_pct"), 1).alias("avg_humidity_pct"),
        exact_sum(F.col("precipitation_mm"), 1).alias("total_rain_mm"),
    )


def trailing_start(rows: DataFrame, moment: str, days: int = 7) -> Column:
    """Midnight ``days`` before the day of the latest ``moment``, as a scalar subquery.

    It reads one column. The whole bound is computed inside the subquery, so a comparison of a stored column with it is
    handed to the scan once it is known, and row groups of earlier times are skipped.
    """
    return rows.agg(F.date_sub(F.max(moment), days).cast("timestamp_ntz")).scalar()


# --- request logs ---------------------------------------------------------------


def _usd(places: int, how=exact_sum) -> Column:
    return how(F.col("cost_usd"), places, USD_SCALE)


def mart_cost_per_user(logs: DataFrame) -> DataFrame:
    return logs.groupBy("user_id").agg(
        F.count("*").alias("total_requests"),
        F.sum("total_tokens").alias("total_tokens"),
        _usd(4).alias("total_cost_usd"),
        _usd(4, exact_avg).alias("avg_cost_per_request"),
        whole_avg(F.col("latency_ms")).alias("avg_latency_ms"),
        whole_avg(F.col("total_tokens")).alias("avg_tokens_per_request"),
        sql_round(F.max("cost_usd"), 4).alias("max_cost_usd"),
        _count_where("latency_category", "fast").alias("fast_requests"),
        _count_where("latency_category", "medium").alias("medium_requests"),
        _count_where("latency_category", "slow").alias("slow_requests"),
    )


def mart_hourly_activity(logs: DataFrame) -> DataFrame:
    """Traffic per hour with the exact number of users.

    The plan groups by (hour, user) before the hour alone, so a hot hour is spread over its users.
    """
    return logs.groupBy("request_date", "request_hour").agg(
        F.count("*").alias("total_requests"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("total_tokens").alias("total_tokens"),
        _usd(4).alias("total_cost_usd"),
        whole_avg(F.col("latency_ms")).alias("avg_latency_ms"),
        whole_avg(F.col("kafka_lag_ms")).alias("avg_kafka_lag_ms"),
    )


def mart_latency_analysis(logs: DataFrame) -> DataFrame:
    """Latency and cost per prompt preview and latency class."""
    return (
        logs.groupBy("prompt_preview", "latency_category")
        .agg(
            F.count("*").alias("times_asked"),
            whole_avg(F.col("latency_ms")).alias("avg_latency_ms"),
            exact_avg(F.col("latency_sec"), 2).alias("avg_latency_sec"),
            whole_avg(F.col("total_tokens")).alias("avg_tokens"),
            _usd(4, exact_avg).alias("avg_cost_usd"),
            _usd(4).alias("total_cost_usd"),
        )
        .select(
            "prompt_preview", "times_asked", "avg_latency_ms", "avg_latency_sec", "avg_tokens",
            "avg_cost_usd", "total_cost_usd", "latency_category",
        )
    )


def mart_model_comparison(logs: DataFrame) -> DataFrame:
    """Cost, latency and token efficiency per model."""
    mean_latency = F.avg("latency_ms")
    cost = F.col("cost_usd")
    cost_units = F.sum(to_units(cost, USD_SCALE)) + F.sum(off_grid(cost, USD_SCALE)) * F.lit(float(10**USD_SCALE))
    return logs.groupBy("model").agg(
        F.count("*").alias("total_requests"),
        _usd(6).alias("total_cost_usd"),
        _usd(6, exact_avg).alias("avg_cost_usd"),
        sql_round(F.min("cost_usd"), 6).alias("min_cost_usd"),
        sql_round(F.max("cost_usd"), 6).alias("max_cost_usd"),
        F.round(mean_latency, 0).alias("avg_latency_ms"),
        F.min("latency_ms").alias("min_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        whole_avg(F.col("total_tokens")).alias("avg_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round(
            F.sum("total_tokens") * F.lit(float(10**USD_SCALE)) / F.nullif(cost_units, F.lit(0)), 0
        ).alias("tokens_per_dollar"),
        latency_class(mean_latency, C.MODEL_FAST_BELOW_MS).alias("speed_category"),
    )


def log_totals(log: DataFrame) -> DataFrame:
    """Requests, cost and mean latency of a whole request log, one row."""
    return log.agg(
        F.count("*").alias("total_requests"),
        _usd(4).alias("total_cost_usd"),
        whole_avg(F.col("latency_ms")).alias("avg_latency_ms"),
    )


def transport_lag(logs: DataFrame) -> DataFrame:
    """Delay between request and ingestion per hour."""
    lag = F.col("kafka_lag_ms")
    return logs.groupBy("request_date", "request_hour").agg(
        F.count(lag).alias("requests"),
        F.min(lag).alias("min_kafka_lag_ms"),
        F.max(lag).alias("max_kafka_lag_ms"),
        whole_avg(lag).alias("avg_kafka_lag_ms"),
    )


def routing_summary(routed: DataFrame) -> DataFrame:
    """Requests, mean cost and mean latency per routed model."""
    return routed.groupBy("model").agg(
        F.count("*").alias("requests"),
        _usd(6, exact_avg).alias("avg_cost_usd"),
        whole_avg(F.col("latency_ms")).alias("avg_latency_ms"),
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every loaded table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("loaded_rows")) for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
