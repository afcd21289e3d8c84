"""Cost alert and top spender over the staged request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.numeric import USD_SCALE, exact_avg, exact_sum, ratio, sql_round


def cost_anomaly(logs: DataFrame, as_of: Column | None = None, factor: float = C.ANOMALY_FACTOR) -> DataFrame:
    """One row: mean cost, dearest request of the last hour, and whether it exceeds factor x mean.

    Both aggregates come from one pass. They are compared after rounding to 4 decimals, so a mean
    that rounds to 0 raises no alert, and neither does an hour without requests.
    """
    now = as_of if as_of is not None else F.localtimestamp()
    recent = F.col("request_timestamp") >= now - F.expr("INTERVAL 1 HOUR")
    totals = logs.agg(
        exact_avg(F.col("cost_usd"), 4, USD_SCALE).alias("avg_cost_usd"),
        sql_round(F.max(F.when(recent, F.col("cost_usd"))), 4).alias("max_cost_usd"),
    )
    return _judged(totals, factor)


def alert_from_partials(days: DataFrame, recent_logs: DataFrame, as_of: Column, factor: float = C.ANOMALY_FACTOR) -> DataFrame:
    """``cost_anomaly`` without a scan of the whole log: the mean from stored per-date partials, the last hour from recent rows."""
    mean = days.agg(
        ratio(F.sum("cost_units"), F.sum("cost_rest"), F.sum("cost_n"), 4, USD_SCALE).alias("avg_cost_usd")
    )
    hour = recent_logs.where(F.col("request_timestamp") >= as_of - F.expr("INTERVAL 1 HOUR"))
    dearest = hour.agg(sql_round(F.max("cost_usd"), 4).alias("max_cost_usd"))
    return _judged(mean.withColumn("one", F.lit(1)).join(dearest.withColumn("one", F.lit(1)), "one").drop("one"), factor)


def _judged(totals: DataFrame, factor: float) -> DataFrame:
    mean, dearest = F.col("avg_cost_usd"), F.col("max_cost_usd")
    alert = (dearest != 0) & (mean != 0) & (dearest > mean * F.lit(float(factor)))
    return totals.select(
        "*",
        sql_round(dearest / F.nullif(mean, F.lit(0.0)), 1).alias("cost_ratio"),
        F.coalesce(alert, F.lit(False)).alias("is_anomaly"),
    )


def dearest_user(mart: DataFrame) -> DataFrame:
    """``top_cost_user`` from ``mart_cost_per_user``, which has the same totals."""
    order = F.desc_nulls_last("total_cost_usd"), F.asc_nulls_last("user_id")
    return mart.select("user_id", "total_cost_usd").orderBy(*order).limit(1)


def top_cost_user(logs: DataFrame) -> DataFrame:
    """The user with the highest total cost; equal totals go to the lower user_id."""
    return (
        logs.groupBy("user_id")
        .agg(exact_sum(F.col("cost_usd"), 4, USD_SCALE).alias("total_cost_usd"))
        .orderBy(F.desc_nulls_last("total_cost_usd"), F.asc_nulls_last("user_id"))
        .limit(1)
    )
