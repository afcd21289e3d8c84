"""Mergeable per-date partials of the request marts that summarise all dates.

A partial holds counts, integer sums, whole units, remainders and extremes per (date, key of the mart). All of
them merge by adding or by taking extremes, so a mart is rebuilt from one small row per date and key, and a refresh
reads raw rows of the changed dates only. The results equal those of the marts built from the whole log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.numeric import AMOUNT_SCALE, USD_SCALE, off_grid, ratio, sql_round, to_units, total
from .staging import latency_class

#: mart -> its grouping keys; a partial has the date besides
KEYS = {
    "mart_cost_per_user": ["user_id"],
    "mart_latency_analysis": ["prompt_preview", "latency_category"],
    "mart_model_comparison": ["model"],
}
_SUMS = [
    "requests", "tokens", "tokens_n", "latency", "latency_n", "cost_units", "cost_rest", "cost_n", "seconds_units", "seconds_rest",
    "seconds_n", "fast", "medium", "slow",
]
_EXTREMES = {"latency_min": F.min, "latency_max": F.max, "cost_min": F.min, "cost_max": F.max}


def daily(logs: DataFrame, mart: str) -> DataFrame:
    """Partials of a mart: (request_date, its keys, measures)."""

    def amount(name: str, value: Column, scale: int) -> list[Column]:
        return [
            F.sum(to_units(value, scale)).alias(f"{name}_units"), F.sum(off_grid(value, scale)).alias(f"{name}_rest"),
            F.count(value).alias(f"{name}_n"),
        ]

    return logs.groupBy("request_date", *KEYS[mart]).agg(
        F.count("*").alias("requests"),
        F.sum("total_tokens").alias("tokens"), F.count("total_tokens").alias("tokens_n"),
        F.sum("latency_ms").alias("latency"), F.count("latency_ms").alias("latency_n"),
        F.min("latency_ms").alias("latency_min"), F.max("latency_ms").alias("latency_max"),
        *amount("cost", F.col("cost_usd"), USD_SCALE), F.min("cost_usd").alias("cost_min"), F.max("cost_usd").alias("cost_max"),
        *amount("seconds", F.col("latency_sec"), AMOUNT_SCALE),
        *[F.count_if(F.col("latency_category") == kind).alias(kind) for kind in ("fast", "medium", "slow")],
    )


def merged(partials: DataFrame, mart: str) -> DataFrame:
    """A mart from its partials of all dates."""
    whole = partials.groupBy(*KEYS[mart]).agg(
        *[F.sum(name).alias(name) for name in _SUMS], *[how(name).alias(name) for name, how in _EXTREMES.items()]
    )
    cost = F.col("cost_units"), F.col("cost_rest")
    seconds = F.col("seconds_units"), F.col("seconds_rest"), F.col("seconds_n")
    mean_latency = F.col("latency") / F.nullif(F.col("latency_n"), F.lit(0))
    mean_tokens = F.round(F.col("tokens") / F.nullif(F.col("tokens_n"), F.lit(0)), 0)

    def mean_cost(places: int) -> Column:
        return ratio(*cost, F.col("cost_n"), places, USD_SCALE)

    columns = {
        "mart_cost_per_user": {
            "user_id": F.col("user_id"), "total_requests": F.col("requests"), "total_tokens": F.col("tokens"),
            "total_cost_usd": total(*cost, 4, USD_SCALE), "avg_cost_per_request": mean_cost(4),
            "avg_latency_ms": F.round(mean_latency, 0), "avg_tokens_per_request": mean_tokens,
            "max_cost_usd": sql_round(F.col("cost_max"), 4),
            "fast_requests": F.col("fast"), "medium_requests": F.col("medium"), "slow_requests": F.col("slow"),
        },
        "mart_latency_analysis": {
            "prompt_preview": F.col("prompt_preview"), "times_asked": F.col("requests"), "avg_latency_ms": F.round(mean_latency, 0),
            "avg_latency_sec": ratio(*seconds, 2), "avg_tokens": mean_tokens, "avg_cost_usd": mean_cost(4),
            "total_cost_usd": total(*cost, 4, USD_SCALE), "latency_category": F.col("latency_category"),
        },
        "mart_model_comparison": {
            "model": F.col("model"), "total_requests": F.col("requests"), "total_cost_usd": total(*cost, 6, USD_SCALE),
            "avg_cost_usd": mean_cost(6), "min_cost_usd": sql_round(F.col("cost_min"), 6), "max_cost_usd": sql_round(F.col("cost_max"), 6),
            "avg_latency_ms": F.round(mean_latency, 0), "min_latency_ms": F.col("latency_min"), "max_latency_ms": F.col("latency_max"),
            "avg_tokens": mean_tokens, "total_tokens": F.col("tokens"),
            "tokens_per_dollar": F.round(
                F.col("tokens") * F.lit(float(10**USD_SCALE)) / F.nullif(cost[0] + cost[1] * F.lit(float(10**USD_SCALE)), F.lit(0)), 0),
            "speed_category": latency_class(mean_latency, C.MODEL_FAST_BELOW_MS),
        },
    }
    return whole.select(*[value.alias(name) for name, value in columns[mart].items()])
