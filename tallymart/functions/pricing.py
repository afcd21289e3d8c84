"""Tariffs, expected load, order-line maths and token costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .calendar import is_peak_hour
from .numeric import sql_round


def tariff_cost(kwh: Column) -> Column:
    return sql_round(kwh * F.lit(C.TARIFF_EUR_PER_KWH), 4)


def expected_kwh(base_kwh: Column, hour: Column, weekend: Column) -> Column:
    """Load expected for a site type: its base, raised in peak hours and lowered on weekends."""
    by_hour = F.when(is_peak_hour(hour), F.lit(C.PEAK_FACTOR)).otherwise(F.lit(C.OFF_PEAK_FACTOR))
    by_day = F.when(weekend, F.lit(C.WEEKEND_FACTOR)).otherwise(F.lit(C.WEEKDAY_FACTOR))
    return sql_round(base_kwh * by_hour * by_day, 4)


def line_amount(unit_amount: Column, quantity: Column) -> Column:
    return sql_round(unit_amount * quantity, 2)


def margin(total: Column, cost: Column) -> Column:
    return sql_round(total - cost, 2)


def margin_percent(price: Column, cost: Column) -> Column:
    return sql_round((price - cost) / F.nullif(price, F.lit(0.0)) * F.lit(100.0), 1)


def token_cost(input_tokens: Column, output_tokens: Column, input_rate: Column, output_rate: Column) -> Column:
    """USD for one request at rates per 1,000 tokens, not rounded."""
    per = F.lit(1000.0)
    return (input_tokens / per) * input_rate + (output_tokens / per) * output_rate


def flat_cost(input_tokens: Column, output_tokens: Column) -> Column:
    return sql_round(
        token_cost(input_tokens, output_tokens, F.lit(C.FLAT_INPUT_RATE), F.lit(C.FLAT_OUTPUT_RATE)), 6
    )


def model_cost(model: Column, input_tokens: Column, output_tokens: Column, otherwise: Column) -> Column:
    """Cost by the model's own rates; models without a card keep ``otherwise``.

    Three fixed cards fit in one conditional, so staging stays a pure projection with no join.
    A card kept as a table goes through :func:`tallymart.operators.enrich.recompute_cost`.
    """
    priced = None
    for name, input_rate, output_rate, _ in C.MODEL_RATES:
        amount = token_cost(input_tokens, output_tokens, F.lit(input_rate), F.lit(output_rate))
        priced = F.when(model == name, amount) if priced is None else priced.when(model == name, amount)
    return sql_round(priced.otherwise(otherwise), 6)
