"""Amounts off the grid, non-finite numbers, unknown keys, NULL prompts and session zones."""

import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymart.functions import calendar
from tallymart.functions.numeric import exact_avg, exact_sum
from tallymart.operators import enrich
from tallymart.sources import dimensions, events, payloads


def test_amounts_off_the_grid_are_not_lost(spark):
    many = spark.range(100_000)
    assert many.select(exact_sum(F.lit(0.00004), 4)).first()[0] == 4.0
    assert many.select(exact_sum(F.lit(4e-7), 6, 6)).first()[0] == 0.04
    assert many.select(exact_avg(F.lit(0.00006), 4)).first()[0] == 0.0001


@pytest.mark.parametrize("value", [math.nan, math.inf, -math.inf, 1e300])
def test_extreme_amounts_give_what_doubles_give(spark, value):
    frame = spark.createDataFrame([(value,), (1.0,)], "x double")
    for result in frame.select(exact_sum(F.col("x"), 2), exact_avg(F.col("x"), 2)).first():
        assert math.isnan(result) if math.isnan(value) else abs(result) > 1e299


def test_mixed_amounts_and_nulls(spark):
    frame = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.00001,)], "x double")
    assert frame.select(exact_sum(F.col("x"), 5)).first()[0] == 0.30001
    assert frame.where("x is null").select(exact_sum(F.col("x"), 2)).first()[0] is None


def test_non_finite_cost_goes_to_quarantine(spark):
    text = json.dumps(dict(
        timestamp="2024-01-01T00:00:00", user_id="u", model="m", prompt="p", response="r", prompt_tokens=1, output_tokens=1,
        total_tokens=2, latency_ms=1, cost_usd=0.5,
    ))
    rows = [text, text.replace("0.5", "NaN"), text.replace("0.5", "null"), text.replace("0.5", "Infinity")]
    out = events.decode_events(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert [r.is_valid for r in out] == [True, False, True, False]


def test_unreadable_token_counter_is_zero(one):
    bodies = ['{"k": 3}', '{"k": "x"}', "{}"]
    assert one(*[events.usage_tokens(F.lit(b), "k") for b in bodies]) == (3, 0, 0)


def test_lookups_keep_rows_without_a_match(spark, logs):
    routed = enrich.routed_events(logs({}, {"prompt": None}), dimensions.model_rates(spark))
    assert sorted(str(r.model) for r in routed.collect())[0] == "None" and routed.count() == 2
    readings = spark.createDataFrame(
        [("residential", 1, False, 1.0), ("farm", 1, False, 1.0)], "site_type string, reading_hour int, is_weekend boolean, consumption_kwh double"
    )
    loads = enrich.expected_load(readings, dimensions.base_loads(spark)).collect()
    assert {r.site_type: r.expected_kwh is None for r in loads} == {"residential": False, "farm": True}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_lag_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [("2024-03-31 01:59:59", "2024-03-31 03:00:01"), ("2024-01-01 00:00:00.0009", "2024-01-01 00:00:00.0011"),
                 ("2024-01-01 00:00:00.0011", "2024-01-01 00:00:00.0009"), ("1960-01-01 00:00:00.0009", "1960-01-02 00:00:00.0001")]
        frame = spark.createDataFrame(pairs, "a string, b string").select(
            calendar.lag_millis(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("lag")
        )
        assert [r.lag for r in frame.collect()] == [3_602_000, 1, -1, 86_400_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
