from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallymart.functions import calendar, numeric, pricing, prompts
from tallymart.operators import enrich
from tallymart.sources import dimensions

L = F.lit


@pytest.mark.parametrize(
    "value, places, expected", [(1.005, 2, 1.0), (2.675, 2, 2.68), (-0.5, 0, -1.0), (0.125, 2, 0.13), (None, 2, None)]
)
def test_sql_round(one, value, places, expected):
    assert one(numeric.sql_round(L(value).cast("double"), places)) == (expected,)


def test_sums_do_not_depend_on_row_order(spark):
    values = [0.1, 0.2, 0.3, 1234567.89, 0.05] * 200
    for rows in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(7)
        got = df.agg(numeric.exact_sum(F.col("v"), 2), numeric.exact_avg(F.col("v"), 2)).first()
        assert tuple(got) == (246913708.0, 246913.71)


def test_average_leaves_out_nulls_and_keeps_exact_ties(spark):
    df = spark.createDataFrame([(0.01,), (0.02,), (None,)], "v double")
    assert df.agg(numeric.exact_avg(F.col("v"), 2)).first()[0] == 0.02
    assert df.filter("v is null").agg(numeric.exact_avg(F.col("v"), 2)).first()[0] is None


def test_a_sum_too_large_raises_instead_of_wrapping(spark):
    df = spark.createDataFrame([(9e14,), (9e14,)], "v double")
    with pytest.raises(Exception, match="(?i)overflow"):
        df.agg(numeric.exact_sum(F.col("v"), 2)).collect()


def test_calendar_boundaries(one):
    saturday, monday = L(datetime(2024, 1, 6, 23)), L(datetime(2024, 1, 8))
    assert one(calendar.day_name(saturday), calendar.is_weekend(saturday), calendar.is_weekend(monday)) == (
        "Saturday", True, False,
    )
    assert one(*[calendar.is_peak_hour(L(h)) for h in (7, 8, 20, 21)]) == (False, True, True, False)
    assert one(calendar.is_month_end(L(date(2024, 1, 24))), calendar.is_month_end(L(date(2024, 1, 25)))) == (
        False, True,
    )


def test_lag_counts_millisecond_boundaries(one):
    early = L(datetime(2024, 1, 1, 0, 0, 0, 900)).cast("timestamp_ntz")
    late = L(datetime(2024, 1, 1, 0, 0, 0, 1100)).cast("timestamp_ntz")
    assert one(calendar.lag_millis(early, late), calendar.lag_millis(late, early)) == (1, -1)


def test_keys(one):
    moment = L(datetime(2024, 1, 2, 3, 59))
    assert one(
        calendar.reading_key(L("SITE_001"), moment), calendar.order_key(L(7)), calendar.product_key(L(7)),
        calendar.customer_key(L(7)), calendar.order_key(L(1234567)),
    ) == ("SITE_001_2024010203", "ORD_000007", "PROD_007", "CUST_0007", "ORD_1234567")


def test_prices(one):
    assert one(
        pricing.tariff_cost(L(1.0)), pricing.line_amount(L(19.99), L(3)), pricing.margin(L(59.97), L(20.0)),
        pricing.margin_percent(L(200.0), L(150.0)), pricing.margin_percent(L(0.0), L(1.0)),
        pricing.expected_kwh(L(2.5), L(12), L(True)), pricing.expected_kwh(L(12.0), L(7), L(False)),
    ) == (0.28, 59.97, 39.97, 25.0, None, 2.45, 7.2)


@pytest.mark.parametrize(
    "model, expected", [("phi3", 0.00005), ("llama3.2", 0.0005), ("mistral", 0.0014), ("other", 9.0), (None, 9.0)]
)
def test_model_cost(spark, one, model, expected):
    name = L(model).cast("string")
    assert one(pricing.model_cost(name, L(100), L(200), L(9.0))) == (expected,)
    log = spark.createDataFrame([(model, 100, 200, 9.0)], "model string, prompt_tokens int, output_tokens int, cost_usd double")
    assert enrich.recompute_cost(log, dimensions.model_rates(spark)).first()["cost_usd"] == expected


def test_known_model_without_tokens_has_no_cost(spark, one):
    none = L(None).cast("int")
    assert one(pricing.model_cost(L("phi3"), none, L(1), L(9.0))) == (None,)
    log = spark.createDataFrame([("phi3", None, 200, 9.0)], "model string, prompt_tokens int, output_tokens int, cost_usd double")
    assert enrich.recompute_cost(log, dimensions.model_rates(spark)).first()["cost_usd"] is None


def test_flat_cost(one):
    assert one(pricing.flat_cost(L(100), L(200))) == (0.007,)


ROUTES = [
    ("What is dbt?", 3, "phi3"),
    ("Define Kafka.", 2, "phi3"),
    ("What is SQL?", 3, "phi3"),
    ("Write a Python function that reads a CSV and loads it into DuckDB", 13, "mistral"),
    ("Debug this SQL query: SELECT * FROM orders WHERE date > '2024-01-01'", 12, "mistral"),
    ("How do I configure a Kafka consumer group in Python?", 10, "mistral"),
    ("What are the best practices for data engineering?", 8, "phi3"),
    ("Explain the medallion architecture in simple terms", 7, "phi3"),
    ("What is the difference between a data lake and a data warehouse?", 12, "llama3.2"),
    ("My salary is 5000 EUR, how should I optimize my taxes?", 11, "phi3"),
    ("How can a small team plan rapid growth over the coming year", 12, "mistral"),
    ("please list every classname that you can see in this long sentence", 12, "phi3"),
    ("one " * 30, 30, "llama3.2"),
    ("one " * 31, 31, "mistral"),
    ("MY PASSWORD " + "word " * 40, 42, "phi3"),
    ("word " * 5000 + "password", 5001, "phi3"),
    ("", 0, "phi3"),
    (None, None, None),
]


def test_routing(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in ROUTES], "prompt string")
    got = enrich.route(df, words="words").collect()
    assert [(r.prompt, r.words, r.model) for r in got] == ROUTES


def test_words_split_like_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"a{s}b" for s in spaces] + ["  lead", "trail \n", "\t", "a​b", "x\xa0 y", "é  ü"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", prompts.word_count(F.col("t")).alias("n"), prompts.has_text(F.col("t")).alias("some"))
    assert {(r.t, r.n, r.some) for r in got.collect()} == {(t, len(t.split()), bool(t.strip())) for t in texts}


def test_preview_counts_characters_not_bytes(one):
    assert one(prompts.preview(L("é" * 60)), prompts.preview(L("short"))) == ("é" * 50, "short")


def test_empty_prompts_are_dropped(spark):
    df = spark.createDataFrame([("x",), ("",), ("  \n",), (None,), (" y ",)], "prompt string")
    assert [r.prompt for r in enrich.drop_empty_prompts(df).collect()] == ["x", " y "]
