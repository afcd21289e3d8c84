from datetime import date, datetime

import pytest
from conftest import plan
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.operators import anomaly, enrich, marts, staging
from tallymart.sources import dimensions


def test_staging_casts_renames_and_drops_bookkeeping(spark):
    raw = spark.createDataFrame(
        [("r", "s", "c", "residential", "2024-01-06T10:00:00", 3, "Saturday", 1, "1.5", 0.42, "x")],
        "reading_id string, site_id string, city string, site_type string, timestamp string, hour int, "
        "day_of_week string, is_weekend int, consumption_kwh string, cost_eur double, _loader_id string",
    )
    staged = staging.stg_meter_readings(raw)
    assert staged.schema.names == schemas.METER_READINGS.names
    row = staged.first()
    assert row.reading_timestamp == datetime(2024, 1, 6, 10) and row.is_weekend is True
    assert row.reading_hour == 3 and row.consumption_kwh == 1.5


def test_fraction_to_integer_rounds(spark, orders):
    raw = orders({}).drop("quantity")
    assert staging.stg_orders(raw.withColumn("quantity", F.lit(2.6))).first().quantity == 3
    assert staging.stg_orders(raw.withColumn("quantity", F.lit("2.5").cast("decimal(3,1)"))).first().quantity == 3


def test_revenue_and_profit_only_when_completed(orders):
    staged = staging.stg_orders(orders({}, {"status": "returned"}, {"status": None}))
    assert [(r.revenue_eur, r.profit_eur) for r in staged.collect()] == [(10.0, 6.0), (0.0, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize(
    "latency, expected", [(2999, "fast"), (3000, "medium"), (9999, "medium"), (10000, "slow"), (None, "slow")]
)
def test_latency_category(logs, latency, expected):
    assert staging.stg_llm_logs(logs({"latency_ms": latency})).first().latency_category == expected


def test_staged_log(logs):
    row = staging.stg_llm_logs(logs({"model": "mistral", "latency_ms": 1005})).first()
    assert (row.cost_usd, row.latency_sec, row.kafka_lag_ms, row.request_hour) == (0.0014, 1.0, 1000, 10)
    assert row.request_date == date(2024, 1, 1)
    assert "response" not in row.asDict()


def test_model_speed_uses_its_own_limits(logs):
    for latency, expected in ((4999, "fast"), (5000, "medium"), (10000, "slow")):
        staged = staging.stg_llm_logs(logs({"latency_ms": latency}))
        assert marts.mart_model_comparison(staged).first().speed_category == expected


def test_tokens_per_dollar_without_cost_is_null(logs):
    staged = staging.stg_llm_logs(logs({"model": "other", "cost_usd": 0.0}))
    assert marts.mart_model_comparison(staged).first().tokens_per_dollar is None


def test_customer_segments(spark, orders):
    customers = spark.createDataFrame(
        [("c1", "DE", "vip", date(2023, 1, 1)), ("c2", "DE", "vip", date(2023, 1, 1)),
         ("c3", "DE", "vip", date(2023, 1, 1)), ("c1", "FR", "vip", date(2023, 1, 1))],
        schemas.CUSTOMERS,
    )
    staged = staging.stg_orders(
        orders({}, {"total_eur": 5.0}, {"customer_id": "c2", "status": "returned"}, {"customer_id": "nobody"},
               {"customer_id": None}, {"order_id": None, "total_eur": None})
    )
    got = {r.country: r for r in marts.mart_customer_segments(customers, staged).collect()}
    # c2 has no completed order and c3 none at all; a customer listed twice counts in both places
    assert set(got) == {"DE", "FR"}
    for row in got.values():
        assert (row.total_customers, row.total_orders, row.total_revenue_eur) == (1, 2, 15.0)
        assert (row.avg_order_value_eur, row.revenue_per_customer_eur) == (7.5, 15.0)


def test_customer_segments_equals_the_plain_join(spark, orders):
    changes = [
        {"customer_id": f"c{i % 7}" if i % 3 else "c0", "total_eur": i / 4, "status": ["completed", "returned"][i % 2]}
        for i in range(300)
    ]
    customers = spark.createDataFrame(
        [(f"c{i}", "DE" if i % 2 else "FR", "vip", None) for i in range(9)], schemas.CUSTOMERS
    )
    staged = staging.stg_orders(orders(*changes))
    customers.createOrReplaceTempView("c")
    staged.createOrReplaceTempView("o")
    plain = spark.sql(
        "SELECT c.segment, c.country, count(DISTINCT o.customer_id), count(o.order_id), round(sum(o.revenue_eur), 2) "
        "FROM c LEFT JOIN o USING (customer_id) WHERE o.status = 'completed' GROUP BY ALL"
    )
    ours = marts.mart_customer_segments(customers, staged).select(
        "segment", "country", "total_customers", "total_orders", "total_revenue_eur"
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_revenue_mart_totals(orders):
    staged = staging.stg_orders(
        orders({}, {"status": "returned", "unit_price_eur": 11.01}, {"status": "cancelled", "quantity": 4}, {"status": "odd"})
    )
    row = marts.mart_revenue_daily(staged).first()
    assert (row.total_orders, row.total_units) == (4, 7)
    assert (row.completed_orders, row.returned_orders, row.cancelled_orders) == (1, 1, 1)
    assert (row.gross_revenue_eur, row.net_revenue_eur, row.profit_eur) == (40.0, 10.0, 6.0)
    assert row.avg_order_value_eur == 10.25


def test_presentation_order(orders):
    staged = staging.stg_orders(
        orders({"country": "A"}, {"country": "B", "total_eur": 30.0}, {"country": "C", "order_date": date(2024, 1, 1)}, {"order_date": None})
    )
    got = marts.present(marts.mart_revenue_daily(staged), "mart_revenue_daily").collect()
    assert [r.country for r in got] == ["C", "B", "A", "X"]


def test_trailing_days(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3, 9)]
    raw = spark.createDataFrame(
        [("Iasi", d, 1.0, 2.0, 3.0) for d in days],
        "city string, date date, temperature_c double, humidity_pct double, precipitation_mm double",
    )
    row = marts.weather_city_7d(raw, as_of=F.lit(date(2024, 1, 9))).first()
    assert row.total_rain_mm == 9.0
    assert marts.weather_city_7d(raw).count() == 0  # all long before today


def test_trailing_days_reach_the_scan(spark, tmp_path):
    columns = "city string, date date, temperature_c double, humidity_pct double, precipitation_mm double"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "w"))
    mart = marts.weather_city_7d(spark.read.schema(columns).parquet(str(tmp_path / "w")), as_of=F.lit(date(2024, 1, 9)))
    assert "GreaterThanOrEqual(date,2024-01-02)" in mart._jdf.queryExecution().executedPlan().toString()


def _costs(logs, *pairs):
    hour = {"now": datetime(2024, 1, 1, 12), "hour": datetime(2024, 1, 1, 11), "old": datetime(2023, 1, 1)}
    rows = [{"model": "x", "timestamp": hour[when], "cost_usd": cost} for when, cost in pairs]
    staged = staging.stg_llm_logs(logs(*rows))
    as_of = F.lit(datetime(2024, 1, 1, 12)).cast("timestamp_ntz")
    return anomaly.cost_anomaly(staged, as_of=as_of).first()


def test_anomaly_boundaries(logs):
    exactly = _costs(logs, ("now", 3.0), ("old", 0.5), ("old", 0.25), ("old", 0.25))  # mean 1
    assert (exactly.avg_cost_usd, exactly.max_cost_usd, exactly.cost_ratio, exactly.is_anomaly) == (1.0, 3.0, 3.0, False)
    assert _costs(logs, ("hour", 3.0004), ("old", 0.5), ("old", 0.2496), ("old", 0.25)).is_anomaly
    empty = _costs(logs, ("old", 100.0))
    assert empty.max_cost_usd is None and empty.is_anomaly is False
    assert _costs(logs, ("now", 0.0001), *[("old", 0.0)] * 9).is_anomaly is False  # mean rounds to 0


def test_top_user_breaks_ties(logs):
    staged = staging.stg_llm_logs(
        logs(*[{"user_id": u, "model": "x", "cost_usd": c} for u, c in (("b", 1.0), ("a", 0.5), ("a", 0.5), ("c", 0.1))])
    )
    assert tuple(anomaly.top_cost_user(staged).first()) == ("a", 1.0)


def test_order_lines_keep_unmatched(spark):
    lines = spark.createDataFrame(
        [("o1", "c1", "p1", date(2024, 1, 6), "completed", 3), ("o2", "c9", None, date(2024, 1, 8), "returned", 1)],
        "order_id string, customer_id string, product_id string, order_date date, status string, quantity int",
    )
    customers = spark.createDataFrame([("c1", "DE", "vip", None)], schemas.CUSTOMERS)
    products = spark.createDataFrame([("p1", "n", "Books", "B", 9.99, 5.01, 50.0)], schemas.raw_form(schemas.PRODUCTS))
    got = {r.order_id: r for r in enrich.order_lines(lines, customers, products).collect()}
    full = got["o1"]
    assert (full.total_eur, full.total_cost_eur, full.margin_eur, full.is_weekend) == (29.97, 15.03, 14.94, True)
    assert got["o2"].country is None and got["o2"].total_eur is None and got["o2"].is_weekend is False


def test_plans(spark, orders, logs):
    customers = spark.createDataFrame([("c1", "DE", "vip", None)], schemas.CUSTOMERS)
    staged = staging.stg_orders(orders({}))
    segments = plan(marts.mart_customer_segments(customers, staged))
    assert "LeftOuter" not in segments
    priced = plan(enrich.recompute_cost(logs({}), dimensions.model_rates(spark)))
    assert "BroadcastHashJoin" in priced
    assert "Join" not in plan(staging.stg_llm_logs(logs({}))).split("Physical Plan")[1]


def test_segments_shuffle_orders_once(spark, tmp_path, orders):
    """The join and the per-member grouping reuse the partitioning made for the per-customer sums."""
    orders({}).write.parquet(str(tmp_path / "o"))
    spark.createDataFrame([("c1", "DE", "vip", None)], schemas.CUSTOMERS).write.parquet(str(tmp_path / "c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mart = marts.mart_customer_segments(
            spark.read.parquet(str(tmp_path / "c")), staging.stg_orders(spark.read.parquet(str(tmp_path / "o")))
        )
        physical = mart._jdf.queryExecution().executedPlan().toString()
        assert physical.count("Exchange hashpartitioning(customer_id") == 2  # one per input
        assert physical.count("Exchange") == 3  # and one for (segment, country)
        assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed), IsNotNull(customer_id)]" in physical
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
