"""A key with a third of all rows: joins split it, aggregations reduce it first, results stay whole."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from tallymart.operators import enrich, marts, staging

ROWS = 60_000


@contextmanager
def settings(spark, **conf):
    conf = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in conf:
            spark.conf.unset(key)


def hot(spark):
    """Every third row belongs to customer 7, the rest are spread over 5,000 customers."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("string")
    return spark.range(0, ROWS, 1, 8).select(F.col("id").alias("n"), key.alias("customer_id"))


def customers(spark):
    return spark.range(5000).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("DE").alias("country"),
        F.when(F.col("id") % 2 == 0, "vip").otherwise("regular").alias("segment"),
    )


def test_lookup_join_splits_the_hot_customer(spark):
    lines = hot(spark).select(
        F.sha2(F.col("n").cast("string"), 512).alias("order_id"), "customer_id", F.lit("p").alias("product_id"),
        F.lit("2024-01-06").cast("date").alias("order_date"), F.lit("completed").alias("status"), F.lit(2).alias("quantity"),
    )
    products = spark.sql("SELECT 'p' AS product_id, 'Books' AS category, 'B' AS brand, 3.0D AS price_eur, 1.0D AS cost_eur")
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="100",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        joined = enrich.order_lines(lines, customers(spark), products)
        assert len(joined.collect()) == ROWS
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_marts_reduce_the_hot_customer_before_the_shuffle(spark):
    raw = hot(spark).select(
        F.col("n").cast("string").alias("order_id"), "customer_id", F.lit(None).cast("string").alias("product_id"),
        *[F.lit("x").alias(c) for c in ("country", "segment", "category", "brand")],
        F.lit("completed").alias("status"), F.lit(False).alias("is_weekend"),
        F.lit("2024-01-06").cast("date").alias("order_date"), F.lit(1).alias("quantity"),
        *[F.lit(0.01).alias(c) for c in ("unit_price_eur", "total_eur", "total_cost_eur", "margin_eur")],
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        mart = marts.mart_customer_segments(customers(spark), staging.stg_orders(raw))
        got = {r.segment: r for r in mart.collect()}
    assert sum(r.total_orders for r in got.values()) == ROWS
    assert sum(r.total_customers for r in got.values()) == 5000
    assert got["regular"].total_revenue_eur + got["vip"].total_revenue_eur == ROWS / 100
    plan = mart._jdf.queryExecution().toString()
    assert "partial_count" in plan and "skew=true" not in plan


def test_distinct_users_are_spread_over_the_hot_hour(spark, logs):
    staged = staging.stg_llm_logs(logs({}))
    plan = marts.mart_hourly_activity(staged)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(request_date" in plan
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "user_id" in first.splitlines()[0]
