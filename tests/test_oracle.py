"""Every registered query against its SQL oracle on the smallest test tables."""

import compare
import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallymart.plans.oracle import ORACLE
from tallymart.plans.registry import QUERIES, relations

# these queries write tables or run a stream when they are built
EAGER = {"weather_flatten", "load_replace", "load_append", "mart_roundtrip", "stream_ingest", "refresh_report",
         "refresh_incremental", "staging_views", "unique_users_merged", "stream_hourly_activity", "stream_log_table",
         "stream_message_count", "stream_compacted_log"}


@pytest.fixture(scope="module")
def sql():
    return compare.oracle(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, sql, name):
    assert compare.differences(QUERIES[name](spark, SMALL).toPandas(), sql.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_stays_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_close_to_the_double_formulas(spark):
    """Averages and sums of plain doubles differ by at most one unit of the last place."""
    get = relations(spark, SMALL)
    keys = ["order_date", "country", "category", "brand", "segment", "is_weekend"]
    literal = get("stg_orders").groupBy(*keys).agg(
        F.round(F.avg("unit_price_eur"), 2).alias("price"), F.round(F.sum("total_eur"), 2).alias("gross")
    )
    both = get("mart_revenue_daily").join(literal, keys)
    assert both.count() == literal.count()
    off = (F.abs(F.col("price") - F.col("avg_order_value_eur")) > 0.01001) | (
        F.abs(F.col("gross") - F.col("gross_revenue_eur")) > 0.01001
    )
    assert both.filter(off).count() == 0


def test_mart_totals_equal_staging_totals(spark):
    get = relations(spark, SMALL)
    logs, users = get("stg_llm_logs"), get("mart_cost_per_user")
    row = users.agg(
        F.sum("total_requests").alias("n"), F.sum("total_tokens").alias("tokens"),
        F.sum(F.col("fast_requests") + F.col("medium_requests") + F.col("slow_requests")).alias("classes"),
    ).first()
    assert row.n == row.classes == logs.count()
    assert row.tokens == logs.agg(F.sum("total_tokens")).first()[0]
    revenue = get("mart_revenue_daily").filter(
        F.col("completed_orders") + F.col("returned_orders") + F.col("cancelled_orders") != F.col("total_orders")
    )
    assert revenue.count() == 0
