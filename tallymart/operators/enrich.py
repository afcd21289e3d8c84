"""Row enrichment: dimension lookups, cost cards, calendar features and prompt routing.

Lookups are plain equi joins. A dimension below the broadcast threshold is broadcast by Catalyst's
own size check; a larger one is shuffled, and AQE splits a partition swollen by a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import calendar, pricing, prompts
from ..functions.numeric import sql_round


def order_lines(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Full order rows: customer and product attributes copied onto each line, amounts computed.

    ``lines`` has order_id, customer_id, product_id, order_date, status and quantity. The joins are
    left joins: a line whose customer or product is missing is kept with NULL attributes.
    """
    return _amounts(_with_product(_with_customer(lines, customers), products))


def order_lines_of(heads: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """``order_lines`` where orders come as heads (order_key, customer_id, order_date) and items (order_key, order_id, product_id,
    status, quantity): customers are looked up once per order and products per item, then both meet on the order.

    The long side is shuffled by product and by order at most, never by customer. Items without a head are left out.
    """
    return _amounts(_with_product(items, products).join(_with_customer(heads, customers), "order_key"))


def _with_customer(rows: DataFrame, customers: DataFrame) -> DataFrame:
    return rows.join(customers.select("customer_id", "country", "segment"), "customer_id", "left")


def _with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    return rows.join(products.select("product_id", "category", "brand", "price_eur", "cost_eur"), "product_id", "left")


def _amounts(joined: DataFrame) -> DataFrame:
    total = pricing.line_amount(F.col("price_eur"), F.col("quantity"))
    cost = pricing.line_amount(F.col("cost_eur"), F.col("quantity"))
    return joined.select(
        "order_id", "customer_id", "product_id", "country", "segment", "category", "brand",
        "order_date", "status", "quantity",
        F.col("price_eur").alias("unit_price_eur"),
        total.alias("total_eur"),
        cost.alias("total_cost_eur"),
        pricing.margin(total, cost).alias("margin_eur"),
        calendar.is_weekend(F.col("order_date")).alias("is_weekend"),
    )


def recompute_cost(log: DataFrame, rates: DataFrame) -> DataFrame:
    """Replace ``cost_usd`` by the model's card; a model without a card keeps its cost.

    ``rates`` has model, input_rate and output_rate. A known model with unknown tokens gets NULL.
    """
    card = rates.select("model", "input_rate", "output_rate", F.lit(True).alias("_known"))
    cost = pricing.token_cost(
        F.col("prompt_tokens"), F.col("output_tokens"), F.col("input_rate"), F.col("output_rate")
    )
    return (
        log.join(card, "model", "left")
        .withColumn("cost_usd", sql_round(F.when(F.col("_known"), cost).otherwise(F.col("cost_usd")), 6))
        .select(*log.columns)
    )


def expected_load(readings: DataFrame, base_loads: DataFrame) -> DataFrame:
    """Staged readings with the load expected for their site type, hour and day; NULL for an unknown site type."""
    expected = pricing.expected_kwh(F.col("base_kwh"), F.col("reading_hour"), F.col("is_weekend"))
    return readings.join(base_loads, "site_type", "left").select(
        *readings.columns,
        expected.alias("expected_kwh"),
        sql_round(F.col("consumption_kwh") - expected, 4).alias("excess_kwh"),
    )


def calendar_features(df: DataFrame, ts: str, hour: str | None = None) -> DataFrame:
    """Calendar columns of ``ts``; the peak flag follows ``hour`` where the row carries its own."""
    clock_hour = F.hour(ts)
    return df.select(
        "*",
        F.to_date(ts).alias("calendar_date"),
        clock_hour.alias("clock_hour"),
        calendar.day_name(F.col(ts)).alias("day_of_week"),
        calendar.is_weekend(F.col(ts)).alias("is_weekend"),
        calendar.is_peak_hour(F.col(hour) if hour else clock_hour).alias("is_peak_hour"),
        calendar.is_month_end(F.col(ts)).alias("is_month_end"),
    )


def drop_empty_prompts(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    return df.filter(prompts.has_text(F.col(prompt)))


def route(df: DataFrame, prompt: str = "prompt", model: str = "model", words: str | None = None) -> DataFrame:
    """Set ``model`` to the model chosen for each prompt, and ``words`` to its word count if named.

    The text is lower-cased and its words counted once per row, in projections of their own, before
    the rules read them several times.
    """
    read = df.withColumn("_lowered", F.lower(prompt)).withColumn("_words", prompts.word_count(F.col("_lowered")))
    chosen = prompts.choose_model(F.col("_lowered"), F.col("_words"))
    kept = [F.col("_words").alias(words)] if words else []
    rest = [name for name in df.columns if name != model]
    return read.select(*rest, chosen.alias(model), *kept)


def routed_events(log: DataFrame, rates: DataFrame) -> DataFrame:
    """Route each logged prompt and price it by the chosen model's card, as a routed event.

    A NULL prompt has no model, hence no strength and no cost.
    """
    routed = route(log).join(rates, "model", "left")
    cost = pricing.token_cost(
        F.col("prompt_tokens"), F.col("output_tokens"), F.col("input_rate"), F.col("output_rate")
    )
    return routed.withColumn("cost_usd", sql_round(cost, 6)).select(
        *log.columns, "model_strength", F.lit(C.ROUTED_BY).alias("routed_by")
    )
