"""The same results in DuckDB SQL, written independently of the Spark plans.

Every query starts from the test tables. Amounts are summed as whole units of 10^-scale, the exact
form the Spark side sums as decimals, so both engines round the same number.
"""

from __future__ import annotations

from .. import constants as C

ORACLE: dict[str, str] = {}


def total(column: str, places: int, scale: int = 4) -> str:
    units = f"CAST(SUM(CAST(ROUND({column} * 1e{scale}) AS BIGINT)) AS DOUBLE)"
    return f"ROUND({units} / 1e{scale - places}) / 1e{places}"


def mean(column: str, places: int, scale: int = 4, count: str | None = None) -> str:
    units = f"CAST(SUM(CAST(ROUND({column} * 1e{scale}) AS BIGINT)) AS DOUBLE)"
    return f"ROUND({units} / (NULLIF({count or f'COUNT({column})'}, 0) * 1e{scale - places})) / 1e{places}"


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def pick(rows: list[tuple], position: int, index: str) -> str:
    items = [row[position] for row in rows]
    text = quoted(items) if isinstance(items[0], str) else ", ".join(f"{v!r}::DOUBLE" for v in items)
    return f"([{text}])[({index}) + 1]"


# --- raw tables -------------------------------------------------------------------

WEATHER_VALUES = """ROUND(value - 10.0, 2) AS temperature_c,
  CAST(event_id % 101 AS DOUBLE) AS humidity_pct,
  ROUND(value * 0.5::DOUBLE, 2) AS wind_speed_kmh,
  CASE WHEN event_id % 4 = 0 THEN value ELSE 0.0::DOUBLE END AS precipitation_mm,
  CAST(event_id % 97 AS DOUBLE) AS cloud_cover_pct"""

MOMENT = """ts AS timestamp, CAST(hour(ts) AS INTEGER) AS hour, CAST(ts AS DATE) AS date,
  dayname(ts) AS day_of_week, CAST(event_id % 2 AS BOOLEAN) AS is_day"""


def city_columns(index: str) -> str:
    return ", ".join(
        f"{pick(C.CITIES, position, index)} AS {name}"
        for position, name in enumerate(["city", "latitude", "longitude"])
    )


CTES = {
    "raw_customers": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS country, c_mktsegment AS segment,
  DATE '2000-01-01' - CAST(c_custkey % 700 AS INTEGER) AS registration_date
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
SELECT *, ROUND((price_eur - cost_eur) / NULLIF(price_eur, 0) * 100.0::DOUBLE, 1) AS margin_pct
FROM (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
        p_brand AS brand, p_retailprice AS price_eur, ROUND(p_retailprice * 0.55::DOUBLE, 2) AS cost_eur
      FROM part)""",
    "raw_orders": """
SELECT *, ROUND(total_eur - total_cost_eur, 2) AS margin_eur
FROM (SELECT 'ORD_' || l_orderkey || '_' || l_linenumber AS order_id,
        CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
        n_name AS country, c_mktsegment AS segment, p_type AS category, p_brand AS brand,
        CASE l_returnflag WHEN 'N' THEN 'completed' WHEN 'R' THEN 'returned' WHEN 'A' THEN 'cancelled' END AS status,
        isodow(o_orderdate) >= 6 AS is_weekend, CAST(o_orderdate AS DATE) AS order_date,
        CAST(l_quantity AS INTEGER) AS quantity, ROUND(l_extendedprice / l_quantity, 2) AS unit_price_eur,
        l_extendedprice AS total_eur, ROUND(l_quantity * p_retailprice * 0.55::DOUBLE, 2) AS total_cost_eur
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)""",
    "raw_readings": f"""
SELECT {pick(C.SITES, 0, "user_id % 5")} || '_' || strftime(ts, '%Y%m%d%H') AS reading_id,
  {pick(C.SITES, 0, "user_id % 5")} AS site_id, {pick(C.SITES, 1, "user_id % 5")} AS city,
  {pick(C.SITES, 2, "user_id % 5")} AS site_type, dayname(ts) AS day_of_week, ts AS reading_timestamp,
  CAST(event_id % 24 AS INTEGER) AS reading_hour, isodow(ts) >= 6 AS is_weekend,
  value AS consumption_kwh, ROUND(value * 0.28::DOUBLE, 4) AS cost_eur
FROM events""",
    "raw_weather": f"SELECT {city_columns('user_id % 5')}, {MOMENT}, {WEATHER_VALUES} FROM events",
    "raw_logs": """
SELECT ts AS timestamp, 'user_' || user_id AS user_id,
  CASE event_type WHEN 'view' THEN 'phi3' WHEN 'click' THEN 'llama3.2' WHEN 'purchase' THEN 'mistral'
    ELSE event_type END AS model,
  text AS prompt, props AS response,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS prompt_tokens,
  CAST(event_id % 997 AS INTEGER) AS output_tokens,
  CAST(json_extract_string(props, '$.k') AS INTEGER) + CAST(event_id % 997 AS INTEGER) AS total_tokens,
  CAST(floor(value * 100.0::DOUBLE) AS INTEGER) AS latency_ms, value / 1000.0::DOUBLE AS cost_usd,
  ts + to_microseconds(event_id % 5000 * 1000 + 500) AS consumed_at
FROM events JOIN benchmark ON item_id = event_id % (SELECT COUNT(*) FROM benchmark)""",
    "prompts": """
SELECT 'conversations' AS source, conv_id || '-' || turn AS prompt_id, text AS prompt FROM conversations
UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), text FROM documents""",
}

# --- staged relations ---------------------------------------------------------------

CARD = "CASE model " + " ".join(
    f"WHEN '{m}' THEN (prompt_tokens / 1000.0::DOUBLE) * {i!r}::DOUBLE + (output_tokens / 1000.0::DOUBLE) * {o!r}::DOUBLE"
    for m, i, o, _ in C.MODEL_RATES
)

CTES["orders_s"] = """
SELECT *, CASE WHEN status = 'completed' THEN total_eur ELSE 0 END AS revenue_eur,
  CASE WHEN status = 'completed' THEN margin_eur ELSE 0 END AS profit_eur FROM raw_orders"""
CTES["weather_s"] = """
SELECT * EXCLUDE (timestamp, date, hour), timestamp AS reading_timestamp, date AS reading_date,
  hour AS reading_hour FROM raw_weather"""
CTES["logs_s"] = f"""
SELECT user_id, model, timestamp AS request_timestamp, consumed_at AS consumed_timestamp,
  CAST(timestamp AS DATE) AS request_date, CAST(hour(timestamp) AS INTEGER) AS request_hour,
  prompt, left(prompt, 50) AS prompt_preview, prompt_tokens, output_tokens, total_tokens, latency_ms,
  ROUND(latency_ms / 1000.0::DOUBLE, 2) AS latency_sec, ROUND({CARD} ELSE cost_usd END, 6) AS cost_usd,
  datediff('millisecond', timestamp, consumed_at) AS kafka_lag_ms,
  CASE WHEN latency_ms < 3000 THEN 'fast' WHEN latency_ms < 10000 THEN 'medium' ELSE 'slow' END AS latency_category
FROM raw_logs"""

# Fixed value: RE2 form of the white space that separates words
GAP = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def any_of(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(prompt), '{w}')" for w in words) + ")"


WORDS = f"len([w FOR w IN string_split_regex(prompt, '{GAP}+') IF w <> ''])"
ROUTE = f"""CASE WHEN {any_of(C.SENSITIVE_KEYWORDS)} OR {WORDS} < 10 THEN 'phi3'
  WHEN {any_of(C.TECHNICAL_KEYWORDS)} OR {WORDS} > 30 THEN 'mistral' ELSE 'llama3.2' END"""
STRENGTH = "CASE model " + " ".join(f"WHEN '{m}' THEN '{s}'" for m, _, _, s in C.MODEL_RATES) + " END"

CTES["chosen"] = f"SELECT * REPLACE ({ROUTE} AS model) FROM raw_logs"
CTES["routed"] = f"""
SELECT * EXCLUDE (consumed_at) REPLACE (ROUND({CARD} END, 6) AS cost_usd),
  {STRENGTH} AS model_strength, 'llm_router' AS routed_by FROM chosen"""

NEEDS = {
    "orders_s": ["raw_orders"],
    "weather_s": ["raw_weather"],
    "logs_s": ["raw_logs"],
    "routed": ["raw_logs", "chosen"],
}


def define(name: str, body: str, *ctes: str) -> None:
    """Register ``body`` under ``name``, preceded by the relations it reads."""
    order: list[str] = []
    for cte in ctes:
        for needed in [*NEEDS.get(cte, []), cte]:
            if needed not in order:
                order.append(needed)
    head = ",\n".join(f"{cte} AS ({CTES[cte].strip()})" for cte in order)
    ORACLE[name] = (f"WITH {head}\n" if head else "") + body.strip()


define("stg_meter_readings", "SELECT * FROM raw_readings", "raw_readings")
define("stg_orders", "SELECT * FROM orders_s", "orders_s")
define("stg_customers", "SELECT * FROM raw_customers", "raw_customers")
define("stg_products", "SELECT * EXCLUDE (name), name AS product_name FROM raw_products", "raw_products")
define("stg_weather", "SELECT * FROM weather_s", "weather_s")
define("stg_llm_logs", "SELECT * FROM logs_s", "logs_s")

# --- marts --------------------------------------------------------------------------

ENERGY_DAILY = f"""
SELECT CAST(reading_timestamp AS DATE) AS reading_date, day_of_week, is_weekend, site_id, city, site_type,
  COUNT(*) AS total_readings, {total("consumption_kwh", 3)} AS total_kwh,
  {mean("consumption_kwh", 3)} AS avg_kwh_per_hour, ROUND(MAX(consumption_kwh), 3) AS peak_kwh,
  ROUND(MIN(consumption_kwh), 3) AS min_kwh, {total("cost_eur", 2)} AS total_cost_eur
FROM raw_readings GROUP BY ALL"""
define("mart_energy_daily", ENERGY_DAILY, "raw_readings")
define("mart_roundtrip", ENERGY_DAILY, "raw_readings")

REVENUE_DAILY = f"""
SELECT order_date, country, category, brand, segment, is_weekend, COUNT(*) AS total_orders,
  CAST(SUM(quantity) AS BIGINT) AS total_units, {total("total_eur", 2)} AS gross_revenue_eur,
  {total("revenue_eur", 2)} AS net_revenue_eur, {total("profit_eur", 2)} AS profit_eur,
  {mean("unit_price_eur", 2)} AS avg_order_value_eur,
  COUNT(*) FILTER (status = 'completed') AS completed_orders,
  COUNT(*) FILTER (status = 'returned') AS returned_orders,
  COUNT(*) FILTER (status = 'cancelled') AS cancelled_orders
FROM orders_s GROUP BY ALL"""
define("mart_revenue_daily", REVENUE_DAILY, "orders_s")
define("presentation_sort", REVENUE_DAILY + " ORDER BY order_date, net_revenue_eur DESC", "orders_s")

define(
    "mart_customer_segments",
    f"""
SELECT c.segment, c.country, COUNT(DISTINCT o.customer_id) AS total_customers,
  COUNT(o.order_id) AS total_orders, {total("o.revenue_eur", 2)} AS total_revenue_eur,
  {total("o.profit_eur", 2)} AS total_profit_eur, {mean("o.revenue_eur", 2)} AS avg_order_value_eur,
  {mean("o.revenue_eur", 2, count="COUNT(DISTINCT o.customer_id)")} AS revenue_per_customer_eur
FROM raw_customers c LEFT JOIN orders_s o USING (customer_id)
WHERE o.status = 'completed' GROUP BY c.segment, c.country""",
    "raw_customers", "orders_s",
)
define(
    "revenue_by_category",
    f"""
SELECT category, COUNT(*) AS orders, {total("total_eur", 2)} AS revenue_eur, {total("margin_eur", 2)} AS profit_eur
FROM raw_orders WHERE status = 'completed' GROUP BY category""",
    "raw_orders",
)
define(
    "mart_weather_daily",
    f"""
SELECT reading_date, day_of_week, city, latitude, longitude,
  {mean("temperature_c", 1)} AS avg_temp_c, ROUND(MAX(temperature_c), 1) AS max_temp_c,
  ROUND(MIN(temperature_c), 1) AS min_temp_c, {mean("humidity_pct", 1)} AS avg_humidity_pct,
  {mean("wind_speed_kmh", 1)} AS avg_wind_kmh, ROUND(MAX(wind_speed_kmh), 1) AS max_wind_kmh,
  {total("precipitation_mm", 1)} AS total_precipitation_mm, {mean("cloud_cover_pct", 1)} AS avg_cloud_cover_pct,
  COUNT(*) AS hourly_readings, COUNT(*) FILTER (precipitation_mm > 0) AS rainy_hours
FROM weather_s GROUP BY ALL""",
    "weather_s",
)
define(
    "weather_city_7d",
    f"""
SELECT city, {mean("temperature_c", 1)} AS avg_temp_c, ROUND(MAX(temperature_c), 1) AS max_temp_c,
  ROUND(MIN(temperature_c), 1) AS min_temp_c, {mean("humidity_pct", 1)} AS avg_humidity_pct,
  {total("precipitation_mm", 1)} AS total_rain_mm
FROM raw_weather WHERE date >= (SELECT MAX(date) FROM raw_weather) - INTERVAL 7 DAYS GROUP BY city""",
    "raw_weather",
)
define(
    "mart_cost_per_user",
    f"""
SELECT user_id, COUNT(*) AS total_requests, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
  {total("cost_usd", 4, 6)} AS total_cost_usd, {mean("cost_usd", 4, 6)} AS avg_cost_per_request,
  ROUND(AVG(latency_ms), 0) AS avg_latency_ms, ROUND(AVG(total_tokens), 0) AS avg_tokens_per_request,
  ROUND(MAX(cost_usd), 4) AS max_cost_usd,
  COUNT(*) FILTER (latency_category = 'fast') AS fast_requests,
  COUNT(*) FILTER (latency_category = 'medium') AS medium_requests,
  COUNT(*) FILTER (latency_category = 'slow') AS slow_requests
FROM logs_s GROUP BY user_id""",
    "logs_s",
)
define(
    "mart_hourly_activity",
    f"""
SELECT request_date, request_hour, COUNT(*) AS total_requests, COUNT(DISTINCT user_id) AS unique_users,
  CAST(SUM(total_tokens) AS BIGINT) AS total_tokens, {total("cost_usd", 4, 6)} AS total_cost_usd,
  ROUND(AVG(latency_ms), 0) AS avg_latency_ms, ROUND(AVG(kafka_lag_ms), 0) AS avg_kafka_lag_ms
FROM logs_s GROUP BY ALL""",
    "logs_s",
)
define(
    "mart_latency_analysis",
    f"""
SELECT prompt_preview, latency_category, COUNT(*) AS times_asked, ROUND(AVG(latency_ms), 0) AS avg_latency_ms,
  {mean("latency_sec", 2)} AS avg_latency_sec, ROUND(AVG(total_tokens), 0) AS avg_tokens,
  {mean("cost_usd", 4, 6)} AS avg_cost_usd, {total("cost_usd", 4, 6)} AS total_cost_usd
FROM logs_s GROUP BY ALL""",
    "logs_s",
)
define(
    "mart_model_comparison",
    f"""
SELECT model, COUNT(*) AS total_requests, {total("cost_usd", 6, 6)} AS total_cost_usd,
  {mean("cost_usd", 6, 6)} AS avg_cost_usd, ROUND(MIN(cost_usd), 6) AS min_cost_usd,
  ROUND(MAX(cost_usd), 6) AS max_cost_usd, ROUND(AVG(latency_ms), 0) AS avg_latency_ms,
  MIN(latency_ms) AS min_latency_ms, MAX(latency_ms) AS max_latency_ms,
  ROUND(AVG(total_tokens), 0) AS avg_tokens, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
  ROUND(CAST(SUM(total_tokens) AS DOUBLE) * 1e6
    / NULLIF(CAST(SUM(CAST(ROUND(cost_usd * 1e6) AS BIGINT)) AS DOUBLE), 0)) AS tokens_per_dollar,
  CASE WHEN AVG(latency_ms) < 5000 THEN 'fast' WHEN AVG(latency_ms) < 10000 THEN 'medium' ELSE 'slow' END
    AS speed_category
FROM logs_s GROUP BY model""",
    "logs_s",
)
define(
    "llm_log_totals",
    f"""
SELECT COUNT(*) AS total_requests, {total("cost_usd", 4, 6)} AS total_cost_usd,
  ROUND(AVG(latency_ms), 0) AS avg_latency_ms FROM raw_logs""",
    "raw_logs",
)
define(
    "llm_transport_lag",
    """
SELECT request_date, request_hour, COUNT(kafka_lag_ms) AS requests, MIN(kafka_lag_ms) AS min_kafka_lag_ms,
  MAX(kafka_lag_ms) AS max_kafka_lag_ms, ROUND(AVG(kafka_lag_ms), 0) AS avg_kafka_lag_ms
FROM logs_s GROUP BY ALL""",
    "logs_s",
)
define(
    "cost_anomaly",
    f"""
SELECT avg_cost_usd, max_cost_usd, ROUND(max_cost_usd / NULLIF(avg_cost_usd, 0), 1) AS cost_ratio,
  COALESCE(max_cost_usd <> 0 AND avg_cost_usd <> 0 AND max_cost_usd > avg_cost_usd * 3, FALSE) AS is_anomaly
FROM (SELECT {mean("cost_usd", 4, 6)} AS avg_cost_usd,
        ROUND(MAX(cost_usd) FILTER (request_timestamp >= latest - INTERVAL 1 HOUR), 4) AS max_cost_usd
      FROM logs_s, (SELECT MAX(ts) AS latest FROM events))""",
    "logs_s",
)
define(
    "top_cost_user",
    f"""
SELECT user_id, {total("cost_usd", 4, 6)} AS total_cost_usd FROM logs_s
GROUP BY user_id ORDER BY total_cost_usd DESC, user_id LIMIT 1""",
    "logs_s",
)

RAW = {
    "meter_readings": "raw_readings", "products": "raw_products", "customers": "raw_customers",
    "orders": "raw_orders", "hourly_weather": "raw_weather", "llm_logs_kafka": "raw_logs",
}


def counted(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS loaded_rows FROM {RAW[n]}" for n in names)


define("load_counts", counted(list(RAW)), *RAW.values())
SHOP = ["products", "customers", "orders"]
define("load_replace", counted(SHOP), *[RAW[n] for n in SHOP])
define(
    "load_append",
    """SELECT model, COUNT(*) AS log_rows, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens
FROM raw_logs GROUP BY model""",
    "raw_logs",
)

# --- enrichment -----------------------------------------------------------------------

ORDER_LINES = """
SELECT order_id, customer_id, product_id, country, segment, category, brand, order_date, status, quantity,
  price_eur AS unit_price_eur, ROUND(price_eur * quantity, 2) AS total_eur,
  ROUND(cost_eur * quantity, 2) AS total_cost_eur,
  ROUND(ROUND(price_eur * quantity, 2) - ROUND(cost_eur * quantity, 2), 2) AS margin_eur, is_weekend
FROM (SELECT order_id, customer_id, product_id, order_date, status, quantity, is_weekend FROM raw_orders)
LEFT JOIN raw_customers USING (customer_id) LEFT JOIN raw_products USING (product_id)"""
define("order_line_enrich", ORDER_LINES, "raw_orders", "raw_customers", "raw_products")

BASE = " ".join(f"WHEN '{kind}' THEN {kwh!r}::DOUBLE" for kind, kwh in C.BASE_LOAD_KWH.items())
define(
    "energy_expected_load",
    f"""
SELECT *, ROUND(consumption_kwh - expected_kwh, 4) AS excess_kwh
FROM (SELECT *, ROUND((CASE site_type {BASE} END)
        * (CASE WHEN reading_hour BETWEEN 8 AND 20 THEN 1.4::DOUBLE ELSE 0.6::DOUBLE END)
        * (CASE WHEN is_weekend THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END), 4) AS expected_kwh FROM raw_readings)""",
    "raw_readings",
)
define(
    "calendar_features",
    """
SELECT event_id, ts, CAST(ts AS DATE) AS calendar_date, CAST(hour(ts) AS INTEGER) AS clock_hour,
  dayname(ts) AS day_of_week, isodow(ts) >= 6 AS is_weekend, hour(ts) BETWEEN 8 AND 20 AS is_peak_hour,
  day(ts) >= 25 AS is_month_end FROM events""",
)
define(
    "build_keys",
    """
SELECT l_linenumber, printf('ORD_%06d', l_orderkey) AS order_key, printf('PROD_%03d', l_partkey) AS product_key,
  printf('CUST_%04d', l_suppkey) AS customer_key,
  printf('SITE_%03d', l_suppkey) || '_' || strftime(l_shipdate, '%Y%m%d%H') AS reading_key FROM lineitem""",
)
define(
    "llm_cost_recompute",
    f"""SELECT timestamp, user_id, model, prompt_tokens, output_tokens,
  ROUND({CARD} ELSE cost_usd END, 6) AS cost_usd FROM raw_logs""",
    "raw_logs",
)
define(
    "llm_cost_flat",
    """SELECT timestamp, user_id, prompt_tokens, output_tokens,
  ROUND((prompt_tokens / 1000.0::DOUBLE) * 0.01::DOUBLE + (output_tokens / 1000.0::DOUBLE) * 0.03::DOUBLE, 6)
    AS cost_usd FROM raw_logs""",
    "raw_logs",
)

# --- prompts ----------------------------------------------------------------------------

define("prompt_preview", "SELECT source, prompt_id, left(prompt, 50) AS prompt_preview FROM prompts", "prompts")
define(
    "prompt_filter",
    f"SELECT source, prompt_id FROM prompts WHERE regexp_replace(prompt, '{GAP}', '', 'g') <> ''",
    "prompts",
)
define(
    "route_prompts",
    f"SELECT source, prompt_id, CAST({WORDS} AS INTEGER) AS words, {ROUTE} AS model FROM prompts",
    "prompts",
)
define("routed_events", "SELECT * FROM routed", "routed")
define(
    "routing_summary",
    f"""SELECT model, COUNT(*) AS requests, {mean("cost_usd", 6, 6)} AS avg_cost_usd,
  ROUND(AVG(latency_ms), 0) AS avg_latency_ms FROM routed GROUP BY model""",
    "routed",
)

# --- events and payloads ------------------------------------------------------------------

define(
    "json_encode_events",
    """
SELECT user_id AS key, CAST(12 AS INTEGER) AS n_fields,
  strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS json_timestamp,
  user_id AS json_user_id, model AS json_model, model_strength AS json_model_strength, prompt AS json_prompt,
  CAST(total_tokens AS VARCHAR) AS json_total_tokens, routed_by AS json_routed_by FROM routed""",
    "routed",
)
define(
    "json_decode_events",
    """SELECT * EXCLUDE (consumed_at), TRUE AS is_valid, prompt_tokens AS usage_present,
  CAST(0 AS INTEGER) AS usage_absent FROM raw_logs""",
    "raw_logs",
)
define(
    "json_quarantine",
    """SELECT model AS sent_as, model NOT IN ('error', 'signup') AS is_valid, COUNT(*) AS events FROM raw_logs GROUP BY ALL""",
    "raw_logs",
)
define("stream_ingest", "SELECT * EXCLUDE (consumed_at), TRUE AS is_stamped FROM raw_logs", "raw_logs")
define("weather_flatten", f"SELECT {city_columns('event_id // 24 % 5')}, {MOMENT}, {WEATHER_VALUES} FROM events")

define(
    "refresh_incremental",
    f"""
SELECT 'mart_cost_per_user' AS mart, user_id AS key, CAST(MAX(cost_usd) IS NULL AS VARCHAR) AS second_key, COUNT(*) AS requests,
  {mean("cost_usd", 4, 6)} AS cost_usd, CAST(SUM(total_tokens) AS DOUBLE) AS tokens, ROUND(AVG(latency_ms), 0) AS avg_latency_ms
FROM logs_s GROUP BY user_id
UNION ALL SELECT 'mart_latency_analysis', prompt_preview, latency_category, COUNT(*), {total("cost_usd", 4, 6)}, ROUND(AVG(total_tokens), 0),
  ROUND(AVG(latency_ms), 0) FROM logs_s GROUP BY prompt_preview, latency_category
UNION ALL SELECT 'mart_model_comparison', model,
  CASE WHEN AVG(latency_ms) < 5000 THEN 'fast' WHEN AVG(latency_ms) < 10000 THEN 'medium' ELSE 'slow' END, COUNT(*), {total("cost_usd", 6, 6)},
  ROUND(CAST(SUM(total_tokens) AS DOUBLE) * 1e6 / NULLIF(CAST(SUM(CAST(ROUND(cost_usd * 1e6) AS BIGINT)) AS DOUBLE), 0)),
  ROUND(AVG(latency_ms), 0) FROM logs_s GROUP BY model
UNION ALL SELECT 'mart_hourly_activity', CAST(request_date AS VARCHAR), CAST(request_hour AS VARCHAR), COUNT(*), {total("cost_usd", 4, 6)},
  CAST(COUNT(DISTINCT user_id) AS DOUBLE), ROUND(AVG(latency_ms), 0) FROM logs_s GROUP BY request_date, request_hour""",
    "logs_s",
)
define(
    "unique_users_merged",
    """SELECT request_date, request_hour, COUNT(DISTINCT user_id) AS unique_users FROM logs_s GROUP BY ALL
UNION ALL SELECT request_date, -1, COUNT(DISTINCT user_id) FROM logs_s GROUP BY request_date""",
    "logs_s",
)
define(
    "stream_hourly_activity",
    f"""
SELECT request_date, request_hour, COUNT(*) AS total_requests, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
  {total("cost_usd", 4, 6)} AS total_cost_usd, ROUND(AVG(latency_ms), 0) AS avg_latency_ms
FROM logs_s GROUP BY ALL""",
    "logs_s",
)
define(
    "stream_log_table",
    """SELECT latency_ms % 4 AS source_partition, COUNT(*) AS messages, COUNT(*) AS offsets, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens
FROM raw_logs GROUP BY 1""",
    "raw_logs",
)
define("stream_message_count", "SELECT COUNT(*) AS messages, COUNT(*) FILTER (model IS DISTINCT FROM 'error') AS valid_messages FROM raw_logs", "raw_logs")
define(
    "stream_compacted_log",
    """
SELECT 'ok' AS status, CAST(timestamp AS DATE) AS event_date, model, COUNT(*) AS messages, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens
FROM raw_logs WHERE model IS DISTINCT FROM 'error' GROUP BY ALL
UNION ALL SELECT 'quarantine', NULL, NULL, COUNT(*), 0 FROM raw_logs WHERE model = 'error' HAVING COUNT(*) > 0""",
    "raw_logs",
)
define(
    "staging_views",
    """
SELECT 'stg_meter_readings' AS relation, COUNT(*) AS staged_rows, CAST(SUM(reading_hour) AS BIGINT) AS total FROM raw_readings
UNION ALL SELECT 'stg_orders', COUNT(*), CAST(SUM(CASE WHEN status = 'completed' THEN CAST(ROUND(total_eur * 100) AS BIGINT) ELSE 0 END) AS BIGINT) FROM raw_orders
UNION ALL SELECT 'stg_customers', COUNT(*), COUNT(DISTINCT segment) FROM raw_customers
UNION ALL SELECT 'stg_products', COUNT(*), COUNT(DISTINCT brand) FROM raw_products
UNION ALL SELECT 'stg_weather', COUNT(*), CAST(SUM(hour) AS BIGINT) FROM raw_weather
UNION ALL SELECT 'stg_llm_logs', COUNT(*), CAST(SUM(CAST(ROUND(cost_usd * 1e6) AS BIGINT) + kafka_lag_ms) AS BIGINT) FROM logs_s""",
    "raw_readings", "raw_orders", "raw_customers", "raw_products", "raw_weather", "logs_s",
)

# --- data quality ---------------------------------------------------------------------------


def repeated(column: str, table: str) -> str:
    return f"""SELECT {column} AS value, COUNT(*) AS n_records FROM {table}
WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1"""


def check(relation: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{relation}' AS relation, '{column}' AS column_name, '{test}' AS test, ({failures}) AS failures"
    )


define(
    "dq_unique",
    f"""SELECT 'order_id' AS key_column, * FROM ({repeated("order_id", "raw_orders")})
UNION ALL SELECT 'reading_id', * FROM ({repeated("reading_id", "raw_readings")})""",
    "raw_orders", "raw_readings",
)
define(
    "dq_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS failures FROM logs_s"
        for c in [
            "user_id", "model", "request_timestamp", "consumed_timestamp", "request_date", "request_hour",
            "prompt", "prompt_preview", "prompt_tokens", "output_tokens", "total_tokens", "latency_ms",
            "latency_sec", "cost_usd", "kafka_lag_ms", "latency_category",
        ]
    ),
    "logs_s",
)
define(
    "dq_accepted_values",
    """SELECT segment AS value, COUNT(*) AS n_records FROM raw_customers
WHERE segment NOT IN ('vip', 'regular', 'occasional') GROUP BY segment""",
    "raw_customers",
)

CTES["energy_daily"] = ENERGY_DAILY
NEEDS["energy_daily"] = ["raw_readings"]
# relation -> (its CTE, unique columns, not-null columns, accepted values), by domain
DECLARED = {
    "energy": {
        "stg_meter_readings": (
            "raw_readings", ["reading_id"], ["reading_id", "site_id", "consumption_kwh"],
            {"site_type": ["residential", "commercial", "industrial"]},
        ),
        "mart_energy_daily": ("energy_daily", [], ["reading_date", "total_kwh", "total_cost_eur"], {}),
    },
    "ecommerce": {
        "stg_orders": (
            "orders_s", ["order_id"], ["order_id", "customer_id", "total_eur"],
            {"status": ["completed", "returned", "cancelled"]},
        ),
        "stg_customers": (
            "raw_customers", ["customer_id"], ["customer_id"], {"segment": ["vip", "regular", "occasional"]},
        ),
    },
    "weather": {
        "stg_weather": (
            "weather_s", [], ["city", "reading_timestamp", "temperature_c"],
            {"city": ["Bucharest", "Cluj-Napoca", "Iasi", "Timisoara", "Constanta"]},
        ),
    },
    "requests": {
        "stg_llm_logs": (
            "logs_s", [], ["user_id", "cost_usd", "total_tokens"],
            {"latency_category": ["fast", "medium", "slow"]},
        ),
    },
}
DECLARED_CTES = ["raw_readings", "energy_daily", "orders_s", "raw_customers", "weather_s", "logs_s"]


def declared_checks(domain: str) -> list[str]:
    parts = []
    for relation, (cte, unique, not_null, accepted) in DECLARED[domain].items():
        for c in unique:
            parts.append(check(relation, c, "unique", f"SELECT COUNT(*) FROM ({repeated(c, cte)})"))
        for c in not_null:
            parts.append(check(relation, c, "not_null", f"SELECT COUNT(*) FROM {cte} WHERE {c} IS NULL"))
        for c, values in accepted.items():
            bad = f"SELECT COUNT(DISTINCT {c}) FROM {cte} WHERE {c} NOT IN ({quoted(values)})"
            parts.append(check(relation, c, "accepted_values", bad))
    return parts


define(
    "dq_report", "\nUNION ALL ".join(sum((declared_checks(d) for d in DECLARED), [])), *DECLARED_CTES
)

# row counts of raw tables and marts per domain; a mart has one row per distinct key
MART_KEYS = {
    "energy": {"mart_energy_daily": "SELECT * FROM energy_daily"},
    "ecommerce": {
        "mart_revenue_daily": "SELECT DISTINCT order_date, country, category, brand, segment, is_weekend FROM orders_s",
        "mart_customer_segments": """SELECT DISTINCT c.segment, c.country FROM raw_customers c
  JOIN orders_s o USING (customer_id) WHERE o.status = 'completed'""",
    },
    "weather": {
        "mart_weather_daily": "SELECT DISTINCT reading_date, day_of_week, city, latitude, longitude FROM weather_s"
    },
    "requests": {
        "mart_cost_per_user": "SELECT DISTINCT user_id FROM logs_s",
        "mart_hourly_activity": "SELECT DISTINCT request_date, request_hour FROM logs_s",
        "mart_latency_analysis": "SELECT DISTINCT prompt_preview, latency_category FROM logs_s",
        "mart_model_comparison": "SELECT DISTINCT model FROM logs_s",
    },
}
RAW_OF = {
    "energy": ["meter_readings"], "ecommerce": SHOP, "weather": ["hourly_weather"], "requests": ["llm_logs_kafka"],
}


def refreshed(domain: str) -> list[str]:
    sizes = {name: f"SELECT * FROM {RAW[name]}" for name in RAW_OF[domain]} | MART_KEYS[domain]
    parts = [
        f"SELECT '{domain}' AS domain, '{name}' AS relation, NULL AS column_name, 'rows' AS measure, "
        f"COUNT(*) AS value FROM ({rows})"
        for name, rows in sizes.items()
    ]
    return parts + [
        f"SELECT '{domain}', relation, column_name, test, failures FROM ({part})" for part in declared_checks(domain)
    ]


define(
    "refresh_report",
    "\nUNION ALL ".join(sum((refreshed(d) for d in DECLARED), [])),
    *dict.fromkeys([*RAW.values(), *DECLARED_CTES]),
)
