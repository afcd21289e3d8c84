"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times into the ``noop`` sink, which computes every
row and column; the median counts. ``duckdb`` holds the oracle SQL on the same files, materialised.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallymart.plans.oracle import ORACLE
from tallymart.plans.registry import QUERIES
from tallymart.session import build_session

HEADLINE = [
    "mart_revenue_daily", "mart_customer_segments", "stg_llm_logs", "mart_hourly_activity",
    "mart_model_comparison", "mart_energy_daily", "mart_weather_daily", "mart_cost_per_user",
    "order_line_enrich", "route_prompts", "routing_summary", "weather_flatten", "dq_report",
]
RUNS = 3


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median(action) -> float:
    action()
    return round(statistics.median(seconds(action) for _ in range(RUNS)), 3)


def duckdb_seconds(path: str, names: list[str], threads: int) -> dict[str, float]:
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for file in sorted(os.listdir(path)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{path}/{file}'")
    return {
        name: median(lambda: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {ORACLE[name]}"))
        for name in names
    }


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()

    times = {name: median(lambda: run(name)) for name in names}
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
        "duckdb": duckdb_seconds(path, names, cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
