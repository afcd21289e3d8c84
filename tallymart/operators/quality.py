"""Declarative data-quality checks.

A check yields the rows that break it and passes when there are none. As in SQL, ``unique`` and
``accepted_values`` ignore NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


@dataclass(frozen=True)
class Checks:
    """The checks declared for one relation."""

    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)


# the 24 declared checks, by domain and relation
SUITE: dict[str, dict[str, Checks]] = {
    "energy": {
        "stg_meter_readings": Checks(
            unique=["reading_id"],
            not_null=["reading_id", "site_id", "consumption_kwh"],
            accepted={"site_type": ["residential", "commercial", "industrial"]},
        ),
        "mart_energy_daily": Checks(not_null=["reading_date", "total_kwh", "total_cost_eur"]),
    },
    "ecommerce": {
        "stg_orders": Checks(
            unique=["order_id"],
            not_null=["order_id", "customer_id", "total_eur"],
            accepted={"status": C.ORDER_STATUSES},
        ),
        "stg_customers": Checks(
            unique=["customer_id"],
            not_null=["customer_id"],
            accepted={"segment": ["vip", "regular", "occasional"]},
        ),
    },
    "weather": {
        "stg_weather": Checks(
            not_null=["city", "reading_timestamp", "temperature_c"],
            accepted={"city": [name for name, _, _ in C.CITIES]},
        ),
    },
    "requests": {
        "stg_llm_logs": Checks(
            not_null=["user_id", "cost_usd", "total_tokens"],
            accepted={"latency_category": ["fast", "medium", "slow"]},
        ),
    },
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values of ``column`` outside ``values``, with their number of rows."""
    return (
        df.filter(_outside(column, values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )


def _outside(column: str, values: list[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return _as_rows(counts, [(F.lit(name), F.col(name)) for name in columns], "column_name", "failures")


def _as_rows(one_row: DataFrame, entries: list[tuple], *names: str) -> DataFrame:
    structs = [F.struct(*[c.alias(n) for c, n in zip(entry, names)]) for entry in entries]
    return one_row.select(F.inline(F.array(*structs)))


def check_relation(df: DataFrame, relation: str, checks: Checks) -> DataFrame:
    """(relation, column_name, test, failures) for every check of one relation, in one scan.

    Each row yields one finding per check it has something to say about: its key for ``unique``,
    and only if it fails for the other two. Findings are counted per value, combined map-side, so a
    value in a third of the rows is one finding per input partition, and then summed up per check.
    ``failures`` counts failing rows for not_null and distinct failing values for the other two.
    """
    findings, measures, entries = [], [], []

    def add(column: str, test: str, reported: Column, value: Column, failures: Callable[[Column], Column]) -> None:
        number = len(entries)
        findings.append(F.when(reported, F.struct(F.lit(number).alias("check"), value.alias("value"))))
        measures.append(failures(F.col("check") == number).alias(f"check_{number}"))
        entries.append((F.lit(column), F.lit(test), F.col(f"check_{number}")))

    nothing = F.lit(None).cast("string")
    for name in checks.unique:
        add(name, "unique", F.col(name).isNotNull(), F.col(name).cast("string"),
            lambda own: F.count_if(own & (F.col("n_records") > 1)))
    for name in checks.not_null:
        add(name, "not_null", F.col(name).isNull(), nothing,
            lambda own: F.coalesce(F.sum(F.when(own, F.col("n_records"))), F.lit(0)))
    for name, values in checks.accepted.items():
        add(name, "accepted_values", _outside(name, values), F.col(name).cast("string"), F.count_if)

    counted = (
        df.select(F.inline(F.array_compact(F.array(*findings))))
        .groupBy("check", "value")
        .agg(F.count("*").alias("n_records"))
    )
    summary = _as_rows(counted.agg(*measures), entries, "column_name", "test", "failures")
    return summary.select(F.lit(relation).alias("relation"), "*")


def report(relations: Callable[[str], DataFrame], domains: list[str] | None = None) -> DataFrame:
    """All declared checks of the domains; ``relations`` returns a relation by name."""
    parts = [
        check_relation(relations(name), name, checks)
        for domain in domains or list(SUITE)
        for name, checks in SUITE[domain].items()
    ]
    return reduce(DataFrame.unionByName, parts)
