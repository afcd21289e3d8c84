"""Fixed dimension rows as DataFrames.

They are inline relations, so Catalyst knows their exact size and broadcasts them by its own
size check; nothing is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C


def _inline(spark: SparkSession, rows: list[tuple], *columns: str) -> DataFrame:
    def literal(value) -> str:
        return f"{value!r}e0" if isinstance(value, float) else "'" + value.replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def sites(spark: SparkSession) -> DataFrame:
    return _inline(spark, C.SITES, "site_id", "city", "site_type")


def base_loads(spark: SparkSession) -> DataFrame:
    return _inline(spark, list(C.BASE_LOAD_KWH.items()), "site_type", "base_kwh")


def cities(spark: SparkSession) -> DataFrame:
    return _inline(spark, C.CITIES, "city", "latitude", "longitude")


def model_rates(spark: SparkSession) -> DataFrame:
    return _inline(spark, C.MODEL_RATES, "model", "input_rate", "output_rate", "model_strength")
