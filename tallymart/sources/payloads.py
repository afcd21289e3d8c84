"""Hourly weather payloads: JSON documents with one parallel array per variable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar
from ..schemas import HOURLY_READINGS, WEATHER_PAYLOAD

# payload array -> column of the raw weather table (fixed values)
VARIABLES = {
    "is_day": "is_day",
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "wind_speed_10m": "wind_speed_kmh",
    "precipitation": "precipitation_mm",
    "cloud_cover": "cloud_cover_pct",
}


def read_payloads(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Payloads of a landing directory, one JSON document per line, with the declared schema.

    A city is a field of the document or a ``city=`` directory. A malformed document fails the
    load by default; ``PERMISSIVE`` or ``DROPMALFORMED`` are the reader's own alternatives.
    """
    return spark.read.schema(WEATHER_PAYLOAD).option("mode", mode).json(path)


def flatten_hourly(payloads: DataFrame, cities: DataFrame) -> DataFrame:
    """One raw weather row per element of ``hourly.time``, with its city's coordinates.

    Arrays are zipped by position inside the row, so nothing is shuffled. A variable's array that
    is too short gives NULL; elements beyond the time axis are not readings, a NULL time on it is. A
    city that is not listed gets NULL coordinates.
    """
    zipped = F.arrays_zip(*[F.col(f"hourly.{name}") for name in HOURLY_READINGS.names])
    zipped = F.slice(zipped, 1, F.size("hourly.time"))
    rows = payloads.select("city", F.inline(zipped)).toDF("city", *HOURLY_READINGS.names)
    moment = F.col("time").cast("timestamp_ntz")
    return (
        rows.join(cities, "city", "left")
        .select(
            "city", "latitude", "longitude",
            moment.alias("timestamp"),
            F.hour(moment).alias("hour"),
            F.to_date(moment).alias("date"),
            calendar.day_name(moment).alias("day_of_week"),
            *[
                (F.col(name).cast("boolean") if name == "is_day" else F.col(name)).alias(target)
                for name, target in VARIABLES.items()
            ],
        )
    )
