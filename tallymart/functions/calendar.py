"""Calendar features, business keys and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .numeric import sql_round


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def is_peak_hour(hour: Column) -> Column:
    return hour.between(C.PEAK_FIRST_HOUR, C.PEAK_LAST_HOUR)


def is_month_end(day: Column) -> Column:
    return F.dayofmonth(day) >= C.MONTH_END_FIRST_DAY


def lag_millis(earlier: Column, later: Column) -> Column:
    """Millisecond boundaries crossed between two wall-clock instants (not whole elapsed milliseconds).

    Zone-free: the difference in microseconds, with what each side has beyond its last whole
    millisecond put right.
    """
    earlier, later = earlier.cast("timestamp_ntz"), later.cast("timestamp_ntz")
    span = later - earlier
    hours = F.extract(F.lit("DAY"), span).cast("bigint") * 24 + F.extract(F.lit("HOUR"), span)
    micros = (hours * 60 + F.extract(F.lit("MINUTE"), span)) * 60_000_000 + _micros(span)
    return ((micros + _micros(earlier) % 1000 - _micros(later) % 1000) / 1000).cast("bigint")


def _micros(moment: Column) -> Column:
    """The seconds field in microseconds."""
    return (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")


def seconds(millis: Column) -> Column:
    return sql_round(millis / F.lit(1000.0), 2)


def reading_key(site_id: Column, ts: Column) -> Column:
    return F.concat_ws("_", site_id, F.date_format(ts, "yyyyMMddHH"))


def order_key(number: Column) -> Column:
    return F.format_string("ORD_%06d", number)


def product_key(number: Column) -> Column:
    return F.format_string("PROD_%03d", number)


def customer_key(number: Column) -> Column:
    return F.format_string("CUST_%04d", number)
