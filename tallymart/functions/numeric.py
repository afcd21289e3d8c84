"""Rounding and order-independent aggregation.

Double sums depend on the order in which partitions are merged, so a rounded result could change
between two runs of the same job. Amounts are therefore summed as whole units of 10^-scale in
64-bit integers: exact, associative, and five times cheaper per row than decimal sums. Nine
million million dollars at six decimals, or a hundred times that at four, still fit; beyond that
the ANSI sum raises an error instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# decimal places kept per value while summing
AMOUNT_SCALE = 4
USD_SCALE = 6


def sql_round(value: Column, places: int = 0) -> Column:
    """Round the double ``value * 10**places`` half away from zero, as SQL engines on doubles do.

    ``F.round(x, n)`` rounds the shortest decimal text of x instead, so 1.005 would become 1.01.
    """
    if places == 0:
        return F.round(value, 0)
    factor = F.lit(float(10**places))
    return F.round(value * factor, 0) / factor


def to_units(value: Column, scale: int = AMOUNT_SCALE) -> Column:
    """``value`` as a whole number of 10^-scale, ready to be summed exactly; 0 where that cannot hold it.

    ``rint``, a single machine instruction, finds the whole number up to float noise. What a value has
    beyond it is ``off_grid``.
    """
    scaled = value * F.lit(float(10**scale))
    return F.when(F.abs(scaled) < F.lit(2.0**63), F.rint(scaled)).when(value.isNotNull(), 0.0).cast("bigint")


def off_grid(value: Column, scale: int = AMOUNT_SCALE) -> Column:
    """What ``to_units`` leaves out: 0 for values of at most ``scale`` decimals, NaN or infinity for such values.

    Differences of a few units in the last place of a double are float noise.
    """
    rest = value - to_units(value, scale) / F.lit(float(10**scale))
    noise = (F.abs(value) < F.lit(float("inf"))) & (F.abs(rest) <= F.abs(value) * F.lit(2.0**-50))
    return F.when(noise, 0.0).otherwise(rest)


def rounded_total(units: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    """A total of units as a double with ``places`` decimals."""
    return F.round(units / F.lit(float(10 ** (scale - places))), 0) / F.lit(float(10**places))


def rounded_ratio(units: Column, count: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    """A total of units divided by ``count``, with ``places`` decimals; NULL when count is 0.

    Both operands are whole numbers, so an exact tie is still a tie when it is rounded.
    """
    divisor = F.nullif(count, F.lit(0)) * F.lit(float(10 ** (scale - places)))
    return F.round(units / divisor, 0) / F.lit(float(10**places))


def total(units: Column, rest: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    """Rounded total of summed units and summed remainders; exact and order-free while those are 0."""
    value = sql_round(units / F.lit(float(10**scale)) + rest, places)
    return F.when(rest == 0, rounded_total(units, places, scale)).otherwise(value)


def ratio(units: Column, rest: Column, count: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    """``total`` divided by ``count``, rounded."""
    value = sql_round((units / F.lit(float(10**scale)) + rest) / F.nullif(count, F.lit(0)), places)
    return F.when(rest == 0, rounded_ratio(units, count, places, scale)).otherwise(value)


def exact_sum(value: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    return total(F.sum(to_units(value, scale)), F.sum(off_grid(value, scale)), places, scale)


def exact_avg(value: Column, places: int, scale: int = AMOUNT_SCALE) -> Column:
    """Mean over the non-NULL values."""
    return ratio(F.sum(to_units(value, scale)), F.sum(off_grid(value, scale)), F.count(value), places, scale)


def whole_avg(value: Column) -> Column:
    """Mean of an integer column without decimals; integer sums are exact already."""
    return F.round(F.avg(value), 0)
