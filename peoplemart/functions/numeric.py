"""Exact rounding on integers and decimals.

Ratios and means are rounded once, half away from zero, from integer operands, so a
result never depends on the order in which partial sums were merged.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def shifted(value: Column, digits: int) -> Column:
    """An integer read as a decimal with `digits` decimals: 1234, 2 -> 12.34."""
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (value.cast("decimal(20,0)") * unit).cast(f"decimal(18,{digits})")


def in_units(value: Column, digits: int) -> Column:
    """A decimal with at most `digits` decimals as an exact integer: 12.34, 2 -> 1234."""
    return (value * F.lit(10**digits)).cast("bigint")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator at `digits` decimals; NULL where the denominator is 0.

    Both operands are integers, the denominator is not negative.
    """
    top = F.abs(numerator.cast(_WIDE)) * F.lit(2 * 10**digits)
    bottom = F.nullif(denominator.cast(_WIDE), F.lit(0))
    nearest = F.call_function("div", top + bottom, bottom * F.lit(2))
    return shifted(F.when(numerator < 0, -nearest).otherwise(nearest), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """part as a percentage of whole."""
    return ratio(part.cast(_WIDE) * F.lit(100), whole, digits)


def mean_rank_key(total: Column, count: Column) -> Column:
    """An integer that orders groups by their exact mean total / count.

    `total` is at most about 100 per counted row (ratings in tenths are at most 50), so
    the key stays below 10^18 however many rows one group has.
    """
    return F.call_function("div", total.cast(_WIDE) * F.lit(10**16), count.cast(_WIDE))


def sample_deviation(count: Column, total: Column, squares: Column, digits: int, scale: int) -> Column:
    """Sample standard deviation from exact integer moments of values held in 10^-scale units.

    One square root on exact operands; NULL for fewer than two values.
    """
    n = count.cast(_WIDE)
    top = (n * squares.cast(_WIDE) - total.cast(_WIDE) * total.cast(_WIDE)).cast("double")
    bottom = (n * (n - F.lit(1))).cast("double")
    rounded = F.floor(F.sqrt(top / F.nullif(bottom, F.lit(0.0))) * F.lit(10.0 ** (digits - scale)) + F.lit(0.5))
    return shifted(rounded, digits)


def how_many(condition: Column) -> Column:
    """Rows for which the condition is true."""
    return F.count(F.when(condition, 1))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of value over the rows for which the condition is true, 0 elsewhere."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))
