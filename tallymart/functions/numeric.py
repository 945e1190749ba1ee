"""Column helpers for money, ratios and defensive casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
NUDGE = 1e-7


def round_half_up(value: Column, digits: int) -> Column:
    """Round away from zero; the nudge settles values a hair below a half."""
    return F.round(value + F.signum(value) * F.lit(NUDGE), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_even(value: Column, digits: int) -> Column:
    """A double rounded as array libraries do: scaled, to the nearest whole number, a half to the even one.

    A nudge or a rounding up would lift every second exact half, as of 0.125 or 6.25 %.
    """
    scale = F.lit(10.0**digits)
    return F.rint(value.cast("double") * scale) / scale


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return round_half_up(ratio(numerator, denominator) * 100, digits)


def percent_even(numerator: Column, denominator: Column, digits: int) -> Column:
    return round_half_even(ratio(numerator, denominator) * 100, digits)


def growth_percent_even(current: Column, base: Column, digits: int) -> Column:
    return percent_even(current - base, base, digits)


def growth_percent(current: Column, base: Column, digits: int) -> Column:
    """Relative change against ``base`` in percent; null without a usable base."""
    return percent(current - base, base, digits)


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (least/greatest alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(value, F.lit(high))))


def nan_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(float("nan")))  # works the value out once


def amount(name: str = "final_amount") -> Column:
    """A money column as an exact decimal, so that sums do not depend on row order."""
    return F.col(name).try_cast(MONEY)


def summed(name: str = "final_amount") -> Column:
    """Exact sum of a money column; a group of nulls alone sums to zero."""
    return F.coalesce(F.sum(amount(name)), F.lit(0))
