"""Rounding to digits and steps, ties to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int) -> Column:
    """``round(x, digits)`` on doubles: of the two neighbours with that many digits the one nearer to x.

    The neighbours are floor(x 10^d) / 10^d and ceil(x 10^d) / 10^d as doubles, and the
    distances are taken to x itself, so a product a hair above a tie rounds up even
    where x 10^d falls on the tie. Equal distances go to the even last digit.
    """
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10 ** digits))
    low_units = F.floor(c * scale).cast("double")
    low, high = low_units / scale, F.ceil(c * scale).cast("double") / scale
    down, up = c - low, high - c
    return (F.when(down < up, low).when(up < down, high)
            .when(low_units % 2 == 0, low).otherwise(high))


def round_to_step(c: Column, step: float) -> Column:
    """Round to a multiple of ``step`` (ties to even): rint(x / step) * step."""
    return F.rint(c / F.lit(step)) * F.lit(step)


def round6(c: Column) -> Column:
    """Six-digit rounding of a statistic (decimal half-even on the double's value)."""
    return F.bround(c, 6)
