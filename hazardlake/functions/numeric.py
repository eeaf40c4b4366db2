"""Rounding and division that give the same answer whatever the order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SNAP_DIGITS = 8


def snap(value: Column) -> Column:
    """Drop the last bits of a floating-point mean.

    Partial sums arrive in a different order on every run, so a mean differs in its last bits.
    Cutting at 8 decimals makes comparisons and roundings after it repeatable.
    """
    return F.rint(value * float(10**_SNAP_DIGITS)) / float(10**_SNAP_DIGITS)


def round_to(value: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals, deciding ties on the snapped value.

    ``rint`` stays inside generated code; ``round``/``bround`` on doubles go through BigDecimal.
    """
    coarse = float(10 ** (_SNAP_DIGITS - digits))
    return F.rint(F.rint(value * float(10**_SNAP_DIGITS)) / coarse) / float(10**digits)


def ratio(numerator: Column, denominator: Column, when_zero: float | None = 0.0) -> Column:
    """``numerator / denominator`` with a value for a zero denominator (ANSI mode would raise)."""
    other = F.lit(None).cast("double") if when_zero is None else F.lit(when_zero)
    return F.when(denominator != 0, numerator / denominator).otherwise(other)
