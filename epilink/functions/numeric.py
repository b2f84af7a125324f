"""Number rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: 2**27 + 1, splits a double into two halves that multiply without error.
_SPLITTER = 134217729.0


def python_round(c: Column, digits: int = 3) -> Column:
    """Round the exact binary value, ties to even.

    ``bround`` rounds the printed decimal instead, so it turns 0.0005 (stored a
    little above the tie) into 0.0 where this gives 0.001. The distance to the
    tie is computed without rounding error: the value is split into two halves
    whose products with the scale are exact. Meant for values below 2**26 / scale
    in size, such as rates.
    """
    x = c.cast("double")
    scale = float(10**digits)
    split = x * F.lit(_SPLITTER)
    high = split - (split - x)
    low = x - high
    base = F.floor(x * F.lit(scale)).cast("double")
    above_tie = (high * F.lit(scale) - (base + F.lit(0.5))) + low * F.lit(scale)
    even = F.pmod(base, F.lit(2.0)) == 0
    return F.when((above_tie > 0) | ((above_tie == 0) & ~even), base + 1).otherwise(base) / F.lit(scale)


def whole_number(c: Column) -> Column:
    """Truncate towards zero; text that is no number gives null instead of an error."""
    return c.try_cast("bigint")


def clamp_to_zero(c: Column) -> Column:
    """Whole number, never negative; null stays null."""
    whole = whole_number(c)
    return F.when(whole < 0, F.lit(0)).otherwise(whole)
