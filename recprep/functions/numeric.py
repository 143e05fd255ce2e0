"""Arithmetic whose result does not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c: Column | str, places: int) -> Column:
    """Round half away from zero in binary floating point.

    ``F.round`` on a double goes through BigDecimal per row; this stays in primitive
    arithmetic and rounds as SQL engines with a C ``round`` do. Values from 2^52 units on have
    no digits to round and stay as they are.
    """
    c = col(c)
    scale = float(10**places)
    units = F.abs(c) * F.lit(scale)
    whole = F.floor(units).cast("double")
    rounded = F.signum(c) * (whole + F.when(units - whole >= 0.5, 1.0).otherwise(0.0)) / F.lit(scale)
    return F.when(units < float(1 << 52), rounded).otherwise(c.cast("double"))


def ratio_round(c: Column | str, places: int) -> Column:
    """``round_to`` for values that carry last-bit noise (roots, logs): snap, then round."""
    return round_to(round_to(c, places + 6), places)


def split_units(c: Column | str, places: int) -> tuple[Column, Column]:
    """A value as whole units of 10^-places and what is left of it: nothing is cut off.

    The rest is exactly 0.0 for a value that has no more than ``places`` decimals, and for
    values so large (2^52 units) that a double holds no smaller part.
    """
    value, scale = col(c).cast("double"), F.lit(float(10**places))
    whole = F.rint(value * scale)
    return whole, F.when(F.abs(whole) < float(1 << 52), value - whole / scale).otherwise(F.lit(0.0))


def fixed_sum(c: Column | str, places: int = 4) -> Column:
    """Sum of whole units of 10^-places plus the sum of the rests.

    Whole units are exact in a double up to 2^53, so for values with at most ``places``
    decimals partial sums can meet in any order (or be recomputed after a lost executor) and
    still give the same bits. Finer values keep all their digits; their sum, like sums above
    2^53 units, is as exact as a plain double sum.
    """
    whole, rest = split_units(c, places)
    return F.sum(whole) / F.lit(float(10**places)) + F.sum(rest)


def fixed_avg(c: Column | str, places: int = 4) -> Column:
    """Average built on the same sum."""
    return fixed_sum(c, places) / F.nullif(F.count(col(c)), F.lit(0))


def safe_div(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom``, NULL when the divisor is 0 or NULL."""
    bottom = col(bottom)
    return F.when(bottom != 0, col(top) / bottom)


def clamp(c: Column | str, low, high) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def count_when(test: Column) -> Column:
    """COUNT(CASE WHEN test THEN 1 END)."""
    return F.count(F.when(test, F.lit(1)))


def flag(test: Column) -> Column:
    """0/1 label; NULL counts as 0."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0)).cast("long")


def or_zero(c: Column | str, as_type: str = "long") -> Column:
    return F.coalesce(col(c), F.lit(0).cast(as_type))


def bit_of(value: Column) -> Column:
    """A long with the bit of an integer 0..63 set; other values are an error, not another bit."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.cast("int"))
    wrong = F.raise_error(F.concat(F.lit("value outside 0..63: "), value.cast("string"))).cast("long")
    return F.when(value.isNull() | value.between(0, 63), bit).otherwise(wrong)


def count_small_domain(value: Column) -> Column:
    """Exact COUNT(DISTINCT value) for integers 0..63, as one bit mask per group.

    Month, weekday or hour counts need no DISTINCT, hence no Expand and no extra shuffle.
    """
    return F.coalesce(
        F.bit_count(F.bit_or(bit_of(value))),
        F.lit(0),
    ).cast("long")
