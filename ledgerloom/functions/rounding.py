"""Rounding rules shared by every query.

Money stays DECIMAL until the output edge: rounding a binary double at two digits depends on the
engine, rounding a decimal does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(col: Column | str) -> Column:
    """A source amount as DECIMAL(18,4)."""
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def to_cents(col: Column) -> Column:
    """DECIMAL rounded half-up to two digits."""
    return F.round(col, 2)


def money2(col: Column) -> Column:
    """Rounded money as a double, for results."""
    return F.round(col, 2).cast("double")


def ratio(numerator: Column, denominator: Column, digits: int = 2, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale`` rounded through DECIMAL; NULL when the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double") * F.lit(scale), denominator.cast("double"))
    return F.round(quotient.cast("decimal(24,6)"), digits).cast("double")


def ratio_decimal(numerator: Column, denominator: Column, digits: int = 1, scale: float = 100.0) -> Column:
    """As :func:`ratio` but kept DECIMAL, for text output such as ``12.5%``."""
    quotient = F.try_divide(numerator.cast("double") * F.lit(scale), denominator.cast("double"))
    return F.round(quotient.cast("decimal(24,6)"), digits).cast(f"decimal(20,{digits})")


def dollars(col: Column) -> Column:
    """``$1234.50`` text without thousands marks."""
    return F.concat(F.lit("$"), F.round(col, 2).cast("decimal(38,2)").cast("string"))
