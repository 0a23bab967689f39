"""Rounding and ratios on DOUBLE columns.

Engines disagree on ``round(double)``: some round the decimal text, some the scaled
binary value, some half to even. The two helpers below pin the behaviour, so results do
not depend on the engine. Money stays DECIMAL and needs neither.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,2)"


def half_up(value: Column, digits: int = 2) -> Column:
    """Round half away from zero on the scaled value, as SQL ROUND does."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale)


def half_even(value: Column, digits: int = 2) -> Column:
    """Round half to even on the scaled value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(value * scale) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """DOUBLE quotient; NULL when the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double") * 100.0, bottom.cast("double"))


def money(value: Column) -> Column:
    """Round a computed DOUBLE to cents and keep it exact from there on."""
    return half_even(value, 2).cast(MONEY)
