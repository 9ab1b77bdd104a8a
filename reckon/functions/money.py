"""Integer money: minor units in 64-bit integers, never a floating type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(n: Column, d: int) -> Column:
    """n / d rounded to the nearest integer, halves away from zero; d positive. NULL stays NULL."""
    # Dividing integers with / gives a double in Spark; div and pmod stay integral.
    size = F.abs(n)
    whole, rest = F.call_function("div", size, F.lit(d)), F.pmod(size, F.lit(d))
    quotient = whole + F.when(rest * 2 >= d, 1).otherwise(0)
    return F.when(n < 0, -quotient).otherwise(quotient)


def settled(amount: Column, rate_bp: Column | int) -> Column:
    """An amount converted at a rate in hundredths, rounded half up."""
    return half_up(amount * rate_bp, 100)


def midnight_after(ts: Column, days: int) -> Column:
    """Midnight UTC of the day so many days after the day of ``ts``."""
    return F.date_add(F.to_date(ts), days).cast("timestamp")
