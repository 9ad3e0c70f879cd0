"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL (ANSI mode raises on /0)."""
    return F.when((den.isNull()) | (den == 0), F.lit(default)).otherwise(
        num.cast("double") / den.cast("double"))


def is_weekend(date: Column) -> Column:
    """Saturday or Sunday: ``weekday`` is Monday=0 (trap X-9)."""
    return F.weekday(date) >= 5


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two DATE values (cast first, trap X-2)."""
    return F.datediff(later.cast("date"), earlier.cast("date"))


def clip01(c: Column) -> Column:
    """Clipped to [0, 1]; NULL stays NULL (``least`` alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))
