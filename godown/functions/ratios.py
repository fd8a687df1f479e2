"""Guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """``a / b`` as a double, null when ``b`` is zero or null (never an error, never infinity)."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def capped_ratio(a: Column, b: Column, cap: float) -> Column:
    """``least(a / nullif(b, 0), cap)``: a zero or null denominator gives the cap, because ``least``
    skips nulls."""
    return F.least(safe_div(a, b), F.lit(float(cap)))
