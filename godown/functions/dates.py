"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year_label(d: Column, start_month: int = 4) -> Column:
    """``FY 2023-24`` style label of a fiscal year starting in ``start_month``."""
    first = F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)
    return F.concat(F.lit("FY "), first.cast("string"), F.lit("-"), F.substring((first + 1).cast("string"), -2, 2))


def week_start(d: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(d, "week")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def is_monday(d: Column) -> Column:
    return F.weekday(d) == 0
