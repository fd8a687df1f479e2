"""Interval and trailing-range aggregates written as event sums, never as pairwise range joins.

A range join (snapshot x every purchase order of the same series) emits all pairs inside a key before
filtering; with one hot key that is quadratic. Here every interval becomes at most two dated
events, pre-aggregated per key and day, and a running sum over the (calendar-bounded) days of a key
answers "what is open on day d" for every day at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def open_events(intervals: DataFrame, keys: list[str], start: str, end: str, qty: str, day: str = "date") -> DataFrame:
    """Changes of the open quantity: +qty on ``start``, -qty on ``end`` (a null end never closes), a row each.

    An interval is open on d when start <= d < end, so the closing event applies on ``end`` itself.
    """
    ev = intervals.select(*keys, F.explode(F.array(
        F.struct(F.col(start).alias("d"), F.col(qty).cast("long").alias("q")),
        F.struct(F.col(end).alias("d"), (-F.col(qty)).cast("long").alias("q")))).alias("e"))
    return ev.filter(F.col("e.d").isNotNull()).select(*keys, F.col("e.d").alias(day), F.col("e.q").alias("open_delta"))


def open_deltas(intervals: DataFrame, keys: list[str], start: str, end: str, qty: str, day: str = "date") -> DataFrame:
    """Daily change of the open quantity: ``open_events`` summed by key and day."""
    return open_events(intervals, keys, start, end, qty, day).groupBy(*keys, day).agg(F.sum("open_delta").alias("open_delta"))


def day_number(c: Column) -> Column:
    return F.unix_date(c)


def trailing_stats(daily: DataFrame, keys: list[str], day: str, days: int, sums: list[str]) -> DataFrame:
    """Sums of the listed daily columns over the trailing ``days`` days (d - days, d], by key.

    ``daily`` holds at most one row per key and day; days without a row count as zero.
    """
    w = (Window.partitionBy(*keys).orderBy(day_number(F.col(day)))
         .rangeBetween(-(days - 1), Window.currentRow))
    return daily.select("*", *[F.sum(c).over(w).alias(f"{c}_trailing") for c in sums])


def next_on_or_after(dates: DataFrame, day: str, events: DataFrame, event_day: str) -> DataFrame:
    """For every distinct ``day``, the first event day on or after it (null after the last event).

    Both inputs are calendar-sized (days and a short list of event days), so one ordered window
    over their union is bounded; no cross join is formed.
    """
    d = dates.select(F.col(day).alias("_d")).distinct().withColumn("_is_event", F.lit(False))
    e = events.select(F.col(event_day).alias("_d")).withColumn("_is_event", F.lit(True))
    w = (Window.orderBy(F.col("_d").desc(), F.col("_is_event").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = d.unionByName(e).select("_d", "_is_event",
                                F.min(F.when(F.col("_is_event"), F.col("_d"))).over(w).alias("next_event"))
    return u.filter(~F.col("_is_event")).select(F.col("_d").alias(day), "next_event")
