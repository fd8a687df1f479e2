"""Sparse stock ledger by centre and product: rows only on days with a flow, and states on any list of days.

The dense ledger has a row a series and day, which centres x products x days cannot afford. A series' stock changes only on days
with a flow, and the lost-sales replay needs no others: demand of nothing moves neither the running sum nor its minimum.
So a run holds from its day to the day before the next one. States on given days (snapshots) are rows without a flow among
the others; trailing demand is a sum over a range of days, and the label looks for an empty run in the range ahead. Only days on
which a state may differ from that of the day asked before are worked out; it is held on those that follow.
All of it runs in one partitioning by series, over rows that are summed by day before they move.

A series without any flow holds its opening stock at all times; it has no rows here.
"""

from __future__ import annotations

from bisect import bisect_left
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from godown.config import HORIZON_DAYS, Calendar
from godown.operators.intervals import open_events
from godown.operators.replay import replay
from godown.plans.model import accepted_units

FLOWS = ("demand", "accepted", "open_delta")


def daily_flows(lines: DataFrame, receipts: DataFrame, pos: DataFrame, keys: list[str], cal: Calendar) -> DataFrame:
    """Units ordered, units accepted and the change of open purchase orders, a row a series and day with any of them.

    ``lines`` has order_date and qty_ordered, ``pos`` order_date, last_received and qty_ordered by ``keys``; receipts find
    their series by po_id, or are listed by ``pos``. A flow outside the calendar is an error, never a dropped row. All kinds of
    flow are summed together, so they move once.
    """
    zero = F.lit(0).cast("long")
    parts = {"demand": lines.select(*keys, F.col("order_date").alias("date"), F.col("qty_ordered").alias("demand")),
             "accepted": accepted_units(receipts, pos, keys).withColumnRenamed("units", "accepted"),
             "open_delta": open_events(pos, keys, "order_date", "last_received", "qty_ordered")}
    out = None
    for name, df in parts.items():
        df = df.select(*keys, "date", *[F.col(c).cast("long") if c == name else zero.alias(c) for c in FLOWS])
        out = df if out is None else out.unionByName(df)
    inside = F.when(F.col("date").between(F.lit(cal.start), F.lit(cal.end)), F.col("date")).otherwise(
        F.raise_error(F.concat(F.lit("a flow lies outside the calendar: "), F.col("date").cast("string"))))
    return out.groupBy(*keys, inside.alias("date")).agg(*[F.sum(c).alias(c) for c in FLOWS])


def _dealt(flows: DataFrame, keys: list[str]) -> DataFrame:
    """The flows dealt by series."""
    return flows.repartition(int(flows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stock_runs(flows: DataFrame, keys: list[str], cal: Calendar) -> DataFrame:
    """A row a run: keys, valid_from, valid_to, on_hand, shipped (units on its first day) and open_po_units; a series' runs
    cover the calendar without a gap. Flows are dealt by series once; a series' opening row is made next to its first."""
    w = Window.partitionBy(*keys).orderBy("date")
    late = _dealt(flows, keys).withColumn("_late", F.lag("date").over(w).isNull() & (F.col("date") > F.lit(cal.start)))
    both = late.select("*", F.explode(F.when(F.col("_late"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("_opens"))
    rows = both.select(*keys, F.when(F.col("_opens"), F.lit(cal.start)).otherwise(F.col("date")).alias("date"),
                       *[F.when(F.col("_opens"), F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in FLOWS])
    led = replay(rows, keys, "date", "accepted", "demand", cal.opening_stock)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return led.select(*keys, F.col("date").alias("valid_from"), F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.lit(cal.end)).alias("valid_to"),
                      "on_hand", "shipped", F.sum("open_delta").over(upto).alias("open_po_units"))


def state_runs(flows: DataFrame, keys: list[str], days: Column, cal: Calendar, horizon: int = HORIZON_DAYS) -> DataFrame:
    """The states of every series on the days of the array ``days`` (a literal of the calendar), a row a run of asked days with
    one state: ``held`` (the days), and of each of them on_hand, open_po_units, reorder_point (8/28 of the last 28 days' demand),
    demand_28d, demand_7d, demand_sd_28d over the days since the calendar's start, and out_next_14d (out of stock on any of
    the next ``horizon`` days; null on the last day). A series' runs hold each asked day once.

    A flow changes what is seen on its day, on the next, and 7 and 28 days on, when demand leaves a sum; an empty run changes the
    label ``horizon`` days before its first day and on its last, the day before a flow. The first asked day from each of these on
    starts a run, as do the days until the sums have 28 days behind them.
    """
    spark = flows.sparkSession
    listed = sorted({d for d in spark.range(1).select(days.alias("d")).first()["d"] if cal.start <= d <= cal.end})  # days of the calendar
    grown = cal.start + timedelta(27)
    always = [i for i, d in enumerate(listed) if i == 0 or d <= grown or listed[i - 1] < grown or d == cal.end]
    following = [bisect_left(listed, cal.start + timedelta(i)) for i in range((cal.end - cal.start).days + 1)]
    of_calendar = spark.createDataFrame([(listed, [(d - cal.start).days for d in listed], following, always)],
                                        "listed array<date>, numbers array<int>, following array<int>, always array<int>")
    all_days, asked_days, nexts, fixed = (of_calendar.select(c).scalar() for c in of_calendar.columns)

    def place(day: Column) -> Column:
        """The place among the asked days of the first from the ``day`` of the calendar on (null beyond it)."""
        return F.get(nexts, F.greatest(day, F.lit(0)))

    # Days are numbers from the calendar's start on, by which all windows are ordered: rows are sorted once. Dealt by series once; a
    # flow makes its asked days where it lies, the first of a series also those asked of all.
    day, last = F.col("_day"), (cal.end - cal.start).days
    w = Window.partitionBy(*keys).orderBy("_day")
    dealt = _dealt(flows, keys).select(*keys, F.datediff("date", F.lit(cal.start)).alias("_day"), *FLOWS).withColumn("_first", F.lag("_day").over(w).isNull())
    leaves = [F.when(F.col("demand") != 0, place(day + k)) for k in (1, 7, 28)]
    turns = F.array_distinct(F.array(F.lit(-1), place(day - horizon), place(day - 1), place(day), *leaves))
    own = F.col("_at") == -1
    places = dealt.select("*", F.explode(F.when(F.col("_first"), F.concat(turns, fixed)).otherwise(turns)).alias("_at"))
    rows = (places.select(*keys, F.when(own, day).otherwise(F.get(asked_days, F.col("_at"))).alias("_day"),
                          *[F.when(own, F.col(c)).otherwise(F.lit(0).cast("long")).alias(c) for c in FLOWS],
                          F.when(own, 0).otherwise(1).alias("asked")).filter(day.isNotNull())
            .groupBy(*keys, "_day").agg(*[F.sum(c).alias(c) for c in FLOWS], F.max("asked").alias("asked")))
    led = replay(rows, keys, "_day", "accepted", "demand", cal.opening_stock)
    month, week, ahead = w.rangeBetween(-27, 0), w.rangeBetween(-6, 0), w.rangeBetween(1, horizon)
    d, empty = F.col("demand"), F.col("on_hand") <= 0
    age = day + 1
    led = led.select("*", F.sum(d).over(month).alias("_s28"), F.sum(d * d).over(month).alias("_q28"), F.sum(d).over(week).alias("_s7"),
                     F.sum("open_delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("open_po_units"),
                     F.coalesce(F.bool_or(empty).over(ahead), F.lit(False)).alias("_ahead"), F.lead("_day").over(w).alias("_next"),
                     F.least(age, F.lit(28)).alias("_n28"), F.least(age, F.lit(7)).alias("_n7"))
    lasts = empty & (F.col("_next").isNull() | (F.col("_next") - day > 1))  # the run goes on tomorrow
    var = (F.col("_n28") * F.col("_q28") - F.col("_s28") * F.col("_s28")).cast("double")
    led = led.withColumn("_ends", lasts).filter("asked = 1").withColumn("place", place(day))
    led = led.withColumn("until", F.coalesce(F.lead("place").over(w), F.lit(len(listed))))
    return led.select(
        *keys, F.slice(all_days, F.col("place") + 1, F.col("until") - F.col("place")).alias("held"), "demand", "on_hand", "open_po_units",
        F.expr("CAST((_s28 * 8) div 28 AS INT)").alias("reorder_point"),
        (F.col("_s28") / F.col("_n28")).alias("demand_28d"), (F.col("_s7") / F.col("_n7")).alias("demand_7d"),
        (F.sqrt(F.greatest(var, F.lit(0.0))) / F.col("_n28")).alias("demand_sd_28d"),
        F.when(day < last, F.col("_ahead") | F.col("_ends")).alias("out_next_14d"))


def states_on(flows: DataFrame, keys: list[str], days: Column, cal: Calendar, horizon: int = HORIZON_DAYS) -> DataFrame:
    """The states of ``state_runs``, a row a series and asked day."""
    runs = state_runs(flows, keys, days, cal, horizon)
    return runs.select(*keys, F.explode("held").alias("date"), *[c for c in runs.columns if c not in (*keys, "held")])


def mondays(cal: Calendar) -> Column:
    """The snapshot days of a calendar as an array."""
    first = F.next_day(F.date_sub(F.lit(cal.snapshot_from), 1), "Mon")
    return F.when(first <= F.lit(cal.end), F.sequence(first, F.lit(cal.end), F.expr("interval 7 days"))).otherwise(F.array().cast("array<date>"))
