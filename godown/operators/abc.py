"""ABC classification by cumulative value share, over all sales or as of given days."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal, localcontext
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from godown.config import ABC_A, ABC_B
from godown.operators.prefix import prefix_sums
from godown.session import cut_lineage


def _share(share: float, total):
    """A share of a total, exact but for doubles."""
    with localcontext(prec=76):
        return share * total if isinstance(total, float) else Decimal(str(share)) * total


def abc_classes(values: DataFrame, key: str, value: str = "value", a: float = ABC_A, b: float = ABC_B,
                buckets: int | None = None) -> DataFrame:
    """Class of every key from its value (one row per key; null value counts as zero).

    Keys are ranked by value, largest first, ties broken by key. The class is decided by the share
    of total value held by the keys ranked *before* this one: below ``a`` is A, below ``b`` is B,
    else C. So the item that crosses the boundary stays in the higher class, and keys with no value
    come last. Shares are compared exactly (decimal values: before < a * total).
    """
    v = values.select(key, F.coalesce(F.col(value), F.lit(0)).alias("_v"))
    ranked, totals = prefix_sums(v, [("_v", False), (key, True)], {"_before": F.col("_v")}, buckets, inclusive=False)
    before, total = F.col("_before"), totals["_before"]
    return ranked.select(
        key, F.col("_v").alias(value),
        F.when(before < F.lit(_share(a, total)), "A").when(before < F.lit(_share(b, total)), "B").otherwise("C").alias("abc_class"))


def abc_runs(sales: DataFrame, key: str, day: str, value: str, days: list[date], a: float = ABC_A, b: float = ABC_B,
             buckets: int | None = None) -> DataFrame:
    """Classes as of each of ``days``, from the sales up to and on it, as runs: key, valid_from, valid_to, abc_class.

    A run starts on one of ``days`` and ends the day before the next run's start (null: open). A key has no row before the
    first of ``days`` on or after its first sale; it is C there, as are keys without sales. Sales after the last of ``days``,
    without a day or without a key are left out; a null value counts as zero. ``value`` is a decimal or a whole number.

    Only changes are summed and moved; a key then has a row a day, and all days are ranked in one ordered pass: their
    totals, which are rows of the calendar, take a day's start out of the running sum.
    """
    spark = sales.sparkSession
    days = sorted(set(days))
    if not days:
        raise ValueError("no days to classify on")
    first = days[0]
    following = []  # the day that first counts the sales of each day of the calendar
    for d in days:
        following += [d] * ((d - first).days + 1 - len(following))
    of_calendar = spark.createDataFrame([(following,)], "following array<date>").scalar()
    counted = F.get(of_calendar, F.greatest(F.datediff(day, F.lit(first)), F.lit(0)))
    w = Window.partitionBy(key).orderBy("_day")
    changes = (sales.filter(F.col(day).isNotNull() & F.col(key).isNotNull()).select(key, counted.alias("_day"), F.col(value).alias("_v"))
               .filter(F.col("_day").isNotNull()).groupBy(key, "_day").agg(F.coalesce(F.sum("_v"), F.lit(0)).alias("_added"))
               .select(key, "_day", "_added", F.sum("_added").over(w).alias("_v"), F.lead("_day").over(w).alias("_until")))
    changes = cut_lineage(changes)
    added = {r["_day"]: r["_sum"] for r in changes.groupBy("_day").agg(F.sum("_added").alias("_sum")).collect()}  # rows of the calendar
    with localcontext(prec=76):
        totals = list(accumulate((added.get(d, 0) for d in days)))
        starts = list(accumulate(totals, initial=0))
        cuts = [(d, Decimal(s), _share(a, t) + s, _share(b, t) + s) for d, s, t in zip(days, starts, totals)]
    limits = F.broadcast(spark.createDataFrame(cuts, "_day date, _start decimal(38,4), _a decimal(38,4), _b decimal(38,4)"))
    here = F.filter(F.lit(days), lambda d: (d >= F.col("_from")) & (F.col("_until").isNull() | (d < F.col("_until"))))
    states = changes.withColumnRenamed("_day", "_from").select(key, F.explode(here).alias("_day"), "_v")
    ranked, _ = prefix_sums(states, [("_day", True), ("_v", False), (key, True)], {"_before": F.col("_v")}, buckets, inclusive=False)
    of_key = Window.partitionBy(key).orderBy("_day")
    classed = ranked.join(limits, "_day").select(
        key, "_day", F.when(F.col("_before") < F.col("_a"), "A").when(F.col("_before") < F.col("_b"), "B").otherwise("C").alias("abc_class"))
    turns = classed.withColumn("_was", F.lag("abc_class").over(of_key)).filter(~F.col("_was").eqNullSafe(F.col("abc_class")))
    return turns.select(key, F.col("_day").alias("valid_from"), F.date_sub(F.lead("_day").over(of_key), 1).alias("valid_to"), "abc_class")


def class_on(rows: DataFrame, runs: DataFrame, key: str, day: str, name: str = "abc_class") -> DataFrame:
    """``rows`` with the class that ``abc_runs`` gives their key on their day, as column ``name`` (replaced where it is there).

    A key's runs, at most one a day of the calendar, travel as one array, so the join is by key alone and makes one row a
    row. C before a key's first run, without a key, or without a day.
    """
    of_key = (runs.groupBy(F.col(key).alias("_key"))
              .agg(F.sort_array(F.collect_list(F.struct("valid_from", F.col("abc_class").alias("c")))).alias("_runs")))
    begun: Column = F.filter("_runs", lambda r: r["valid_from"] <= F.col(day))
    at = F.when(F.size(begun) > 0, F.element_at(begun, -1)["c"])
    kept = [c for c in rows.columns if c != name]
    return (rows.join(of_key, F.col(key) == F.col("_key"), "left")
            .select(*kept, F.coalesce(at, F.lit("C")).alias(name)))


def mondays_and_months(start: date, end: date) -> tuple[list[date], list[date]]:
    """The Mondays, and the firsts of months, of a calendar."""
    days = [start + timedelta(n) for n in range((end - start).days + 1)]
    return [d for d in days if d.weekday() == 0], [d for d in days if d.day == 1]
