"""Lost-sales stock replay in closed form (no day-by-day loop).

With S_t = opening + running sum of (receipts - demand), the recursion
on_hand_t = max(on_hand_{t-1} + receipts_t - demand_t, 0) equals S_t - least(0, running min of S).
The regulator reg_t = -least(0, min S) is the demand that could not be served up to day t, so
the units actually shipped on day t are demand_t - (reg_t - reg_{t-1}).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replay(daily: DataFrame, keys: list[str], day: str, receipts: str, demand: str, opening: int) -> DataFrame:
    """Add ``on_hand`` and ``shipped`` to a dense daily series (one row per key and day)."""
    w = Window.partitionBy(*keys).orderBy(day)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = daily.withColumn("_s", F.lit(opening).cast("long") + F.sum(F.col(receipts) - F.col(demand)).over(upto))
    s = s.withColumn("_reg", -F.least(F.lit(0).cast("long"), F.min("_s").over(upto)))
    return (s.withColumn("on_hand", (F.col("_s") + F.col("_reg")).cast("int"))
             .withColumn("shipped", (F.col(demand) - (F.col("_reg") - F.lag("_reg", 1, 0).over(w))).cast("int"))
             .drop("_s", "_reg"))
