"""Units of a limited supply dealt to requests in their order: the overlap of two intervals.

Within a key, a request takes the interval from the sum of those before it to that sum and its own; the supply is the interval
from 0 to what there is. What a request gets is the length of the overlap, so the parts add up to the lesser of all
requests and the supply, and no request is served by looking at another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def allocate(requests: DataFrame, supply: DataFrame, keys: list[str], order: list[str], qty: str, available: str, served: str) -> DataFrame:
    """``requests`` with a column ``served``: its part of ``supply`` (one row a key; none counts as nothing available).

    Requests of a key are served in the strict order ``order``. A negative or null supply serves none. The window runs over the
    requests of one key, so the keys should include the day.
    """
    upto = F.sum(qty).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    got = F.least(F.col("_upto"), F.coalesce(F.col(available), F.lit(0))) - (F.col("_upto") - F.col(qty))
    return (requests.withColumn("_upto", upto).join(supply.select(*keys, available), keys, "left")
            .withColumn(served, F.greatest(got, F.lit(0)).cast("long")).drop("_upto", available))
