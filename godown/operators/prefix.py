"""Prefix sums in a global order without a single-partition window.

A window with no PARTITION BY moves every row to one task. ``prefix_sums`` cuts the order into buckets at keys of a
bounded sample, so a row knows its bucket by comparison, rows move once, by bucket, and sums of buckets give the offsets.

In ``ordered_prefix_sums`` (any sort expressions, two exchanges) the rows are range-partitioned on
the ordering (a strict total order, so ties are split deterministically), each range gets its local
running sum, the range totals (one row per range) give the offsets, and a broadcast join of those
offsets finishes the sum. The ranged frame is checkpointed once so the local sums and the range
totals come from the same materialisation even if an executor is lost in between.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.session import cut_lineage

#: Sampled keys a bucket, and rows a bucket below which fewer buckets are made.
SAMPLED, SMALL = 32, 65_536


def _ascending(df: DataFrame, order: list[tuple[str, bool]]) -> Column:
    """A struct whose ascending order is the order asked for, nulls and NaN placed as Spark's sort places them."""
    parts = []
    for name, ascending in order:
        kind, c = df.schema[name].dataType, F.col(name)
        if ascending:
            parts.append(c)
        elif isinstance(kind, T.IntegralType | T.DateType):  # no overflow at the least value
            parts += [c.isNull(), F.bitwise_not(F.unix_date(c) if isinstance(kind, T.DateType) else c)]
        elif isinstance(kind, T.DecimalType):
            parts += [c.isNull(), -c]
        elif isinstance(kind, T.FractionalType):
            parts += [c.isNull(), ~F.isnan(c), -c]
        else:
            raise ValueError(f"{name}: {kind.simpleString()} is only taken in ascending order")
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(parts)])


def prefix_sums(df: DataFrame, order: list[tuple[str, bool]], sums: dict[str, Column], buckets: int | None = None,
                inclusive: bool = True) -> tuple[DataFrame, dict[str, object]]:
    """``df`` with one column per entry of ``sums`` (the total of that expression over every row at or before this one, or
    strictly before it), and the totals over all rows by name.

    ``order`` lists ``(column, ascending)`` and must be strict (end it with a unique key); texts are only taken in ascending
    order; nulls come first where ascending, last where descending, and count as nothing in a sum. Without rows the totals
    are zero. ``df`` is computed once and written; a sample of about ``SAMPLED`` keys a bucket and a total a bucket reach
    the driver.
    """
    spark = df.sparkSession
    kept = cut_lineage(df)
    values = {k: F.coalesce(c, F.lit(0)) for k, c in sums.items()}
    rows = kept.count()
    n = buckets or min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // SMALL + 1)
    share = int(min(1.0, n * SAMPLED / max(rows, 1)) * 2 ** 30)
    key = _ascending(df, order)
    nullable = kept.select(key.alias("k")).schema["k"].dataType.simpleString()
    keyed = kept.withColumn("_key", key.cast(nullable))  # of the type of the cuts, so that no comparison casts it again
    keys = (keyed.filter(F.pmod(F.xxhash64("_key"), F.lit(2 ** 30)) < share)
            .agg(F.sort_array(F.collect_list("_key")).alias("cuts")))
    found = keys.select(F.transform("cuts", lambda k: F.to_json(k)).alias("cuts")).first()["cuts"] if n > 1 else []
    cuts = [found[len(found) * i // n] for i in range(1, n)] if len(found) >= n else found
    # a row's bucket is the number of cuts at or before it, by binary search; beyond the last cut a probe is null
    held_cuts = F.from_json(F.lit(f"[{','.join(cuts)}]"), f"array<{nullable}>")  # folded to a literal once
    placed = keyed.withColumn("_bucket", F.lit(0))
    for step in (1 << i for i in reversed(range(len(cuts).bit_length()))):
        probe = F.get(held_cuts, F.col("_bucket") + (step - 1))
        placed = placed.withColumn("_bucket", F.col("_bucket") + F.when(probe <= F.col("_key"), step).otherwise(0))
    placed = placed.drop("_key")
    parts = placed.groupBy("_bucket").agg(*[F.sum(v).alias(k) for k, v in values.items()])
    of_bucket = {r["_bucket"]: r for r in parts.collect()}  # a row a bucket
    offsets, totals = [], {}
    with localcontext(prec=76):
        for k in sums:
            nothing = {T.DecimalType: Decimal(0), T.DoubleType: 0.0}.get(type(parts.schema[k].dataType), 0)
            *before, totals[k] = accumulate((of_bucket[i][k] if i in of_bucket else nothing for i in range(len(cuts) + 1)), initial=nothing)
            offsets.append(before)
    held = spark.createDataFrame([tuple(offsets)], T.StructType([T.StructField(k, T.ArrayType(parts.schema[k].dataType)) for k in sums]))
    w = (Window.partitionBy("_bucket").orderBy(*[F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = []
    for k in sums:
        v = F.sum(values[k]).over(w)
        if cuts:
            v = v + F.get(held.select(k).scalar(), F.col("_bucket"))
        out.append((v if inclusive else v - values[k]).alias(k))
    return placed.select(*df.columns, *out), totals


def ordered_prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column],
                        buckets: int | None = None, inclusive: bool = True) -> DataFrame:
    """Add one column per entry of ``sums``: the total of that expression over every row at or
    before this one (``inclusive``) or strictly before it, in the total order ``order``.

    ``order`` must be a strict total order (end it with a unique key).
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id())
    local_w = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(local_w).alias(f"_run_{k}") for k, c in sums.items()],
                         *[c.alias(f"_val_{k}") for k, c in sums.items()])
    local = cut_lineage(local)
    totals = local.groupBy("_bucket").agg(*[F.sum(f"_val_{k}").alias(f"_tot_{k}") for k in sums])
    # one row per range: a global window over ``n`` rows is cheap
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_tot_{k}").over(before), F.lit(0)).alias(f"_off_{k}")
                                        for k in sums])
    out = local.join(F.broadcast(offsets), "_bucket")
    cols = [F.col(c) for c in df.columns]
    for k in sums:
        v = F.col(f"_run_{k}") + F.col(f"_off_{k}")
        if not inclusive:
            v = v - F.col(f"_val_{k}")
        cols.append(v.alias(k))
    return out.select(*cols)
