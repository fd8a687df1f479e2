"""Planning formulas on tables: road distance, nearest centre, quoted lead time, reorder point,
seasonal lift, festive pre-build and order-up-to suggestions.

The warehouse master and the festival list are short, bounded lists; they travel as one array
value (a scalar subquery or a literal), so no join pairs every row with every centre.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from godown.config import (DEFAULT, ORDER_UP_TO_DAYS, PREBUILD_AHEAD_DAYS, QUOTE_BASE_DAYS, QUOTE_KM_PER_DAY,
                           TRANSIT_KM_PER_DAY, Calendar)
from godown.functions.geo import road_km

SERIES = ["dc_id", "item_id"]


def centres_array(dcs: DataFrame) -> Column:
    """All centres as one array<struct<dc_id, lat, lon>> (the master list is small by construction)."""
    return dcs.select(F.collect_list(F.struct("dc_id", "lat", "lon"))).scalar()


def nearest_centre(points: DataFrame, dcs: DataFrame, key: str) -> DataFrame:
    """Nearest centre by road distance for each point (ties to the smaller centre id), and the
    standard transit max(1, ceil(whole km / 450)) days."""
    # the array is projected first: a subquery cannot sit inside a lambda
    dist = F.transform(F.col("_centres"), lambda c: F.struct(
        road_km(F.col("lat"), F.col("lon"), c["lat"], c["lon"]).alias("km"), c["dc_id"].alias("dc_id")))
    best = F.array_min(dist)
    return points.withColumn("_centres", centres_array(dcs)).select(
        key, best["dc_id"].alias("nearest_dc"), best["km"].alias("road_km"),
                         F.greatest(F.lit(1), F.ceil(F.round(best["km"]) / TRANSIT_KM_PER_DAY)).cast("int").alias("std_transit_days"))


def quoted_lead_time(suppliers: DataFrame, dcs: DataFrame) -> DataFrame:
    """5 + floor(whole km to the farthest centre / 600) days."""
    dist = F.transform(F.col("_centres"), lambda c: road_km(F.col("lat"), F.col("lon"), c["lat"], c["lon"]))
    far = F.array_max(dist)
    return suppliers.withColumn("_centres", centres_array(dcs)).select("supplier_id", far.alias("max_km"),
                            (F.lit(QUOTE_BASE_DAYS) + F.floor(F.round(far) / QUOTE_KM_PER_DAY)).cast("int").alias("quoted_lead_days"))


def reorder_point(stock: DataFrame, items: DataFrame, suppliers: DataFrame, safety: float = 1.0) -> DataFrame:
    """avg28 x lead + safety x sd28 x sqrt(lead) per series and day, lead = the item supplier's quote.

    Uses the same (dc, item) partitioning and date order as the ledger windows."""
    lead = items.select("item_id", "supplier_id").join(suppliers.select("supplier_id", "quoted_lead_days"), "supplier_id")
    if "demand_28d" in stock.columns:  # the ledger already carries the trailing 28-row moments
        x = stock.select("date", *SERIES, F.col("demand_28d").alias("avg28"), F.col("demand_sd_28d").alias("sd28"))
    else:
        w28 = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(-27, 0)
        x = stock.select("date", *SERIES, F.avg("demand").over(w28).alias("avg28"),
                         F.stddev_pop("demand").over(w28).alias("sd28"))
    ld = F.col("quoted_lead_days").cast("double")
    return (x.join(F.broadcast(lead.select("item_id", "quoted_lead_days")), "item_id")
            .select("date", *SERIES, "avg28", "sd28", "quoted_lead_days",
                    (F.col("avg28") * ld + F.lit(safety) * F.col("sd28") * F.sqrt(ld)).alias("reorder_point")))


def festive_factor(d: Column, lift: float, cal: Calendar = DEFAULT) -> Column:
    """Demand lift on day ``d``: ramp over the 24 days before a festival, ease-off over the 7 after."""
    fests = F.array(*[F.lit(x) for x in cal.festival_days])

    def one(f):
        delta = F.datediff(f, d)
        ramp = F.lit(1.0) + F.lit(lift - 1.0) * (F.lit(1.0) - delta / F.lit(30.0))
        ease = F.lit(1.0) + F.lit(lift - 1.0) * F.lit(0.4) * (F.lit(1.0) + delta / F.lit(7.0))
        return F.when((delta >= 0) & (delta <= 24), ramp).when((delta >= -7) & (delta < 0), ease).otherwise(F.lit(1.0))

    return F.aggregate(F.transform(fests, one), F.lit(1.0), lambda acc, v: F.greatest(acc, v))


def summer_factor(d: Column, lift: float) -> Column:
    return F.when(F.month(d).isin(4, 5, 6), F.lit(lift)).otherwise(F.lit(1.0))


def season_factors(dates: DataFrame, festive_lift: float = 1.6, summer_lift: float = 1.3,
                   cal: Calendar = DEFAULT) -> DataFrame:
    return dates.select("date", festive_factor(F.col("date"), festive_lift, cal).alias("festive_factor"),
                        summer_factor(F.col("date"), summer_lift).alias("summer_factor"))


def prebuild_factor(d: Column, lift: float, cal: Calendar = DEFAULT) -> Column:
    """Largest festive lift over the look-ahead days 0, 3, ..., 21 from ``d``."""
    return F.greatest(*[festive_factor(F.date_add(d, i), lift, cal) for i in PREBUILD_AHEAD_DAYS])


def festive_days(lifts: DataFrame, cal: Calendar = DEFAULT) -> DataFrame:
    """``category``, ``date`` and ``factor`` of the days on which a category's demand is lifted; every other day has 1.

    ``lifts`` has a row a category (``category``, ``festive_lift``; null: none). Each is spread over the days around every
    festival, so the relation has at most 32 rows a category and festival; the largest lift of a day counts.
    """
    gain = F.coalesce(F.col("festive_lift"), F.lit(1.0)) - F.lit(1.0)
    away = F.explode(F.sequence(F.lit(-7), F.lit(24))).alias("away")
    per = (lifts.select("category", gain.alias("gain"), F.explode(F.array(*[F.lit(x) for x in cal.festival_days])).alias("festival"))
           .select("category", "gain", "festival", away))
    share = F.when(F.col("away") >= 0, F.lit(1.0) - F.col("away") / F.lit(30.0)).otherwise(F.lit(0.4) * (F.lit(1.0) + F.col("away") / F.lit(7.0)))
    return (per.select("category", F.date_sub("festival", F.col("away")).alias("date"), (F.lit(1.0) + F.col("gain") * share).alias("factor"))
            .groupBy("category", "date").agg(F.max("factor").alias("factor")).filter(F.col("factor") > 1.0))


def prebuild_days(festive: DataFrame) -> DataFrame:
    """``category``, ``date`` and ``factor``: the largest of ``festive_days`` over the look-ahead days 0, 3, ..., 21."""
    step = F.explode(F.array(*[F.lit(i) for i in PREBUILD_AHEAD_DAYS])).alias("step")
    return (festive.select("category", "date", "factor", step)
            .groupBy("category", F.date_sub("date", F.col("step")).alias("date")).agg(F.max("factor").alias("factor")))


def season_factors_by_category(lifts: DataFrame, cal: Calendar = DEFAULT) -> DataFrame:
    """``category``, ``date``, ``festive_factor`` and ``summer_factor`` for every day of the calendar.

    ``lifts`` has a row a category with ``festive_lift`` and ``summer_lift`` (null: none)."""
    days = F.explode(F.sequence(F.lit(cal.start), F.lit(cal.end))).alias("date")
    lift = F.coalesce(F.col("summer_lift"), F.lit(1.0))
    return (lifts.select("category", lift.alias("summer_lift"), days).join(festive_days(lifts, cal), ["category", "date"], "left")
            .select("category", "date", F.coalesce("factor", F.lit(1.0)).alias("festive_factor"),
                    F.when(F.month("date").isin(4, 5, 6), F.col("summer_lift")).otherwise(F.lit(1.0)).alias("summer_factor")))


def prebuilt(df: DataFrame, factors: DataFrame, policy_from=None) -> DataFrame:
    """``df`` (``category``, ``snapshot_date``) with ``prebuild_factor``: that of ``factors`` (``prebuild_days``) from the
    policy's first day on, else 1. A null or unlisted category has 1. Only the sparse relation joins, on both keys."""
    f = factors.select("category", F.col("date").alias("snapshot_date"), F.col("factor").alias("_factor"))
    factor = F.coalesce(F.col("_factor"), F.lit(1.0))
    if policy_from is not None:
        factor = F.when(F.col("snapshot_date") >= F.lit(policy_from), factor).otherwise(F.lit(1.0))
    return df.join(f, ["category", "snapshot_date"], "left").select(*df.columns, factor.alias("prebuild_factor"))


def replenishment(snapshots: DataFrame, rop: DataFrame, items: DataFrame, festive_lift: float = 1.6,
                  policy_from=None, cal: Calendar = DEFAULT, factors: DataFrame | None = None) -> DataFrame:
    """Order-up-to suggestions at snapshots: when stock plus open orders is at or below the
    (pre-built) reorder point, order up to reorder point + 30 days of demand, in whole cases.

    The reorder point is lifted from ``policy_from`` on by each category's own ``factors`` (``prebuild_days``), or without
    them by one ``festive_lift``."""
    k = ["snapshot_date", "dc_id", "item_id"]
    r = rop.select(F.col("date").alias("snapshot_date"), "dc_id", "item_id", "reorder_point", "avg28")
    s = snapshots.select(*k, "on_hand", "open_po_units").join(r, k) \
        .join(items.select("item_id", "case_qty", "category"), "item_id")
    if factors is not None:
        s = prebuilt(s, factors, policy_from)
        factor = F.col("prebuild_factor")
    else:
        factor = prebuild_factor(F.col("snapshot_date"), festive_lift, cal)
        if policy_from is not None:
            factor = F.when(F.col("snapshot_date") >= F.lit(policy_from), factor).otherwise(F.lit(1.0))
    rp = F.round(F.col("reorder_point") * factor, 6)
    position = F.col("on_hand") + F.col("open_po_units")
    target = rp + F.lit(float(ORDER_UP_TO_DAYS)) * F.col("avg28")
    qty = F.ceil(F.greatest(target - position, F.lit(0.0)) / F.col("case_qty")) * F.col("case_qty")
    return (s.select(*k, position.alias("position"), rp.alias("reorder_point"), F.round(target, 6).alias("order_up_to"),
                     F.when(position <= rp, qty).otherwise(F.lit(0)).cast("long").alias("order_qty"))
            .filter(F.col("order_qty") > 0))
