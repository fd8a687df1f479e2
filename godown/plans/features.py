"""Point-in-time features and the censored stockout label, one snapshot per series every Monday.

All per-series work (rolling demand, the forward label window, open purchase orders) runs on the
dense daily stock frame in one hash partitioning on (dc_id, item_id) with one sort by date; the
Monday filter sits above the windows, so it never changes what a window sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.config import (COVER_CAP, DEFAULT, FESTIVAL_CAP, HORIZON_DAYS, PIPELINE_COVER_CAP, STOCK_TO_ROP_CAP,
                           SUPPLIER_LEAD_SD_DEFAULT, SUPPLIER_ON_TIME_DEFAULT, TRAILING_DAYS, Calendar)
from godown.functions.dates import is_monday
from godown.functions.ratios import capped_ratio, safe_div
from godown.operators.intervals import next_on_or_after, trailing_stats

SERIES = ["dc_id", "item_id"]


def rolling_columns(horizon: int = HORIZON_DAYS) -> list:
    """Trailing 28- and 7-row demand mean, 28-row population sd, and whether the series is out of
    stock on any of the next ``horizon`` days (rows, so the series must be dense: one row a day)."""
    w = Window.partitionBy(*SERIES).orderBy("date")
    w28, w7, ahead = w.rowsBetween(-27, 0), w.rowsBetween(-6, 0), w.rowsBetween(1, horizon)
    oos = F.col("on_hand") <= 0
    return [F.avg("demand").over(w28).alias("demand_28d"),
            F.avg("demand").over(w7).alias("demand_7d"),
            F.stddev_pop("demand").over(w28).alias("demand_sd_28d"),
            F.bool_or(oos).over(ahead).alias("out_next_14d")]


ROLLING = ("demand_28d", "demand_7d", "demand_sd_28d", "out_next_14d")


def rolling_demand(stock: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """The dense daily stock with the rolling columns (already there when the ledger made them)."""
    if all(c in stock.columns for c in ROLLING) and horizon == HORIZON_DAYS:
        return stock
    return stock.drop(*[c for c in ROLLING if c in stock.columns]).select("*", *rolling_columns(horizon))


def weekly_snapshots(stock: DataFrame, cal: Calendar = DEFAULT) -> DataFrame:
    """Monday rows (from ``cal.snapshot_from``) with rolling demand and the forward outcome."""
    return (rolling_demand(stock)
            .filter(is_monday(F.col("date")) & (F.col("date") >= F.lit(cal.snapshot_from))))


def supplier_daily(pos: DataFrame) -> DataFrame:
    """Received purchase orders per supplier and last-receipt day, in exact integer moments."""
    lead = F.col("lead_days").cast("long")
    return (pos.filter(F.col("last_received").isNotNull())
            .groupBy("supplier_id", F.col("last_received").alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("on_time").cast("long")).alias("n_on_time"),
                 F.sum(lead).alias("sx"), F.sum(lead * lead).alias("sxx")))


def supplier_trailing(pos: DataFrame, wanted: DataFrame, days: int = TRAILING_DAYS) -> DataFrame:
    """On-time rate and population sd of lead days over POs last received in (d - days, d], for every
    (date, supplier_id) row of ``wanted``; defaults 0.8 and 2 when there is none.

    Daily moments per supplier plus zero rows on the wanted days, then a range window over the day
    number: linear in the data, no snapshot x PO pairs.
    """
    zero = F.lit(0).cast("long")
    keys = wanted.select("date", "supplier_id").distinct()
    daily = (supplier_daily(pos)
             .unionByName(keys.select("supplier_id", "date", zero.alias("n"), zero.alias("n_on_time"),
                                      zero.alias("sx"), zero.alias("sxx")))
             .groupBy("supplier_id", "date").agg(*[F.sum(c).alias(c) for c in ["n", "n_on_time", "sx", "sxx"]]))
    t = trailing_stats(daily, ["supplier_id"], "date", days, ["n", "n_on_time", "sx", "sxx"])
    n, on, sx, sxx = (F.col(f"{c}_trailing") for c in ["n", "n_on_time", "sx", "sxx"])
    var_num = (n * sxx - sx * sx).cast("double")
    sd = F.when(n > 0, F.sqrt(F.greatest(var_num, F.lit(0.0))) / n)
    return (t.join(keys, ["supplier_id", "date"])
            .select("date", "supplier_id",
                    F.coalesce(safe_div(on, n), F.lit(SUPPLIER_ON_TIME_DEFAULT)).alias("supplier_on_time_180d"),
                    F.coalesce(sd, F.lit(float(SUPPLIER_LEAD_SD_DEFAULT))).alias("supplier_lead_sd_180d"),
                    n.alias("supplier_pos_180d")))


def days_to_festival(dates: DataFrame, festivals: DataFrame, cap: int = FESTIVAL_CAP) -> DataFrame:
    """Days from each date to the next festival, capped; after the last listed festival, the cap."""
    nxt = next_on_or_after(dates, "date", festivals, "day")
    return nxt.select("date", "next_event",
                      F.least(F.datediff("next_event", "date"), F.lit(cap)).alias("days_to_festival"))


def state_features() -> list:
    """The features that follow from the state alone: a run of snapshots with one state has them once."""
    d28 = F.col("demand_28d")
    return [(F.col("on_hand") <= F.col("reorder_point")).alias("below_reorder_point"),
            capped_ratio(F.col("on_hand"), d28, COVER_CAP).alias("cover_days"),
            capped_ratio(F.col("on_hand") + F.col("open_po_units"), d28, PIPELINE_COVER_CAP).alias("pipeline_cover_days"),
            capped_ratio(F.col("on_hand"), F.col("reorder_point"), STOCK_TO_ROP_CAP).alias("stock_to_reorder_point"),
            safe_div(F.col("demand_7d"), d28).alias("demand_trend"), safe_div(F.col("demand_sd_28d"), d28).alias("demand_cv")]


def stockout_snapshots(stock: DataFrame, items: DataFrame, pos: DataFrame, festivals: DataFrame,
                       cal: Calendar = DEFAULT, horizon: int = HORIZON_DAYS) -> DataFrame:
    """One row per Monday x centre x item: state, 8 numeric features, and the censored label."""
    snap = weekly_snapshots(stock, cal)
    snap = snap.join(items.select("item_id", "category", "abc_class", "supplier_id"), "item_id")
    sup = supplier_trailing(pos, snap.select("date", "supplier_id"))
    fest = days_to_festival(snap.select("date"), festivals)
    known = F.date_add(F.col("date"), horizon) <= F.lit(cal.end)
    return (snap.join(sup, ["date", "supplier_id"])
            .join(F.broadcast(fest), "date")
            .select(F.col("date").alias("snapshot_date"), "dc_id", "item_id", "category", "abc_class", "supplier_id",
                    "on_hand", "reorder_point", *state_features(),
                    "supplier_on_time_180d", "supplier_lead_sd_180d",
                    F.col("days_to_festival").cast("double").alias("days_to_festival"),
                    known.alias("outcome_known"),
                    F.when(known, F.col("out_next_14d").cast("int")).alias("stockout_14d"),
                    "open_po_units", "demand_28d", "demand_7d", "demand_sd_28d"))
