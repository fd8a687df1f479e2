"""Dashboard measures over the long table, and the same headline numbers recomputed from the facts.

``scope`` composes Column predicates from the four dashboard parameters (no SQL text is built);
every measure is a ratio of sums taken after the scope filter, so it stays right under any filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from godown.functions.ratios import safe_div
from godown.functions.text import item_label

ALL = "All"


@dataclass(frozen=True)
class Scope:
    warehouse: str = ALL      # dc_city
    period: str = ALL         # fiscal year label
    category: str = ALL
    week: date | None = None  # as-of week for snapshot rows; None is the latest snapshot week


def as_of(snapshots: DataFrame, day: str, s: Scope) -> Column:
    """The scope's week, or the latest ``day`` of the snapshots."""
    return F.lit(s.week) if s.week is not None else snapshots.select(F.max(day)).scalar()


def _common(wb: DataFrame, s: Scope) -> Column:
    cat = F.lit(True) if s.category == ALL else (F.col("category") == s.category)
    fy = F.lit(True) if s.period == ALL else (F.col("fiscal_year") == s.period)
    week = F.col("period_date") == as_of(wb.filter(F.col("record_type") == "Snapshot"), "period_date", s)
    return cat & F.when(F.col("record_type") == "Snapshot", week).otherwise(fy)


def in_scope(wb: DataFrame, s: Scope) -> Column:
    wh = F.lit(True) if s.warehouse == ALL else (F.col("dc_city") == s.warehouse)
    return wh & _common(wb, s)


def in_scope_on_map(wb: DataFrame, s: Scope) -> Column:
    """The map ignores the warehouse parameter and drops supplier rows."""
    return (F.col("record_type") != "Supplier") & _common(wb, s)


def _snap(c: str = "record_type") -> Column:
    return F.when(F.col(c) == "Snapshot", 1).otherwise(0)


def _high() -> Column:
    return F.when(F.col("risk_band") == "High", 1).otherwise(0)


def kpis(wb: DataFrame, s: Scope) -> DataFrame:
    """OTIF, lead time, inventory turnover, carrying cost and average stock (lakh), products at risk."""
    x = wb.filter(in_scope(wb, s))
    products, high = F.sum(_snap()), F.sum(_high())
    return x.agg(
        safe_div(F.sum("otif_lines"), F.sum("lines")).alias("otif"),
        safe_div(F.sum("lead_days_sum"), F.sum("lines")).alias("lead_time_days"),
        F.round(safe_div(F.sum("cogs") * 365, F.sum("stock_value_days")), 9).alias("inventory_turnover"),
        F.round(F.sum("carrying_cost") / 100000, 6).alias("carrying_cost_lakh"),
        F.round(safe_div(F.sum("stock_value_days"), F.sum("days")) / 100000, 6).alias("average_stock_lakh"),
        products.alias("products"), high.alias("high_risk"), safe_div(high, products).alias("high_risk_share"))


SCOPE_SUMS = ("otif_lines", "lines", "lead_days_sum", "cogs", "stock_value_days", "carrying_cost", "days")


def kpis_every_scope(wb: DataFrame, week: date | None = None) -> DataFrame:
    """``kpis`` of every scope in one pass: a row a (warehouse, period, category) of which each may be "All".

    Every combination has a row that holds any row of the long table; snapshots are those of ``week`` (or the latest) and
    belong to every period. The long table is summed once to its (warehouse, year, category) cells, a bounded table, and
    only that is rolled up; a row without a warehouse, year or category counts only under "All" of it.
    """
    snap = F.col("record_type") == "Snapshot"
    in_week = F.col("period_date") == as_of(wb.filter(snap), "period_date", Scope(week=week))
    # stock values have two places: summed exactly, so that no order of rows decides a tie of rounding
    sums = [F.sum(F.col(c).cast("decimal(20,2)") if c == "stock_value_days" else c).alias(c) for c in SCOPE_SUMS]
    cells = (wb.filter(~snap | in_week)
             .groupBy("dc_city", F.when(~snap, F.col("fiscal_year")).alias("fiscal_year"), "category", snap.alias("snap"))
             .agg(*sums, F.sum(_snap()).alias("products"), F.sum(_high()).alias("high_risk")))
    scope = {"warehouse": "dc_city", "period": "fiscal_year", "category": "category"}
    totals = [*SCOPE_SUMS, "products", "high_risk"]

    def rolled(df: DataFrame, keys: dict[str, str]) -> DataFrame:
        # a null that stands for all rows is "All"; a null of the data names no scope
        named = [F.when(F.grouping(c) == 1, F.lit(ALL)).otherwise(F.col(c)).alias(f"_{k}") for k, c in keys.items()]
        r = df.cube(*keys.values()).agg(*named, *[F.sum(c).alias(f"_{c}") for c in totals])
        return r.select(*[F.col(f"_{k}").alias(k) for k in keys], *[F.col(f"_{c}").alias(c) for c in totals]).dropna(subset=list(keys))

    facts = rolled(cells.filter(~F.col("snap")), scope)
    # the calendar's years, so one bounded array
    periods = wb.filter(~snap).select(F.array_union(F.array(F.lit(ALL)), F.collect_set("fiscal_year"))).scalar()
    held = (rolled(cells.filter("snap"), {k: c for k, c in scope.items() if k != "period"})
            .withColumn("_periods", periods).withColumn("period", F.explode("_periods")).drop("_periods"))
    x = (facts.unionByName(held).groupBy(*scope).agg(*[F.sum(c).alias(c) for c in totals])
         .withColumn("stock_value_days", F.col("stock_value_days").cast("double")))
    return x.select(
        *scope, safe_div(F.col("otif_lines"), F.col("lines")).alias("otif"),
        safe_div(F.col("lead_days_sum"), F.col("lines")).alias("lead_time_days"),
        F.round(safe_div(F.col("cogs") * 365, F.col("stock_value_days")), 9).alias("inventory_turnover"),
        F.round(F.col("carrying_cost") / 100000, 6).alias("carrying_cost_lakh"),
        F.round(safe_div(F.col("stock_value_days"), F.col("days")) / 100000, 9).alias("average_stock_lakh"),
        "products", "high_risk", safe_div(F.col("high_risk"), F.col("products")).alias("high_risk_share"))


def kpis_from_facts(b, s: Scope, scores: DataFrame) -> DataFrame:
    """The headline numbers from facts and dimensions directly (a separate code path from ``kpis``)."""
    dc = F.broadcast(b.dim_dc.select("dc_id", "dc_city"))
    days = F.broadcast(b.dim_date.select("date", "fiscal_year"))

    def keep(df: DataFrame, by_period: bool = True) -> DataFrame:
        if s.warehouse != ALL:
            df = df.filter(F.col("dc_city") == s.warehouse)
        if s.category != ALL:
            df = df.filter(F.col("category") == s.category)
        if by_period and s.period != ALL:
            df = df.filter(F.col("fiscal_year") == s.period)
        return df

    lines = keep(b.fact_order_lines.join(dc, "dc_id").join(days.withColumnRenamed("date", "order_date"), "order_date"))
    stock = keep(b.fact_inventory_daily.join(dc, "dc_id").join(days, "date")) \
        .select(F.struct(F.sum("stock_value").cast("double").alias("v"), F.sum("carrying_cost").alias("c"))).scalar()
    cogs = keep(b.fact_order_lines.join(dc, "dc_id").join(days.withColumnRenamed("date", "ship_date"), "ship_date")) \
        .select(F.sum("cogs").cast("double")).scalar()
    items = b.dim_item.select("item_id", "category")
    sc = scores.filter(F.col("snapshot_date") == as_of(scores, "snapshot_date", s))
    sc = keep(sc.join(dc, "dc_id").join(items, "item_id"), by_period=False)
    risk = sc.select(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("risk_band") == "High").alias("h"))).scalar()
    lane_row = lines.select(F.struct(F.avg(F.col("otif").cast("int")).alias("otif"), F.sum("lead_days").alias("ld"),
                                     F.count(F.lit(1)).alias("n"))).scalar()
    return b.spark.range(1).select(
        lane_row["otif"].alias("otif"), (lane_row["ld"] / lane_row["n"]).alias("lead_time_days"),
        F.round(cogs * 365 / stock["v"], 9).alias("inventory_turnover"),
        F.round(stock["c"] / 100000, 6).alias("carrying_cost_lakh"),
        risk["n"].alias("products"), risk["h"].alias("high_risk"))


def otif_band(otif: Column) -> Column:
    return F.when(otif < 0.7, "Under 70%").when(otif < 0.85, "70 to 85%").otherwise("85% or more")


def lane_otif_band(wb: DataFrame, s: Scope) -> DataFrame:
    """One value per lane across both map points (the point order is excluded from the grain)."""
    lanes = wb.filter(in_scope_on_map(wb, s) & (F.col("record_type") == "Lane"))
    otif = safe_div(F.sum("otif_lines"), F.sum("lines"))
    return (lanes.groupBy("lane_id")
            .agg(F.max("city").alias("lane_city"), otif.alias("lane_otif"),
                 safe_div(F.sum("lead_days_sum"), F.sum("lines")).alias("lane_lead_time"),
                 F.sum("lines").alias("lane_lines"))
            .withColumn("otif_band", otif_band(F.col("lane_otif"))))


def risk_gauge(wb: DataFrame, s: Scope) -> DataFrame:
    """Products at Watch and High risk per warehouse, for the as-of week."""
    x = wb.filter(in_scope(wb, s) & (F.col("record_type") == "Snapshot"))
    return x.groupBy("dc_city").agg(F.count_if(F.col("risk_band") == "Watch").alias("watch"),
                                    F.count_if(F.col("risk_band") == "High").alias("high"),
                                    F.count(F.lit(1)).alias("products"))


def map_points(wb: DataFrame, s: Scope) -> DataFrame:
    """One circle per map point: size, high-risk share band and the tooltip note."""
    x = wb.filter(in_scope_on_map(wb, s))
    g = x.groupBy("map_point").agg(F.sum(_snap()).alias("products"), F.sum(_high()).alias("high_risk"),
                                   F.min("dc_city").alias("served_by"))
    share = safe_div(F.col("high_risk"), F.col("products"))
    return g.select(
        "map_point", "products", "high_risk",
        F.when(F.col("products") == 0, "Delivery city").when(share >= 0.05, "5% or more at high risk")
        .when(share >= 0.02, "2 to 5%").otherwise("Under 2%").alias("risk_band"),
        F.when(F.col("products") > 0, 4).otherwise(1).alias("point_size"),
        F.when(F.col("products") > 0,
               F.concat(F.col("high_risk").cast("string"), F.lit(" of "), F.col("products").cast("string"),
                        F.lit(" products at high stockout risk this week")))
        .otherwise(F.concat(F.lit("Delivery city, served by "), F.col("served_by"))).alias("note"))


def watch_list(wb: DataFrame, s: Scope) -> DataFrame:
    """High-risk products at warehouses, highest score first."""
    x = wb.filter(in_scope(wb, s) & (F.col("record_type") == "Snapshot") & (F.col("risk_band") == "High"))
    return (x.select(item_label(F.col("sku"), F.col("dc_city")).alias("item"), "sku", "dc_id", "dc_city",
                     "risk_score", "cover_days", "reasons")
            .orderBy(F.desc("risk_score"), "dc_id", "sku"))


def supplier_scorecard(wb: DataFrame, s: Scope) -> DataFrame:
    """On time, days late against the quote, defects and in-full rate per supplier, least on time first."""
    x = wb.filter(in_scope(wb, s) & (F.col("record_type") == "Supplier"))
    return (x.groupBy("supplier_id", "supplier")
            .agg(safe_div(F.sum("pos_on_time"), F.sum("pos")).alias("on_time"),
                 safe_div(F.sum("po_lead_days_sum") - F.sum("po_quoted_days_sum"), F.sum("pos")).alias("days_late"),
                 safe_div(F.sum("units_rejected"), F.sum("units_received")).alias("defects"),
                 safe_div(F.sum("pos_in_full"), F.sum("pos")).alias("in_full"), F.sum("pos").alias("pos"))
            .orderBy("on_time", "supplier"))


def filter_domains(wb: DataFrame) -> DataFrame:
    """Parameter values: 'All' plus the distinct values, and the snapshot weeks for the week picker."""
    spark = wb.sparkSession
    parts = []
    for name, col in (("Warehouse", "dc_city"), ("Period", "fiscal_year"), ("Category", "category")):
        vals = wb.filter(F.col(col).isNotNull()).select(F.lit(name).alias("parameter"), F.col(col).alias("value")).distinct()
        parts.append(spark.range(1).select(F.lit(name).alias("parameter"), F.lit(ALL).alias("value")).unionByName(vals))
    parts.append(wb.filter(F.col("record_type") == "Snapshot")
                 .select(F.lit("As-of week").alias("parameter"), F.date_format("period_date", "yyyy-MM-dd").alias("value"))
                 .distinct())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
