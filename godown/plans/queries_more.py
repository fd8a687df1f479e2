"""Registered queries, part 2: published analyses (service, lanes, suppliers, stock)."""

from __future__ import annotations

from pyspark.sql import functions as F

from godown.functions.ratios import safe_div
from godown.plans.registry import query


@query("otif_by_centre", """
SELECT CAST(l.dc_id AS BIGINT) AS dc_id, w.dc_city, count(*) AS lines,
       avg(CAST(l.otif AS INTEGER)) AS otif, avg(CAST(l.on_time AS INTEGER)) AS on_time,
       avg(CAST(l.in_full AS INTEGER)) AS in_full, avg(l.lead_days) AS lead_days
FROM fact_order_lines l JOIN dim_dc w USING (dc_id) GROUP BY ALL""")
def otif_by_centre(b):
    """Flagship: line OTIF, on time, in full and order-to-delivery days per centre."""
    return (b.fact_order_lines.join(F.broadcast(b.dim_dc.select("dc_id", "dc_city")), "dc_id")
            .groupBy("dc_id", "dc_city")
            .agg(F.count(F.lit(1)).alias("lines"), F.avg(F.col("otif").cast("int")).alias("otif"),
                 F.avg(F.col("on_time").cast("int")).alias("on_time"),
                 F.avg(F.col("in_full").cast("int")).alias("in_full"), F.avg("lead_days").alias("lead_days")))


@query("otif_by_centre_month", """
SELECT CAST(dc_id AS BIGINT) AS dc_id, CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR) AS month,
       count(*) AS lines, avg(CAST(otif AS INTEGER)) AS otif, avg(CAST(on_time AS INTEGER)) AS on_time
FROM fact_order_lines GROUP BY ALL""")
def otif_by_centre_month(b):
    return (b.fact_order_lines.groupBy("dc_id", F.trunc("order_date", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("lines"), F.avg(F.col("otif").cast("int")).alias("otif"),
                 F.avg(F.col("on_time").cast("int")).alias("on_time")))


@query("lane_promise_gap", """
SELECT CAST(l.dc_id AS BIGINT) AS dc_id, CAST(l.zone_id AS BIGINT) AS zone_id, z.city, z.road_km,
       CAST(z.std_transit_days AS BIGINT) AS std_transit_days,
       avg(date_diff('day', l.order_date, l.promised_date)) AS promised_days,
       avg(date_diff('day', l.ship_date, l.delivered_date)) AS delivery_days,
       avg(CAST(l.on_time AS INTEGER)) AS on_time, count(*) AS lines
FROM fact_order_lines l JOIN dim_zone z USING (zone_id) GROUP BY ALL""")
def lane_promise_gap(b):
    z = F.broadcast(b.dim_zone.select("zone_id", "city", "road_km", "std_transit_days"))
    return (b.fact_order_lines.join(z, "zone_id")
            .groupBy("dc_id", "zone_id", "city", "road_km", "std_transit_days")
            .agg(F.avg(F.datediff("promised_date", "order_date")).alias("promised_days"),
                 F.avg(F.datediff("delivered_date", "ship_date")).alias("delivery_days"),
                 F.avg(F.col("on_time").cast("int")).alias("on_time"), F.count(F.lit(1)).alias("lines")))


SHIFT_DATE = "1998-07-01"


@query("supplier_shift", f"""
SELECT po.supplier_id, s.supplier,
       avg(CAST(po.on_time AS INTEGER)) FILTER (WHERE po.last_received < DATE '{SHIFT_DATE}') AS on_time_before,
       avg(CAST(po.on_time AS INTEGER)) FILTER (WHERE po.last_received >= DATE '{SHIFT_DATE}') AS on_time_after,
       CAST(sum(po.qty_rejected) AS DOUBLE) / nullif(CAST(sum(po.qty_received) AS DOUBLE), 0) AS defect_rate,
       count(*) AS pos
FROM fact_purchase_orders po JOIN dim_supplier s USING (supplier_id)
WHERE po.last_received IS NOT NULL GROUP BY ALL""")
def supplier_shift(b, shift: str = SHIFT_DATE):
    """On-time rate of received POs before and after a date, and the defect rate, per supplier."""
    before = F.col("last_received") < F.lit(shift).cast("date")
    on = F.col("on_time").cast("int")
    return (b.fact_purchase_orders.filter(F.col("last_received").isNotNull())
            .join(b.dim_supplier.select("supplier_id", "supplier"), "supplier_id")
            .groupBy("supplier_id", "supplier")
            .agg(F.avg(F.when(before, on)).alias("on_time_before"), F.avg(F.when(~before, on)).alias("on_time_after"),
                 safe_div(F.sum("qty_rejected"), F.sum("qty_received")).alias("defect_rate"),
                 F.count(F.lit(1)).alias("pos")))


@query("stockout_days_by_season", """
SELECT i.category, d.fiscal_year, month(i.date) IN (10, 11) AS festive_months,
       avg(CAST(i.out_of_stock AS INTEGER)) AS out_of_stock_share, count(*) AS stock_days
FROM fact_inventory_daily i JOIN dim_date d USING (date) GROUP BY ALL""")
def stockout_days_by_season(b, months: tuple[int, ...] = (10, 11)):
    """Share of out-of-stock series-days by category, fiscal year, and whether in the chosen months."""
    d = F.broadcast(b.dim_date.select("date", "fiscal_year"))
    return (b.fact_inventory_daily.join(d, "date")
            .groupBy("category", "fiscal_year", F.month("date").isin(*months).alias("festive_months"))
            .agg(F.avg(F.col("out_of_stock").cast("int")).alias("out_of_stock_share"),
                 F.count(F.lit(1)).alias("stock_days")))


@query("stock_value_by_period", """
SELECT d.fiscal_year, CAST(sum(i.stock_value) AS DOUBLE) / count(DISTINCT i.date) AS avg_stock_value,
       CAST(sum(i.stock_value) AS DOUBLE) * 0.24 / 365 AS carrying_cost, count(DISTINCT i.date) AS days
FROM fact_inventory_daily i JOIN dim_date d USING (date) GROUP BY ALL""")
def stock_value_by_period(b):
    """Average daily stock value and carrying cost per fiscal year (ratio of exact sums)."""
    d = F.broadcast(b.dim_date.select("date", "fiscal_year"))
    total = F.sum("stock_value").cast("double")
    return (b.fact_inventory_daily.join(d, "date").groupBy("fiscal_year")
            .agg((total / F.count_distinct("date")).alias("avg_stock_value"),
                 (total * 0.24 / 365).alias("carrying_cost"), F.count_distinct("date").alias("days")))


@query("dispatch_wait", """
SELECT CAST(dc_id AS BIGINT) AS dc_id, avg(date_diff('day', order_date, ship_date)) AS dispatch_wait_days,
       count(*) AS orders
FROM fact_orders GROUP BY ALL""")
def dispatch_wait(b):
    return (b.fact_orders.groupBy("dc_id")
            .agg(F.avg(F.datediff("ship_date", "order_date")).alias("dispatch_wait_days"),
                 F.count(F.lit(1)).alias("orders")))


@query("order_vs_line_otif", """
SELECT CAST(dc_id AS BIGINT) AS dc_id,
       avg(CAST(on_time AND in_full AS INTEGER)) AS order_otif,
       CAST(sum(otif_lines) AS DOUBLE) / sum(lines) AS line_otif, count(*) AS orders
FROM fact_orders GROUP BY ALL""")
def order_vs_line_otif(b):
    """Whole-order OTIF (every line on time and in full) against per-line OTIF, per centre."""
    return (b.fact_orders.groupBy("dc_id")
            .agg(F.avg((F.col("on_time") & F.col("in_full")).cast("int")).alias("order_otif"),
                 (F.sum("otif_lines").cast("double") / F.sum("lines")).alias("line_otif"),
                 F.count(F.lit(1)).alias("orders")))
