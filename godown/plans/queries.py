"""Registered queries, part 1: staging, dimensions, facts, ledger, features, marts.

Each function takes a ``Pipeline`` (lazy build over the driver tables) and returns a DataFrame; the
SQL string is the independent oracle's final SELECT (after the shared prelude).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from godown.config import CARRY_RATE
from godown.plans.oracle import WALK
from godown.plans.registry import query


def _d(c: str, alias: str | None = None) -> str:
    """A date column leaving the oracle as ISO text (as the Spark side does)."""
    return f"CAST({c} AS VARCHAR) AS {alias or c.split('.')[-1]}"


# ------------------------------------------------------------------------------------------ staging
@query("staging_typed", f"""
SELECT o.order_id, CAST(o.zone_id AS BIGINT) AS zone_id, CAST(o.dc_id AS BIGINT) AS dc_id, {_d('o.order_date')},
       {_d('o.promised_date')}, {_d('s.ship_date')}, {_d('s.delivered_date')}, s.carrier
FROM stg_sales_orders o JOIN stg_shipments s USING (order_id)""")
def staging_typed(b):
    return b.stg_sales_orders.join(b.stg_shipments, "order_id")


@query("staging_day_first_dates", f"""
SELECT po_id, supplier_id, CAST(dc_id AS BIGINT) AS dc_id, sku, {_d('order_date')}, {_d('promised_date')},
       CAST(qty_ordered AS BIGINT) AS qty_ordered
FROM stg_purchase_orders""")
def staging_day_first_dates(b):
    return b.stg_purchase_orders


@query("supplier_name_clean", """
SELECT supplier_id, supplier, category, hub, state, lat, lon, CAST(quoted_lead_days AS BIGINT) AS quoted_lead_days
FROM dim_supplier""")
def supplier_name_clean(b):
    return b.dim_supplier


@query("date_dimension", f"""
SELECT {_d('date')}, {_d('week_start')}, {_d('month')}, fiscal_year FROM dim_date""")
def date_dimension(b):
    return b.dim_date


@query("next_event_days", f"""
SELECT {_d('d', 'snapshot_date')}, {_d('f.day', 'next_festival')},
       CAST(least(60, coalesce(f.day - d, 60)) AS BIGINT) AS days_to_festival
FROM (SELECT dim_date.date AS d FROM dim_date, cal WHERE week_start = dim_date.date AND dim_date.date >= first_day + INTERVAL 1 MONTH) m
ASOF LEFT JOIN festival f ON m.d <= f.day""")
def next_event_days(b):
    from godown.plans.features import days_to_festival
    mondays = b.dim_date.filter((F.weekday("date") == 0) & (F.col("date") >= F.lit(b.cal.snapshot_from)))
    return (days_to_festival(mondays.select("date"), b.festival_days)
            .select(F.col("date").alias("snapshot_date"), F.col("next_event").alias("next_festival"),
                    "days_to_festival"))


# ------------------------------------------------------------------------------------------ model
@query("abc_classification", """
SELECT sku, category, item_id, supplier_id, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(case_qty AS BIGINT) AS case_qty,
       abc_class
FROM dim_product""")
def abc_classification(b):
    return b.dim_product.select("sku", "category", "item_id", "supplier_id", "unit_cost", "case_qty", "abc_class")


@query("item_classification", """
SELECT item_id, category, supplier_id, CAST(case_qty AS BIGINT) AS case_qty, CAST(unit_cost AS DOUBLE) AS unit_cost,
       abc_class FROM dim_item""")
def item_classification(b):
    return b.dim_item


@query("order_line_service", f"""
SELECT order_id, CAST(dc_id AS BIGINT) AS dc_id, CAST(zone_id AS BIGINT) AS zone_id, sku, item_id, category,
       {_d('order_date')}, {_d('promised_date')}, {_d('ship_date')}, {_d('delivered_date')}, carrier,
       CAST(qty_ordered AS BIGINT) AS qty_ordered, CAST(qty_shipped AS BIGINT) AS qty_shipped,
       CAST(value_ordered AS DOUBLE) AS value_ordered, CAST(cogs AS DOUBLE) AS cogs, on_time, in_full, otif,
       CAST(lead_days AS BIGINT) AS lead_days
FROM fact_order_lines""")
def order_line_service(b):
    return b.fact_order_lines


@query("orders_rollup", f"""
SELECT order_id, CAST(dc_id AS BIGINT) AS dc_id, CAST(zone_id AS BIGINT) AS zone_id, {_d('order_date')},
       {_d('promised_date')}, {_d('ship_date')}, {_d('delivered_date')}, carrier, CAST(lead_days AS BIGINT) AS lead_days,
       on_time, in_full, CAST(lines AS BIGINT) AS lines, CAST(otif_lines AS BIGINT) AS otif_lines
FROM fact_orders""")
def orders_rollup(b):
    return b.fact_orders


@query("purchase_order_service", f"""
SELECT po_id, supplier_id, CAST(dc_id AS BIGINT) AS dc_id, sku, item_id, {_d('order_date')}, {_d('promised_date')},
       CAST(qty_ordered AS BIGINT) AS qty_ordered, {_d('first_received')}, {_d('last_received')},
       CAST(deliveries AS BIGINT) AS deliveries, CAST(qty_received AS BIGINT) AS qty_received,
       CAST(qty_rejected AS BIGINT) AS qty_rejected, CAST(quoted_lead_days AS BIGINT) AS quoted_lead_days,
       CAST(lead_days AS BIGINT) AS lead_days, on_time, in_full, CAST(value_received AS DOUBLE) AS value_received
FROM fact_purchase_orders""")
def purchase_order_service(b):
    return b.fact_purchase_orders


@query("demand_daily_grid", f"""
SELECT {_d('date')}, CAST(dc_id AS BIGINT) AS dc_id, item_id, qty_ordered, qty_shipped FROM fact_demand_daily""")
def demand_daily_grid(b):
    return b.fact_demand_daily


@query("stock_replay", WALK + f"""
SELECT {_d('date', 'stock_date')}, CAST(dc_id AS BIGINT) AS dc_id, item_id, demand, accepted, CAST(shipped AS BIGINT) AS shipped,
       CAST(on_hand AS BIGINT) AS on_hand, CAST(reorder_point AS BIGINT) AS reorder_point
FROM walked""")
def stock_replay(b):
    return b.stock_daily.select(F.col("date").alias("stock_date"), "dc_id", "item_id", "demand", "accepted",
                                "shipped", "on_hand", "reorder_point")


@query("inventory_valuation", f"""
SELECT {_d('date')}, CAST(dc_id AS BIGINT) AS dc_id, item_id, category, CAST(on_hand AS BIGINT) AS on_hand,
       CAST(reorder_point AS BIGINT) AS reorder_point, CAST(stock_value AS DOUBLE) AS stock_value, carrying_cost,
       out_of_stock, below_reorder_point
FROM fact_inventory_daily""")
def inventory_valuation(b):
    return b.fact_inventory_daily


# ------------------------------------------------------------------------------------------ features
SNAP_KEYS = f"{_d('snapshot_date')}, CAST(dc_id AS BIGINT) AS dc_id, item_id"


@query("demand_rolling", f"""
SELECT {_d('date')}, CAST(dc_id AS BIGINT) AS dc_id, item_id, demand, demand_28d, demand_7d,
       round(demand_sd_28d, 9) AS demand_sd_28d
FROM inv""")
def demand_rolling(b):
    from godown.plans.features import rolling_demand
    r = rolling_demand(b.stock_daily)
    return r.select("date", "dc_id", "item_id", "demand", "demand_28d", "demand_7d",
                    F.round("demand_sd_28d", 9).alias("demand_sd_28d"))


@query("weekly_snapshots", f"""
SELECT {SNAP_KEYS}, category, abc_class, supplier_id, CAST(on_hand AS BIGINT) AS on_hand,
       CAST(reorder_point AS BIGINT) AS reorder_point, below_reorder_point, demand_28d, demand_7d
FROM stockout_snapshots""")
def weekly_snapshots(b):
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "category", "abc_class", "supplier_id",
                                       "on_hand", "reorder_point", "below_reorder_point", "demand_28d", "demand_7d")


@query("stockout_label", f"""
SELECT {SNAP_KEYS}, outcome_known, CAST(stockout_14d AS BIGINT) AS stockout_14d FROM stockout_snapshots""")
def stockout_label(b):
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "outcome_known", "stockout_14d")


@query("open_po_pipeline", f"""
SELECT {SNAP_KEYS}, CAST(open_po_units AS BIGINT) AS open_po_units FROM stockout_snapshots""")
def open_po_pipeline(b):
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "open_po_units")


@query("snapshot_cover_features", f"""
SELECT {SNAP_KEYS}, cover_days, pipeline_cover_days, stock_to_reorder_point FROM stockout_snapshots""")
def snapshot_cover_features(b):
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "cover_days", "pipeline_cover_days",
                                       "stock_to_reorder_point")


@query("snapshot_demand_features", f"""
SELECT {SNAP_KEYS}, demand_trend, round(demand_cv, 9) AS demand_cv FROM stockout_snapshots""")
def snapshot_demand_features(b):
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "demand_trend",
                                       F.round("demand_cv", 9).alias("demand_cv"))


@query("supplier_trailing_180d", f"""
SELECT {_d('date', 'snapshot_date')}, supplier_id, coalesce(supplier_on_time_180d, 0.8) AS supplier_on_time_180d,
       round(coalesce(supplier_lead_sd_180d, 2), 9) AS supplier_lead_sd_180d, supplier_pos_180d
FROM sup""")
def supplier_trailing_180d(b):
    from godown.plans.features import supplier_trailing
    snaps = b.stockout_snapshots.select(F.col("snapshot_date").alias("date"), "supplier_id")
    return supplier_trailing(b.fact_purchase_orders, snaps).select(
        F.col("date").alias("snapshot_date"), "supplier_id", "supplier_on_time_180d",
        F.round("supplier_lead_sd_180d", 9).alias("supplier_lead_sd_180d"), "supplier_pos_180d")


# ------------------------------------------------------------------------------------------ marts
#: Lanes: lines of a city's orders by category and month. The column names and their order are outputs that must match.
MART_LANES_SQL = """
mart_lanes AS (
  SELECT concat_ws('-', dc_id, zone_id) AS lane_id, dc_id, zone_id, category, make_date(year(order_date), month(order_date), 1) AS month,
         count(*) AS lines, count_if(otif) AS otif_lines, count_if(on_time) AS ontime_lines, count_if(in_full) AS infull_lines, sum(lead_days) AS lead_days_sum,
         sum(qty_ordered) AS units_ordered, sum(qty_shipped) AS units_shipped
  FROM fact_order_lines GROUP BY dc_id, zone_id, category, year(order_date), month(order_date))
"""


@query("mart_lanes", f""", {MART_LANES_SQL}
SELECT lane_id, CAST(dc_id AS BIGINT) AS dc_id, CAST(zone_id AS BIGINT) AS zone_id, category, {_d('month')},
       COLUMNS('lines|_sum|units_')::BIGINT
FROM mart_lanes""")
def q_mart_lanes(b):
    return b.mart_lanes


#: Nodes: what a centre held and what left it, added up in one pass over both.
MART_NODES_SQL = f"""
held_and_sent AS (
  SELECT dc_id, category, date, stock_value AS held, NULL::DECIMAL(38,2) AS sent FROM fact_inventory_daily
  UNION ALL SELECT dc_id, category, ship_date, NULL, CAST(cogs AS DECIMAL(38,2)) FROM fact_order_lines),
mart_nodes AS (
  SELECT dc_id, category, date, sum(held) AS stock_value_days, 1 AS days, CAST(sum(held) AS DOUBLE) * {CARRY_RATE} / 365 AS carrying_cost,
         ifnull(sum(sent), 0) AS cogs
  FROM held_and_sent GROUP BY dc_id, category, date HAVING count(held) > 0)
"""


@query("mart_nodes", f""", {MART_NODES_SQL}
SELECT CAST(dc_id AS BIGINT) AS dc_id, category, {_d('date')}, CAST(stock_value_days AS DOUBLE) AS stock_value_days,
       CAST(days AS BIGINT) AS days, carrying_cost, CAST(cogs AS DOUBLE) AS cogs
FROM mart_nodes""")
def q_mart_nodes(b):
    return b.mart_nodes


#: Suppliers: purchase orders that have come in, by the month in which they were complete.
MART_SUPPLIERS_SQL = """
complete AS (
  SELECT f.*, p.category, CAST(date_trunc('month', f.last_received) AS DATE) AS month
  FROM fact_purchase_orders f, prod p WHERE p.sku = f.sku AND f.deliveries > 0),
mart_suppliers AS (
  SELECT supplier_id, dc_id, category, month, count(*) AS pos, count_if(on_time) AS pos_on_time,
         count_if(in_full) AS pos_in_full, sum(lead_days) AS po_lead_days_sum,
         sum(quoted_lead_days) AS po_quoted_days_sum, sum(qty_ordered) AS po_units_ordered,
         sum(qty_received) AS units_received, sum(qty_rejected) AS units_rejected
  FROM complete GROUP BY supplier_id, dc_id, category, month)
"""


@query("mart_suppliers", f""", {MART_SUPPLIERS_SQL}
SELECT supplier_id, CAST(dc_id AS BIGINT) AS dc_id, category, {_d('month')}, CAST(pos AS BIGINT) AS pos,
       CAST(pos_on_time AS BIGINT) AS pos_on_time, CAST(pos_in_full AS BIGINT) AS pos_in_full,
       CAST(po_lead_days_sum AS BIGINT) AS po_lead_days_sum, CAST(po_quoted_days_sum AS BIGINT) AS po_quoted_days_sum,
       CAST(po_units_ordered AS BIGINT) AS po_units_ordered, CAST(units_received AS BIGINT) AS units_received,
       CAST(units_rejected AS BIGINT) AS units_rejected
FROM mart_suppliers""")
def q_mart_suppliers(b):
    return b.mart_suppliers
