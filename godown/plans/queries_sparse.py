"""Registered queries, part 7: order lines served from stock, and the ledger by centre and product.

The SQL never builds a day grid either: stock, demand and open orders of a day are looked up as of that day among the days
with a flow, trailing demand is a difference of running sums, and the label looks for the last empty run that began in time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from godown.config import HORIZON_DAYS, TRAILING_DAYS
from godown.plans.registry import query


@query("line_allocation", """
SELECT order_id, sku, CAST(dc_id AS BIGINT) AS dc_id, item_id, CAST(date AS VARCHAR) AS date, CAST(qty_ordered AS BIGINT) AS qty_ordered,
       qty_from_stock FROM line_stock""")
def line_allocation(b):
    """Units of each order line served from stock: lines of a day take it in the order of their keys."""
    return b.line_stock.select("order_id", "sku", "dc_id", "item_id", "date", "qty_ordered", "qty_from_stock")


EVENTS = """,
moves AS (
  SELECT dc_id, sku, date, sum(demand) AS demand, sum(accepted) AS accepted, sum(opened) AS opened
  FROM (SELECT dc_id, sku, order_date AS date, qty_ordered AS demand, 0 AS accepted, 0 AS opened FROM fact_order_lines
        UNION ALL SELECT o.dc_id, o.sku, g.received_date, 0, g.qty_received - g.qty_rejected, 0 FROM po0 o JOIN stg_goods_receipts g USING (po_id)
        UNION ALL SELECT dc_id, sku, order_date, 0, 0, qty_ordered FROM po0
        UNION ALL SELECT dc_id, sku, last_received, 0, 0, -qty_ordered FROM fact_purchase_orders WHERE last_received IS NOT NULL)
  GROUP BY ALL),
running AS (
  SELECT *, sum(accepted - demand) OVER w AS flow, sum(demand) OVER w AS demanded, sum(demand * demand) OVER w AS squares, sum(opened) OVER w AS open_units
  FROM moves WINDOW w AS (PARTITION BY dc_id, sku ORDER BY date)),
steps AS MATERIALIZED (
  SELECT *, greatest(50 + flow, flow - min(flow) OVER w) AS on_hand, lead(date) OVER w AS until FROM running
  WINDOW w AS (PARTITION BY dc_id, sku ORDER BY date))
"""


@query("product_ledger_runs", EVENTS + """
SELECT CAST(dc_id AS BIGINT) AS dc_id, sku, CAST(date AS VARCHAR) AS valid_from, CAST(ifnull(until - 1, last_day) AS VARCHAR) AS valid_to,
       CAST(on_hand AS BIGINT) AS on_hand, CAST(open_units AS BIGINT) AS open_po_units FROM steps, cal
UNION ALL
SELECT dc_id, sku, first_day::VARCHAR, (min(date) - 1)::VARCHAR, 50, 0 FROM steps, cal GROUP BY dc_id, sku, first_day HAVING min(date) > first_day""")
def product_ledger_runs(b):
    """The run-length stock ledger by centre and product: a row from each day with a flow to the next."""
    return b.product_runs.select("dc_id", "sku", "valid_from", "valid_to", "on_hand", "open_po_units")



@query("product_snapshot_weeks", EVENTS + f""",
weeks AS (SELECT CAST(unnest(generate_series(first_day + INTERVAL 1 MONTH, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM cal),
asked AS (
  SELECT s.dc_id, s.sku, w.day, w.day - 28 AS month_ago, w.day - 7 AS week_ago, least(w.day + {HORIZON_DAYS}, {{last}}) AS ahead
  FROM (SELECT DISTINCT dc_id, sku FROM moves) s, (FROM weeks WHERE isodow(day) = 1) w),
suppliers AS (
  SELECT k.day, k.supplier_id, avg(f.on_time::INTEGER) AS rate
  FROM (SELECT w.day, supplier_id FROM (FROM weeks WHERE isodow(day) = 1) w, (SELECT DISTINCT supplier_id FROM prod)) k
  LEFT JOIN fact_purchase_orders f ON f.supplier_id = k.supplier_id AND k.day - f.last_received BETWEEN 0 AND {TRAILING_DAYS - 1} GROUP BY ALL),
states AS (
  SELECT q.dc_id, q.sku, q.day, ifnull(t.on_hand, 50) AS on_hand, ifnull(t.open_units, 0) AS open_units,
         ifnull(t.demanded, 0) - ifnull(m.demanded, 0) AS s28, ifnull(t.demanded, 0) - ifnull(k.demanded, 0) AS s7,
         ifnull(t.squares, 0) - ifnull(m.squares, 0) AS q28,
         e.date IS NOT NULL AND ifnull(e.until, DATE '9999-01-01') > q.day + 1 AS runs_out, q.ahead - q.day = {HORIZON_DAYS} AS known
  FROM asked q
  ASOF LEFT JOIN steps t ON t.dc_id = q.dc_id AND t.sku = q.sku AND q.day >= t.date
  ASOF LEFT JOIN steps m ON m.dc_id = q.dc_id AND m.sku = q.sku AND q.month_ago >= m.date
  ASOF LEFT JOIN steps k ON k.dc_id = q.dc_id AND k.sku = q.sku AND q.week_ago >= k.date
  ASOF LEFT JOIN (FROM steps WHERE on_hand < 1) e ON e.dc_id = q.dc_id AND e.sku = q.sku AND q.ahead >= e.date),
rated AS (
  SELECT *, 8 * s28 // 28 AS rp, s28 / 28.0 AS pace FROM states)
SELECT CAST(r.day AS VARCHAR) AS snapshot_date, CAST(r.dc_id AS BIGINT) AS dc_id, count(*) AS n, sum(on_hand)::BIGINT AS on_hand,
       sum(rp)::BIGINT AS reorder_point, count(*) FILTER (WHERE on_hand <= rp) AS below, sum(open_units)::BIGINT AS open_po_units,
       count(*) FILTER (WHERE known) AS known, count(*) FILTER (WHERE known AND runs_out) AS stockouts,
       round(avg(least(120, on_hand / nullif(pace, 0))), 6) AS cover_days, round(avg(s7 / 7.0 / nullif(pace, 0)), 6) AS demand_trend,
       round(avg(sqrt(greatest(q28 / 28.0 - pace * pace, 0)) / nullif(pace, 0)), 6) AS demand_cv,
       round(avg(ifnull(s.rate, 0.8)), 6) AS on_time, count(*) FILTER (WHERE p.abc_class = 'A') AS class_a
FROM rated r JOIN dim_product p ON p.sku = r.sku JOIN suppliers s ON s.day = r.day AND s.supplier_id = p.supplier_id
GROUP BY r.day, r.dc_id""".replace("{last}", "(SELECT last_day FROM cal)"))
def product_snapshot_weeks(b):
    """All snapshots by centre and product, summed by week and centre. Features are worked out once a run of snapshots with one
    state and spread over its days only to be summed; the suppliers' rates, which change by the day, are summed by supplier."""
    known = F.date_add("snapshot_date", HORIZON_DAYS) <= F.lit(b.cal.end)
    s = (b.product_snapshot_runs.select("*", F.explode("held").alias("snapshot_date")).withColumn("outcome_known", known)
         .withColumn("stockout_14d", F.when(F.col("outcome_known"), F.col("out_next_14d").cast("int"))))
    on_time = b.product_supplier_weeks.select(F.col("date").alias("_day"), F.col("dc_id").alias("_dc"), "supplier_on_time_180d")
    flag = lambda c: F.count_if(c)
    mean = lambda c: F.round(F.avg(c), 6)
    sums = s.groupBy("snapshot_date", "dc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("on_hand").alias("on_hand"), F.sum("reorder_point").alias("reorder_point"),
        flag("below_reorder_point").alias("below"), F.sum("open_po_units").alias("open_po_units"), flag("outcome_known").alias("known"),
        F.coalesce(F.sum("stockout_14d"), F.lit(0)).cast("long").alias("stockouts"), mean("cover_days").alias("cover_days"),
        mean("demand_trend").alias("demand_trend"), mean("demand_cv").alias("demand_cv"),
        flag(F.col("abc_class") == "A").alias("class_a"))
    return (sums.join(on_time, (F.col("snapshot_date") == F.col("_day")) & F.col("dc_id").eqNullSafe(F.col("_dc")))
            .select(*[c for c in sums.columns if c != "class_a"], F.round("supplier_on_time_180d", 6).alias("on_time"), "class_a"))
