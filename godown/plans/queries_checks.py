"""Registered queries, part 3: the long table, the checks (clean and broken counts), the suite.

The SQL of a check states its rule another way than the Spark code, over a table that stands for either the clean or
the broken version of its input; the broken version is the same break as in ``checks``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from godown.config import ABC_A_BAND, ABC_C_MAX, CARRY_RATE, HORIZON_DAYS, SUPPLIER_ON_TIME_DEFAULT, TRAILING_DAYS
from godown.plans import checks
from godown.plans.marts import WORKBENCH_COLUMNS
from godown.plans.oracle import LAST_DAY
from godown.plans.queries import MART_LANES_SQL, MART_NODES_SQL, MART_SUPPLIERS_SQL
from godown.plans.registry import query

#: Each record type names only the columns that it has; UNION ALL BY NAME leaves the others null.
WORKBENCH_SQL = f""", {MART_LANES_SQL}, {MART_NODES_SQL}, {MART_SUPPLIERS_SQL},
places AS (
  SELECT w.dc_id, w.dc_city, w.lat, w.lon, (SELECT min(m.lane_id) FROM mart_lanes m WHERE m.dc_id = w.dc_id) AS first_lane FROM dim_dc w),
years AS (SELECT month AS period_date, any_value(fiscal_year) AS fiscal_year FROM dim_date GROUP BY month),
lane_ends AS (
  SELECT p.dc_city, z.city, z.zone_id, p.dc_id, unnest([
           {{'point_order': 1, 'map_point': p.dc_city, 'lat': p.lat, 'lon': p.lon}},
           {{'point_order': 2, 'map_point': z.city, 'lat': z.lat, 'lon': z.lon}}], recursive := true)
  FROM dim_zone z JOIN places p ON p.dc_id = z.dc_id),
lane_months AS (
  SELECT 'Lane' AS record_type, month AS period_date, m.* EXCLUDE (month) FROM mart_lanes m),
sc_workbench AS (
  SELECT record_type, period_date, lane_id, category, dc_id, lines, otif_lines, ontime_lines, infull_lines, lead_days_sum,
         units_ordered, units_shipped, city, dc_city, point_order, map_point, lat, lon, fiscal_year
  FROM lane_months JOIN lane_ends USING (dc_id, zone_id) JOIN years USING (period_date) WHERE point_order = 1
  UNION ALL BY NAME
  SELECT record_type, period_date, lane_id, category, dc_id, city, dc_city, point_order, map_point, lat, lon, fiscal_year
  FROM lane_months JOIN lane_ends USING (dc_id, zone_id) JOIN years USING (period_date) WHERE point_order = 2
  UNION ALL BY NAME
  SELECT 'Node' AS record_type, n.date AS period_date, n.dc_id, n.category, CAST(n.stock_value_days AS DOUBLE) AS stock_value_days, n.days,
         CAST(n.cogs AS DOUBLE) AS cogs, n.carrying_cost, p.dc_city, p.first_lane AS lane_id, 1 AS point_order,
         p.dc_city AS map_point, p.lat, p.lon, d.fiscal_year
  FROM mart_nodes n, places p, dim_date d WHERE p.dc_id = n.dc_id AND d.date = n.date
  UNION ALL BY NAME
  SELECT 'Supplier' AS record_type, month AS period_date, s.* EXCLUDE (month), p.dc_city, n.supplier, y.fiscal_year
  FROM mart_suppliers s, places p, names n, years y
  WHERE p.dc_id = s.dc_id AND n.supplier_id = s.supplier_id AND y.period_date = s.month
  UNION ALL BY NAME
  SELECT 'Snapshot' AS record_type, snapshot_date AS period_date, s.dc_id, s.category, s.supplier_id, s.item_id AS sku, s.on_hand,
         s.reorder_point, s.cover_days, s.stockout_14d, c.risk_score, c.risk_band, NULL::VARCHAR AS reasons, n.supplier, p.dc_city,
         p.first_lane AS lane_id, 1 AS point_order, p.dc_city AS map_point, p.lat, p.lon, d.fiscal_year
  FROM stockout_snapshots s NATURAL JOIN (SELECT snapshot_date, dc_id, item_id, risk_score, risk_band FROM stockout_scores) c,
       places p, names n, dim_date d
  WHERE p.dc_id = s.dc_id AND n.supplier_id = s.supplier_id AND d.date = s.snapshot_date)
"""

_PORTABLE = {"date": "VARCHAR", "bigint": "BIGINT", "int": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
WB_COLS = ", ".join(f"CAST({c} AS {_PORTABLE[t]}) AS {c}" for c, t in WORKBENCH_COLUMNS)


@query("workbench", WORKBENCH_SQL + f"SELECT {WB_COLS} FROM sc_workbench")
def q_workbench(b):
    return b.sc_workbench


# ------------------------------------------------------------------------------------------ checks
def _top(t: str, *keys: str) -> str:
    """The rows of {t} at its largest key."""
    cols = ", ".join(keys)
    return f"({cols}) = (SELECT ({cols}) FROM {t} ORDER BY {', '.join(k + ' DESC' for k in keys)} LIMIT 1)"


def _with(t: str, column: str, value: str, where: str) -> str:
    return f"SELECT * REPLACE (CASE WHEN {where} THEN {value} ELSE {column} END AS {column}) FROM {t}"


SNAPS, STOCK = "stockout_snapshots", "fact_inventory_daily"
SNAP_DAY = ("snapshot_date", "dc_id", "item_id")
# The snapshots to recount: of the first week of a month, or all of them.
FIRST_WEEK, EVERY_WEEK = {"recounted": "day(s.snapshot_date) < 8", "chosen": "day(snapshot_date) < 8"}, {"recounted": "true", "chosen": "true"}
# key -> (rows of {T} that break the rule, the table that {T} stands for, its broken version)
CHECK_SQL = {
    "check_supplier_names": (
        "FROM {T} WHERE supplier <> array_to_string(regexp_extract_all(supplier, '[^ ]+'), ' ') OR NOT regexp_matches(supplier, '[a-z]')",
        "dim_supplier", _with("dim_supplier", "supplier", "replace(supplier, ' ', '  ')", _top("dim_supplier", "supplier_id"))),
    "check_one_shipment": (
        "SELECT order_id FROM stg_sales_orders o LEFT JOIN {T} s USING (order_id) GROUP BY order_id "
        "HAVING NOT (count(s.ship_date) = 1 AND bool_and(ifnull(delivered_date >= ship_date AND ship_date >= order_date, false)))",
        "stg_shipments", f"FROM stg_shipments WHERE NOT ({_top('stg_shipments', 'order_id')})"),
    "check_zone_dc": (
        "FROM {T} o WHERE NOT EXISTS (FROM dim_zone z WHERE (z.zone_id, z.dc_id) = (o.zone_id, o.dc_id))",
        "stg_sales_orders", _with("stg_sales_orders", "dc_id", "dc_id + 1", _top("stg_sales_orders", "zone_id"))),
    "check_shipped_qty": (
        "FROM {T} WHERE NOT (qty_ordered > 0 AND qty_shipped BETWEEN 0 AND qty_ordered)",
        "stg_order_lines", _with("stg_order_lines", "qty_shipped", "-2 - qty_shipped", _top("stg_order_lines", "order_id", "sku"))),
    "check_stock_nonneg": (
        "FROM {T} WHERE sign(on_hand) = -1", STOCK, _with(STOCK, "on_hand", "-5 - on_hand", _top(STOCK, "date", "dc_id", "item_id"))),
    "check_stock_balance": (
        "FROM (SELECT t.date, t.on_hand - y.on_hand AS grown, coalesce(a.accepted, 0) - coalesce(l.units, 0) AS moved FROM {T} t "
        "JOIN {T} y ON (y.date + 1, y.dc_id, y.item_id) = (t.date, t.dc_id, t.item_id) "
        "LEFT JOIN acc a ON (a.date, a.dc_id, a.item_id) = (t.date, t.dc_id, t.item_id) "
        "LEFT JOIN (SELECT date, dc_id, item_id, sum(qty_from_stock) AS units FROM line_stock GROUP BY ALL) l "
        "ON (l.date, l.dc_id, l.item_id) = (t.date, t.dc_id, t.item_id)) WHERE grown <> moved",
        STOCK, _with(STOCK, "on_hand", "on_hand + 7", _top(STOCK, "date", "dc_id", "item_id"))),
    "check_receipts": (
        "FROM {T} WHERE greatest(qty_rejected - qty_received, qty_received - qty_ordered) > 0",
        "fact_purchase_orders", _with("fact_purchase_orders", "qty_received", "2 * qty_ordered + 1",
                                      _top("(FROM fact_purchase_orders WHERE deliveries > 0)", "po_id"))),
    "check_po_supplier": (
        "FROM {T} o WHERE supplier_id <> (SELECT p.supplier_id FROM dim_product p WHERE p.sku = o.sku)",
        "stg_purchase_orders", _with("stg_purchase_orders", "supplier_id", "-1 - supplier_id", _top("stg_purchase_orders", "sku"))),
    "check_abc_shares": (
        "FROM (SELECT c.abc_class AS class, sum(f.cogs) / (SELECT sum(cogs) FROM fact_order_lines)::DOUBLE AS part "
        "FROM {T} c, fact_order_lines f WHERE f.sku = c.sku GROUP BY class) "
        f"WHERE class = 'A' AND abs(part - {sum(ABC_A_BAND) / 2}) > {(ABC_A_BAND[1] - ABC_A_BAND[0]) / 2} OR class = 'C' AND part > {ABC_C_MAX}",
        "dim_product", _with("dim_product", "abc_class", "'A'", "abc_class = 'B'")),
    "check_carrying_cost": (
        f"FROM {{T}} WHERE NOT carrying_cost BETWEEN stock_value * ({CARRY_RATE} / 365) - 1e-6 AND stock_value * ({CARRY_RATE} / 365) + 1e-6",
        STOCK, _with(STOCK, "carrying_cost", "carrying_cost * 2", _top(f"(FROM {STOCK} WHERE on_hand > 0)", "date", "dc_id", "item_id"))),
    "check_label_recount": (
        f"FROM {{T}} s ASOF LEFT JOIN (FROM {STOCK} WHERE out_of_stock) e ON e.dc_id = s.dc_id AND e.item_id = s.item_id AND e.date > s.snapshot_date "
        f"WHERE s.outcome_known AND {{recounted}} AND (s.stockout_14d = 1) <> ifnull(e.date - s.snapshot_date <= {HORIZON_DAYS}, false)",
        SNAPS, _with(SNAPS, "stockout_14d", "1 - stockout_14d", _top(SNAPS, "dc_id", "item_id"))),
    "check_label_censoring": (
        f"FROM {{T}} WHERE CASE WHEN {LAST_DAY} - snapshot_date >= {HORIZON_DAYS} THEN stockout_14d IS NULL ELSE stockout_14d IS NOT NULL END",
        SNAPS, _with(SNAPS, "stockout_14d", "NULL", f"snapshot_date = (SELECT min(snapshot_date) FROM {SNAPS})")),
    "check_supplier_leakage": (
        "FROM (SELECT s.snapshot_date, s.supplier_id, s.rate, avg(f.on_time::INTEGER) AS seen "
        "FROM (SELECT DISTINCT snapshot_date, supplier_id, supplier_on_time_180d AS rate FROM {T} WHERE {chosen}) s "
        f"LEFT JOIN fact_purchase_orders f ON f.supplier_id = s.supplier_id AND s.snapshot_date - f.last_received BETWEEN 0 AND {TRAILING_DAYS - 1} "
        f"GROUP BY ALL) WHERE abs(rate - ifnull(seen, {SUPPLIER_ON_TIME_DEFAULT})) > 1e-9",
        SNAPS, _with(SNAPS, "supplier_on_time_180d", "supplier_on_time_180d / 2 + 0.61", _top(SNAPS, "supplier_id"))),
    "check_scores": (
        f"FROM {SNAPS} s WHERE NOT EXISTS (FROM {{T}} c WHERE (c.snapshot_date, c.dc_id, c.item_id) = (s.snapshot_date, s.dc_id, s.item_id) "
        "AND c.risk_score >= 0 AND c.risk_score <= 1)",
        "stockout_scores", _with("stockout_scores", "risk_score", "1.5", _top("stockout_scores", *SNAP_DAY))),
    "check_reconcile": (
        "FROM (UNPIVOT (SELECT "
        "(sum(lines) - (SELECT count(*) FROM fact_order_lines))::DOUBLE AS lines, "
        "(count(*) FILTER (WHERE record_type = 'Lane' AND point_order = 2) - count(*) FILTER (WHERE record_type = 'Lane' AND point_order = 1))::DOUBLE AS ends, "
        "count(*) FILTER (WHERE record_type IN ('Node', 'Snapshot') AND (point_order <> 1 OR split_part(lane_id, '-', 1) <> dc_id::VARCHAR))::DOUBLE AS anchors, "
        "count(*) FILTER (WHERE record_type <> 'Supplier' AND (map_point IS NULL OR lat IS NULL))::DOUBLE AS unmapped, "
        f"(sum(cogs) / (SELECT sum(cogs)::DOUBLE FROM fact_order_lines) - 1) * 1e3 AS goods, "
        f"(sum(carrying_cost) / (SELECT sum(carrying_cost) FROM {STOCK}) - 1) * 1e3 AS carrying, "
        "(sum(pos) - (SELECT count(last_received) FROM fact_purchase_orders))::DOUBLE AS orders, "
        f"(count(*) FILTER (WHERE record_type = 'Snapshot') - (SELECT count(*) FROM {SNAPS}))::DOUBLE AS snapshots "
        "FROM {T}) ON lines, ends, anchors, unmapped, goods, carrying, orders, snapshots INTO NAME what VALUE off) WHERE abs(off) > 1e-6",
        "sc_workbench", "FROM sc_workbench WHERE NOT (record_type = 'Node' AND period_date = (SELECT max(period_date) FROM sc_workbench "
        "WHERE record_type = 'Node'))"),
}


def _suite(keys, select: str, weeks: dict[str, str] = FIRST_WEEK) -> str:
    """One statement for some checks: broken tables as CTEs, then a row a check."""
    ctes = [f"broken_{k} AS ({CHECK_SQL[k][2]})" for k in keys]
    rows = [select.format(key=k, clean=f"(SELECT count(*) FROM ({CHECK_SQL[k][0].format(T=CHECK_SQL[k][1], **weeks)}))",
                          broken=f"(SELECT count(*) FROM ({CHECK_SQL[k][0].format(T=f'broken_{k}', **weeks)}))") for k in keys]
    return WORKBENCH_SQL + ", " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


COUNTS = "SELECT '{key}' AS check_name, {clean} AS violations, {broken} AS mutated_violations"


def _register_check(key: str) -> None:
    @query(key, _suite([key], COUNTS))
    def run(b):
        return checks.check_counts(b.tables(), key, rules=checks.FIRST_WEEKS)


for _key in checks.CHECKS:
    _register_check(_key)


@query("check_summary", _suite(checks.CHECKS, "SELECT '{key}' AS check_name, {clean} AS violations, {clean} = 0 AS passed, "
                                              "CASE WHEN {clean} > 0 THEN 'a row' END AS example"))
def check_summary(b):
    """The suite on clean data: a row a check with its violation count, pass flag and first violating row."""
    out = None
    for key in checks.CHECKS:
        row = checks.found(b.tables(), key, checks.FIRST_WEEKS).select(F.lit(key).alias("check_name"), "violations",
                                                   (F.col("violations") == 0).alias("passed"), "example")
        out = row if out is None else out.unionByName(row)
    return out


@query("mutation_catches", _suite(checks.CHECKS, COUNTS + ", {clean} = 0 AND {broken} > 0 AS caught", EVERY_WEEK))
def mutation_catches(b):
    """Every check passes on clean data and fires on its own break; the recounts take every snapshot."""
    return checks.check_counts(b.tables(), *checks.CHECKS).withColumn(
        "caught", (F.col("violations") == 0) & (F.col("mutated_violations") > 0))


@query("label_recount_all", f"""
SELECT count(*) AS snapshots, sum(stockout_14d)::BIGINT AS stockouts, 0::BIGINT AS wrong FROM {SNAPS} WHERE outcome_known""")
def label_recount_all(b):
    """The label recounted for every snapshot with a known outcome, not only for the first week of a month."""
    t = b.tables()
    wrong = checks.label_recount(t, sample=None).agg(F.count(F.lit(1)).alias("wrong"))
    return t[SNAPS].filter("outcome_known").agg(F.count(F.lit(1)).alias("snapshots"),
                                                F.sum(F.col("stockout_14d").cast("long")).alias("stockouts")).crossJoin(wrong)


@query("supplier_leakage_all", f"""
SELECT count(*) AS snapshots, count(DISTINCT (snapshot_date, supplier_id)) AS recounted, 0::BIGINT AS wrong FROM {SNAPS}""")
def supplier_leakage_all(b):
    """The supplier on-time feature recounted for every snapshot, not only for the first week of a month."""
    t = b.tables()
    wrong = checks.supplier_leakage(t, sample=None).agg(F.count(F.lit(1)).alias("wrong"))
    return t[SNAPS].agg(F.count(F.lit(1)).alias("snapshots"),
                        F.count_distinct(F.struct("snapshot_date", "supplier_id")).alias("recounted")).crossJoin(wrong)
