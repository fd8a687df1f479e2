"""Registered queries, part 6: sources and sinks exercised on tables derived from the driver tables,
and the most frequent supplier per category.

The sink queries write under the session's shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from godown.plans import checks, metrics, queries_model
from godown.plans.queries_checks import WORKBENCH_SQL
from godown.plans.registry import query
from godown.session import checkpoint_dir, cut_lineage
from godown.sources import sinks
from godown.sources.exports import EXPORTS, read_text_csv, stage


def _scratch(b, name: str) -> str:
    return f"{checkpoint_dir(b.spark).rstrip('/')}/godown-{name}-{uuid.uuid4().hex}"


@query("scan_text_csv", """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(sku AS VARCHAR) AS sku, CAST(qty_ordered AS BIGINT) AS qty_ordered,
       CAST(qty_shipped AS BIGINT) AS qty_shipped FROM stg_order_lines""")
def scan_text_csv(b):
    """The order-line export written as CSV text, scanned with an all-string schema, then staged."""
    path = _scratch(b, "order_lines_csv")
    cols = [raw for raw, _, _ in EXPORTS["order_lines"]]
    b.raw["order_lines"].select(*[F.col(c).cast("string") for c in cols]).write.option("header", True).csv(path)
    return stage("order_lines", read_text_csv(b.spark, path, "order_lines"))


# export -> a number that any lost or changed value would move: (Spark, SQL, the table in SQL)
EXPORT_SUMS = {
    "warehouses": ("lat + lon", "lat + lon", "dim_dc"),
    "delivery_zones": ("road_km + std_transit_days", "road_km + std_transit_days", "dim_zone"),
    "suppliers": ("quoted_lead_days * length(supplier)", "quoted_lead_days * length(supplier)", "dim_supplier"),
    "products": ("unit_cost * case_qty", "unit_cost * case_qty", "prod"),
    "sales_orders": ("datediff(promised_date, order_date)", "promised_date - order_date", "stg_sales_orders"),
    "order_lines": ("10 * qty_ordered + qty_shipped", "10 * qty_ordered + qty_shipped", "stg_order_lines"),
    "shipments": ("datediff(delivered_date, ship_date)", "delivered_date - ship_date", "stg_shipments"),
    "purchase_orders": ("qty_ordered + datediff(promised_date, order_date)", "qty_ordered + (promised_date - order_date)",
                        "stg_purchase_orders"),
    "goods_receipts": ("qty_received - 2 * qty_rejected", "qty_received - 2 * qty_rejected", "stg_goods_receipts"),
    "inventory_daily": ("on_hand + 3 * reorder_point", "on_hand + 3 * reorder_point", "ledger"),
}


@query("scan_all_exports", "\nUNION ALL ".join(
    f"SELECT '{name}' AS export, count(*) AS rows, round(CAST(sum({sql}) AS DOUBLE), 6) AS total FROM {table}"
    for name, (_, sql, table) in EXPORT_SUMS.items()))
def scan_all_exports(b):
    """All ten exports written as CSV text, scanned as text and staged; rows and a sum over typed values of each."""
    raw = b.raw | {"inventory_daily": b.stg_inventory.withColumnRenamed("item_id", "sku")}
    out = None
    for name, (total, _, _) in EXPORT_SUMS.items():
        path = _scratch(b, f"{name}_csv")
        raw[name].select(*[F.col(c).cast("string") for c, _, _ in EXPORTS[name]]).write.option("header", True).csv(path)
        one = stage(name, read_text_csv(b.spark, path, name)).agg(
            F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.expr(total)).cast("double"), 6).alias("total"))
        one = one.select(F.lit(name).alias("export"), "rows", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("materialise_roundtrip", """
SELECT order_id, CAST(dc_id AS BIGINT) AS dc_id, CAST(zone_id AS BIGINT) AS zone_id, CAST(order_date AS VARCHAR) AS order_date,
       CAST(promised_date AS VARCHAR) AS promised_date, CAST(ship_date AS VARCHAR) AS ship_date,
       CAST(delivered_date AS VARCHAR) AS delivered_date, carrier, CAST(lead_days AS BIGINT) AS lead_days,
       on_time, in_full, CAST(lines AS BIGINT) AS lines, CAST(otif_lines AS BIGINT) AS otif_lines
FROM fact_orders""")
def materialise_roundtrip(b):
    """The order fact rebuilt whole as a parquet table and read back."""
    return sinks.materialise(b.fact_orders, _scratch(b, "fact_orders"))


@query("typed_extract", WORKBENCH_SQL + """
SELECT record_type, count(*) AS rows FROM sc_workbench GROUP BY record_type""")
def typed_extract(b):
    """The long table written as a typed extract partitioned by record type; rows per type read back."""
    path = _scratch(b, "extract")
    sinks.typed_extract(b.sc_workbench, path)
    return b.spark.read.parquet(path).groupBy("record_type").agg(F.count(F.lit(1)).alias("rows"))


#: Exported tables; those of the trained model have no row counts in SQL, so they are reported without.
GATED = ("dim_dc", "dim_zone", "dim_supplier", "dim_product", "model_metrics", "model_calibration", "model_importance", "sc_workbench")
TRAINED = ("model_metrics", "model_calibration", "model_importance")


def exported_tables(b) -> dict:
    """The eight tables that leave the build; the model's from its one training, the long table with its scores and reasons."""
    _, chosen, fitted = b.training
    return {n: getattr(b, n) for n in ("dim_dc", "dim_zone", "dim_supplier", "dim_product")} | {
        "model_metrics": queries_model.model_metrics(b), "sc_workbench": b.trained_workbench,
        "model_calibration": cut_lineage(metrics.calibration(fitted[chosen][1])),
        "model_importance": cut_lineage(queries_model.permutation_importance(b))}


@query("gated_export", WORKBENCH_SQL + "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, {'NULL::BIGINT' if n in TRAINED else f'(SELECT count(*) FROM {n})'} AS rows, true AS ordered, true AS same" for n in GATED))
def gated_export(b):
    """Run the 15 checks; export eight tables as CSV in a total order only if all pass; order and contents read back."""
    out, t = _scratch(b, "export"), b.tables()
    tables = exported_tables(b)
    ok, results = sinks.gated_export(tables, lambda: checks.run_checks(t), out, list(GATED))
    if not ok:
        raise RuntimeError(f"checks failed, nothing exported: {[r for r in results if r[1]]}")
    res = None
    for n in GATED:
        one = sinks.verified(tables[n], f"{out}/{n}").select(
            F.lit(n).alias("table_name"), F.when(F.lit(n not in TRAINED), F.col("rows")).alias("rows"), "ordered", "same")
        res = one if res is None else res.unionByName(one)
    return res


@query("blocked_export", """
SELECT 'check_supplier_names' AS check_name, count(*) AS violations, false AS exported, 0::BIGINT AS paths_written
FROM dim_supplier WHERE supplier_id = (SELECT max(supplier_id) FROM dim_supplier)""")
def blocked_export(b):
    """One broken supplier name: the check fires, and nothing is written."""
    key, out = "check_supplier_names", _scratch(b, "blocked")
    t = checks.broken_tables({"dim_supplier": b.dim_supplier}, key)
    ok, results = sinks.gated_export(t, lambda: checks.run_checks(t, (key,)), out, ["dim_supplier"])
    path = b.spark._jvm.org.apache.hadoop.fs.Path(out)
    written = path.getFileSystem(b.spark._jsc.hadoopConfiguration()).exists(path)
    return b.spark.createDataFrame([(k, n, ok, int(written)) for k, n, _ in results],
                                   "check_name string, violations long, exported boolean, paths_written long")


@query("top_supplier_per_category", """
SELECT category, supplier_id, products FROM (
  SELECT category, supplier_id, count(*) AS products,
         row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, supplier_id) AS rn
  FROM prod GROUP BY category, supplier_id) WHERE rn = 1""")
def top_supplier_per_category(b):
    """The supplier with the most products in each category (ties to the smaller id): an arg-max
    over a pre-aggregated count, no sort of the products."""
    counts = b.stg_products.groupBy("category", "supplier_id").agg(F.count(F.lit(1)).alias("products"))
    best = F.min(F.struct((-F.col("products")).alias("fewest"), "supplier_id", "products"))
    return counts.groupBy("category").agg(best.alias("b")).select("category", "b.supplier_id", "b.products")
