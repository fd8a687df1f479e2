"""Raw exports: text-first CSV scan and the typed staging projection.

Every export is read with an all-string schema (no inference), then cast column by column. Under
ANSI mode a bad value fails the build instead of turning into a silent null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from godown.functions.text import clean_name

# export -> [(raw column, staged column, target type)]; type None keeps the value as it is (ids, names)
EXPORTS: dict[str, list[tuple[str, str, str | None]]] = {
    "warehouses": [("dc_id", "dc_id", None), ("dc_city", "dc_city", None), ("lat", "lat", "double"),
                   ("lon", "lon", "double")],
    "delivery_zones": [("zone_id", "zone_id", None), ("city", "city", None), ("state", "state", None),
                       ("lat", "lat", "double"), ("lon", "lon", "double"), ("serving_dc", "dc_id", None),
                       ("road_km", "road_km", "double"), ("std_transit_days", "std_transit_days", "int")],
    "suppliers": [("supplier_id", "supplier_id", None), ("supplier", "supplier", None),
                  ("category", "category", None), ("hub", "hub", None), ("state", "state", None),
                  ("lat", "lat", "double"), ("lon", "lon", "double"), ("quoted_lead_days", "quoted_lead_days", "int")],
    "products": [("sku", "sku", None), ("category", "category", None),
                 ("supplier_id", "supplier_id", None), ("unit_cost", "unit_cost", "decimal(18,2)"),
                 ("unit_price", "unit_price", "decimal(18,2)"), ("case_qty", "case_qty", "int")],
    "sales_orders": [("order_id", "order_id", None), ("zone_id", "zone_id", None), ("dc_id", "dc_id", None),
                     ("order_date", "order_date", "date"), ("promised_date", "promised_date", "date")],
    "order_lines": [("order_id", "order_id", None), ("sku", "sku", None), ("qty_ordered", "qty_ordered", "int"),
                    ("qty_shipped", "qty_shipped", "int")],
    "shipments": [("order_id", "order_id", None), ("ship_date", "ship_date", "date"),
                  ("delivered_date", "delivered_date", "date"), ("carrier", "carrier", None)],
    "purchase_orders": [("po_id", "po_id", None), ("supplier_id", "supplier_id", None), ("dc_id", "dc_id", None),
                        ("sku", "sku", None), ("order_date", "order_date", "dd/MM/yyyy"),
                        ("promised_date", "promised_date", "dd/MM/yyyy"), ("qty_ordered", "qty_ordered", "int")],
    "goods_receipts": [("po_id", "po_id", None), ("received_date", "received_date", "date"),
                       ("qty_received", "qty_received", "int"), ("qty_rejected", "qty_rejected", "int")],
    "inventory_daily": [("stock_date", "stock_date", "date"), ("dc_id", "dc_id", None), ("sku", "item_id", None),
                        ("on_hand", "on_hand", "int"), ("reorder_point", "reorder_point", "int")],
}


def text_schema(export: str) -> T.StructType:
    return T.StructType([T.StructField(raw, T.StringType(), True) for raw, _, _ in EXPORTS[export]])


def read_text_csv(spark: SparkSession, path: str, export: str) -> DataFrame:
    """Scan a CSV export as text: header line, every column a string, malformed rows fail the read."""
    return (spark.read.schema(text_schema(export)).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def parse_day_first(c, lenient: bool = False):
    """``dd/MM/yyyy`` text to DATE; ``lenient`` turns unparsable text into null instead of an error."""
    fmt = F.lit("dd/MM/yyyy")
    return F.try_to_date(c, fmt) if lenient else F.to_date(c, "dd/MM/yyyy")


def _typed(c, target: str | None):
    if target is None:
        return c
    if target == "dd/MM/yyyy":
        return parse_day_first(c)
    if target == "date":
        return c.cast("date")
    return c.cast(target)


def stage(export: str, raw: DataFrame) -> DataFrame:
    """Typed staging projection of one export (casts, renames, supplier names cleaned)."""
    cols = []
    for src, dst, target in EXPORTS[export]:
        c = _typed(F.col(src), target)
        if export == "suppliers" and dst == "supplier":
            c = clean_name(c)
        cols.append(c.alias(dst))
    if export == "products":  # what is stocked: the adapter's brand/type, else the product itself
        cols.append(F.col("item_id" if "item_id" in raw.columns else "sku").alias("item_id"))
    return raw.select(*cols)
