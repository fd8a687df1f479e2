"""Subject marts and the long dashboard table (one record type per subject, 41 typed columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.config import CARRY_RATE
from godown.functions.dates import month_start


def mart_lanes(lines: DataFrame) -> DataFrame:
    """Outbound lane (centre -> city) x category x order month."""
    return (lines.groupBy(F.concat_ws("-", F.col("dc_id").cast("string"), F.col("zone_id").cast("string")).alias("lane_id"),
                          "dc_id", "zone_id", "category", month_start(F.col("order_date")).alias("month"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("otif").cast("long")).alias("otif_lines"),
                 F.sum(F.col("on_time").cast("long")).alias("ontime_lines"),
                 F.sum(F.col("in_full").cast("long")).alias("infull_lines"),
                 F.sum(F.col("lead_days").cast("long")).alias("lead_days_sum"),
                 F.sum(F.col("qty_ordered").cast("long")).alias("units_ordered"),
                 F.sum(F.col("qty_shipped").cast("long")).alias("units_shipped")))


def mart_nodes(inventory: DataFrame, lines: DataFrame, carry_rate: float = CARRY_RATE) -> DataFrame:
    """Centre x category x day: stock value (exact decimal sum), carrying cost, cost of goods by ship day.

    Money is summed as DECIMAL, so the result does not depend on shuffle order; the carrying cost is
    derived once from the exact day total.
    """
    stock = (inventory.groupBy("dc_id", "category", "date")
             .agg(F.sum("stock_value").alias("stock_value_days"))
             .select("dc_id", "category", "date", "stock_value_days", F.lit(1).alias("days"),
                     (F.col("stock_value_days").cast("double") * carry_rate / 365).alias("carrying_cost")))
    cogs = lines.groupBy("dc_id", "category", F.col("ship_date").alias("date")).agg(F.sum("cogs").alias("cogs"))
    return (stock.join(cogs, ["dc_id", "category", "date"], "left")
            .withColumn("cogs", F.coalesce(F.col("cogs"), F.lit(0).cast(cogs.schema["cogs"].dataType))))


def mart_suppliers(pos: DataFrame, products: DataFrame) -> DataFrame:
    """Supplier x centre x product category x month of the last receipt (received POs only)."""
    return (pos.filter(F.col("last_received").isNotNull())
            .join(products.select("sku", "category"), "sku")
            .groupBy("supplier_id", "dc_id", "category", month_start(F.col("last_received")).alias("month"))
            .agg(F.count(F.lit(1)).alias("pos"), F.sum(F.col("on_time").cast("long")).alias("pos_on_time"),
                 F.sum(F.col("in_full").cast("long")).alias("pos_in_full"),
                 F.sum(F.col("lead_days").cast("long")).alias("po_lead_days_sum"),
                 F.sum(F.col("quoted_lead_days").cast("long")).alias("po_quoted_days_sum"),
                 F.sum(F.col("qty_ordered").cast("long")).alias("po_units_ordered"),
                 F.sum(F.col("qty_received").cast("long")).alias("units_received"),
                 F.sum(F.col("qty_rejected").cast("long")).alias("units_rejected")))


WORKBENCH_COLUMNS: list[tuple[str, str]] = [
    ("record_type", "string"), ("fiscal_year", "string"), ("period_date", "date"), ("dc_id", "bigint"),
    ("dc_city", "string"), ("lane_id", "string"), ("city", "string"), ("point_order", "int"), ("map_point", "string"),
    ("lat", "double"), ("lon", "double"), ("category", "string"), ("supplier_id", "bigint"), ("supplier", "string"),
    ("sku", "string"),
    ("lines", "bigint"), ("otif_lines", "bigint"), ("ontime_lines", "bigint"), ("infull_lines", "bigint"),
    ("lead_days_sum", "bigint"), ("units_ordered", "bigint"), ("units_shipped", "bigint"),
    ("stock_value_days", "double"), ("days", "int"), ("cogs", "double"), ("carrying_cost", "double"),
    ("pos", "bigint"), ("pos_on_time", "bigint"), ("pos_in_full", "bigint"), ("po_lead_days_sum", "bigint"),
    ("po_quoted_days_sum", "bigint"), ("po_units_ordered", "bigint"), ("units_received", "bigint"),
    ("units_rejected", "bigint"),
    ("on_hand", "int"), ("reorder_point", "int"), ("cover_days", "double"), ("risk_score", "double"),
    ("risk_band", "string"), ("reasons", "string"), ("stockout_14d", "int"),
]
LANE_MEASURES = ["lines", "otif_lines", "ontime_lines", "infull_lines", "lead_days_sum", "units_ordered", "units_shipped"]


def typed(df: DataFrame, texts: set[str] = frozenset()) -> DataFrame:
    """Pad a branch to the declared 41 columns, typed; the ids in ``texts`` are text in this build's exports."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast("string" if c in texts else t).alias(c) for c, t in WORKBENCH_COLUMNS])


def fiscal_months(dim_date: DataFrame) -> DataFrame:
    return dim_date.select("month", "fiscal_year").distinct()


def anchors(lanes: DataFrame) -> DataFrame:
    """Each centre's map anchor: the smallest lane id of its own lanes."""
    return lanes.groupBy("dc_id").agg(F.min("lane_id").alias("anchor_lane"))


def workbench(b, scores: DataFrame) -> DataFrame:
    """Lanes (two map points per lane, measures on point 1), nodes, suppliers and snapshots in one
    long table. Dimension joins are to small tables (centres, cities, months, suppliers)."""
    fy = F.broadcast(fiscal_months(b.dim_date))
    dc = F.broadcast(b.dim_dc.select("dc_id", "dc_city", F.col("lat").alias("dc_lat"), F.col("lon").alias("dc_lon")))
    zone = F.broadcast(b.dim_zone.select("zone_id", "city", F.col("lat").alias("z_lat"), F.col("lon").alias("z_lon")))
    anchor = F.broadcast(anchors(b.mart_lanes))
    sup = b.dim_supplier.select("supplier_id", "supplier")

    points = F.explode(F.array(
        F.struct(F.lit(1).alias("point_order"), F.col("dc_city").alias("map_point"), F.col("dc_lat").alias("lat"),
                 F.col("dc_lon").alias("lon")),
        F.struct(F.lit(2).alias("point_order"), F.col("city").alias("map_point"), F.col("z_lat").alias("lat"),
                 F.col("z_lon").alias("lon"))))
    lanes = (b.mart_lanes.join(fy, "month").join(dc, "dc_id").join(zone, "zone_id")
             .select("*", points.alias("pt"))
             .select(F.lit("Lane").alias("record_type"), "fiscal_year", F.col("month").alias("period_date"), "dc_id",
                     "dc_city", "lane_id", "city", "pt.point_order", "pt.map_point", "pt.lat", "pt.lon", "category",
                     *[F.when(F.col("pt.point_order") == 1, F.col(m)).alias(m) for m in LANE_MEASURES]))
    nodes = (b.mart_nodes.join(F.broadcast(b.dim_date.select("date", "fiscal_year")), "date").join(dc, "dc_id")
             .join(anchor, "dc_id")
             .select(F.lit("Node").alias("record_type"), "fiscal_year", F.col("date").alias("period_date"), "dc_id",
                     "dc_city", F.col("anchor_lane").alias("lane_id"), F.lit(1).alias("point_order"),
                     F.col("dc_city").alias("map_point"), F.col("dc_lat").alias("lat"), F.col("dc_lon").alias("lon"),
                     "category", "stock_value_days", "days", "cogs", "carrying_cost"))
    suppliers = (b.mart_suppliers.join(fy, "month").join(dc, "dc_id").join(sup, "supplier_id")
                 .select(F.lit("Supplier").alias("record_type"), "fiscal_year", F.col("month").alias("period_date"),
                         "dc_id", "dc_city", "category", "supplier_id", "supplier", "pos", "pos_on_time", "pos_in_full",
                         "po_lead_days_sum", "po_quoted_days_sum", "po_units_ordered", "units_received",
                         "units_rejected"))
    score_cols = ["snapshot_date", "dc_id", "item_id", "risk_score", "risk_band"] + \
        (["reasons"] if "reasons" in scores.columns else [])
    snaps = (b.stockout_snapshots.join(scores.select(*score_cols), ["snapshot_date", "dc_id", "item_id"])
             .join(F.broadcast(b.dim_date.select(F.col("date").alias("snapshot_date"), "fiscal_year")), "snapshot_date")
             .join(dc, "dc_id").join(anchor, "dc_id").join(sup, "supplier_id")
             .select(F.lit("Snapshot").alias("record_type"), "fiscal_year", F.col("snapshot_date").alias("period_date"),
                     "dc_id", "dc_city", F.col("anchor_lane").alias("lane_id"), F.lit(1).alias("point_order"),
                     F.col("dc_city").alias("map_point"), F.col("dc_lat").alias("lat"), F.col("dc_lon").alias("lon"),
                     "category", "supplier_id", "supplier", F.col("item_id").alias("sku"), "on_hand", "reorder_point",
                     "cover_days", "risk_score", "risk_band", *(["reasons"] if "reasons" in score_cols else []),
                     "stockout_14d"))
    texts = {c for c, df in (("dc_id", b.dim_dc), ("supplier_id", b.dim_supplier)) if dict(df.dtypes)[c] == "string"}
    out = None
    for branch in (lanes, nodes, suppliers, snaps):
        out = typed(branch, texts) if out is None else out.unionByName(typed(branch, texts))
    return out
