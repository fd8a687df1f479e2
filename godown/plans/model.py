"""Dimensions and facts: date dimension, ABC classes, order-line, order, purchase-order, daily demand
and daily stock facts.

``Build`` wires the staged exports into every derived table; each property is a DataFrame. Reused frames are the
same Python objects, so Spark reuses their exchanges inside one plan. The calendar (first and last day of any
flow), prefix sums, the ledger and the snapshots are computed when they are first asked for; all else runs
with the action.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from godown.config import CARRY_RATE, DEFAULT, Calendar
from godown.functions.dates import fiscal_year_label, month_start, week_start
from godown.operators.abc import abc_classes
from godown.operators.intervals import open_deltas
from godown.operators.replay import replay
from godown.sources import driver_tables
from godown.session import cut_in_buckets, cut_lineage, forget_buckets, forget_shuffles
from godown.sources.exports import stage

SERIES = ["dc_id", "item_id"]


# ------------------------------------------------------------------------------------------ dimensions
def date_dimension(span: DataFrame, fiscal_start_month: int = DEFAULT.fiscal_start_month) -> DataFrame:
    """One row per day of the whole months that ``span`` (first_day, last_day) covers: week, month, fiscal year."""
    whole = F.sequence(F.trunc("first_day", "month"), F.last_day("last_day"))
    days = span.filter(F.col("first_day").isNotNull()).select(F.explode(whole).alias("date"))
    return days.select("date", week_start(F.col("date")).alias("week_start"), month_start(F.col("date")).alias("month"),
                       fiscal_year_label(F.col("date"), fiscal_start_month).alias("fiscal_year"))


def festival_days(spark: SparkSession, cal: Calendar = DEFAULT) -> DataFrame:
    """Inline relation of festival days (a short literal list)."""
    return spark.createDataFrame([(d,) for d in cal.festival_days], "day date")


def product_value(products: DataFrame, order_lines: DataFrame, key: str = "sku") -> DataFrame:
    """Value shipped per product over the whole period (products without sales have null)."""
    sold = order_lines.groupBy("sku").agg(F.sum(F.col("qty_shipped").cast("long")).alias("_units"))
    cols = ["sku", "unit_cost"] + ([key] if key != "sku" else [])
    return (products.select(*cols).join(sold, "sku", "left")
            .groupBy(key).agg(F.sum(F.col("_units") * F.col("unit_cost")).alias("value")))


def dim_product(products: DataFrame, order_lines: DataFrame) -> DataFrame:
    classes = abc_classes(product_value(products, order_lines), "sku").select("sku", "abc_class")
    return products.join(classes, "sku")


def dim_item(products: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Stock-keeping item (brand x type): category, supplier of its first part, cost, ABC class.

    Item cost is the whole-cent average of its parts' costs.
    """
    items = products.groupBy("item_id").agg(
        F.min("category").alias("category"),
        F.min_by("supplier_id", "sku").alias("supplier_id"),
        F.min("case_qty").alias("case_qty"),
        ((F.sum((F.col("unit_cost") * 100).cast("long")) / F.count(F.lit(1))).cast("long") / 100)
        .cast("decimal(18,2)").alias("unit_cost"))
    classes = abc_classes(product_value(products, order_lines, "item_id"), "item_id").select("item_id", "abc_class")
    return items.join(classes, "item_id")


# ------------------------------------------------------------------------------------------ facts
def fact_order_lines(orders: DataFrame, shipments: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """OTIF per order line: on time = delivered by the promise, in full = shipped all it ordered."""
    on_time = F.col("delivered_date") <= F.col("promised_date")
    in_full = F.col("qty_shipped") == F.col("qty_ordered")
    return (orders.join(shipments, "order_id").join(lines, "order_id")
            .join(products.select("sku", "category", "item_id", "unit_cost"), "sku")
            .select("order_id", "dc_id", "zone_id", "sku", "item_id", "category", "order_date", "promised_date",
                    "ship_date", "delivered_date", "carrier", "qty_ordered", "qty_shipped",
                    (F.col("qty_ordered") * F.col("unit_cost")).alias("value_ordered"),
                    (F.col("qty_shipped") * F.col("unit_cost")).alias("cogs"),
                    on_time.alias("on_time"), in_full.alias("in_full"), (on_time & in_full).alias("otif"),
                    F.datediff("delivered_date", "order_date").alias("lead_days")))


def fact_orders(order_lines: DataFrame) -> DataFrame:
    """Whole-order rollup: all lines on time / in full, line counts."""
    return order_lines.groupBy("order_id", "dc_id", "zone_id", "order_date", "promised_date", "ship_date",
                               "delivered_date", "carrier").agg(
        F.any_value("lead_days").alias("lead_days"), F.bool_and("on_time").alias("on_time"),
        F.bool_and("in_full").alias("in_full"), F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("otif").cast("int")).alias("otif_lines"))


def received_orders(pos: DataFrame, receipts: DataFrame, suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Receipts summed per PO (first/last date, deliveries); on time and in full stay null until received. ``receipts`` lists the
    day and the accepted units of each receipt of the PO, so that the ledger need not join them again.

    Receipts are met first, by po_id, with the columns of the export alone; suppliers and products come after.
    """
    r = receipts.groupBy("po_id").agg(
        F.min("received_date").alias("first_received"), F.max("received_date").alias("last_received"),
        F.count(F.lit(1)).alias("deliveries"), F.sum("qty_received").alias("qty_received"),
        F.sum("qty_rejected").alias("qty_rejected"),
        F.collect_list(F.struct(F.col("received_date").alias("date"), (F.col("qty_received") - F.col("qty_rejected")).alias("units"))).alias("receipts"))
    return (pos.join(r, "po_id", "left")
            .join(suppliers.select("supplier_id", "quoted_lead_days"), "supplier_id")
            .join(products.select("sku", "item_id", "unit_cost"), "sku")
            .select("po_id", "supplier_id", "dc_id", "sku", "item_id", "order_date", "promised_date", "qty_ordered",
                    "first_received", "last_received", "deliveries", "qty_received", "qty_rejected",
                    "quoted_lead_days",
                    F.datediff("last_received", "order_date").alias("lead_days"),
                    (F.col("last_received") <= F.col("promised_date")).alias("on_time"),
                    (F.col("qty_received") >= F.col("qty_ordered")).alias("in_full"),
                    (F.col("qty_received") * F.col("unit_cost")).alias("value_received"), "receipts"))


def fact_purchase_orders(pos: DataFrame, receipts: DataFrame, suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """``received_orders`` without the lists of receipts."""
    return received_orders(pos, receipts, suppliers, products).drop("receipts")


def accepted_units(receipts: DataFrame, pos: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of the purchase order, day and accepted units of each receipt. Receipts find their order by po_id, unless ``pos`` lists
    them (``received_orders``)."""
    if "receipts" in pos.columns:
        return pos.select(*keys, F.inline("receipts"))
    return receipts.join(pos.select("po_id", *keys), "po_id").select(
        *keys, F.col("received_date").alias("date"), (F.col("qty_received") - F.col("qty_rejected")).alias("units"))


def accepted_daily(receipts: DataFrame, pos: DataFrame, keys: list[str]) -> DataFrame:
    """``accepted_units`` summed by ``keys`` and day: of listed receipts only the sums move."""
    return accepted_units(receipts, pos, keys).groupBy(*keys, "date").agg(F.sum("units").cast("long").alias("accepted"))


def series_grid(dcs: DataFrame, items: DataFrame, cal: Calendar, partitions: int | None = None) -> DataFrame:
    """Dense calendar per stock series (centre x item).

    The centres travel as one array value, so every item makes its own series and days (generators, no join, and
    no broadcast of the items).
    """
    series = items.select("item_id", F.explode(dcs.agg(F.collect_set("dc_id")).scalar()).alias("dc_id")).select(*SERIES)
    if partitions:
        # only the series rows move; each partition generates its own days, so the dense grid is
        # born hash-partitioned on the series key
        series = series.repartition(partitions, *SERIES)
    return (series
            .select(*SERIES, F.explode(F.sequence(F.lit(cal.start), F.lit(cal.end))).alias("date")))


def stock_daily(grid: DataFrame, lines: DataFrame, receipts: DataFrame, pos: DataFrame, items: DataFrame,
                cal: Calendar) -> DataFrame:
    """Dense daily flows and the replayed stock ledger per series, in one partitioning.

    demand = units ordered (by order date), accepted = received - rejected (by receipt date),
    open_po_units = units on purchase orders placed and not yet fully received at the end of the day.
    The ledger: opening stock, lost-sales replay, and a reorder point of 8/28 of the last 28 days'
    demand (whole units).
    """
    zero = F.lit(0).cast("long")
    demand = (lines.groupBy(*SERIES, F.col("order_date").alias("date"))
              .agg(F.sum("qty_ordered").cast("long").alias("demand"), F.sum("qty_shipped").cast("long").alias("line_shipped")))
    accepted = accepted_daily(receipts, pos, SERIES)
    po_open = open_deltas(pos, SERIES, "order_date", "last_received", "qty_ordered")

    def shaped(df, **cols):
        names = ["demand", "line_shipped", "accepted", "open_delta"]
        return df.select(*SERIES, "date", *[(F.col(n) if n in cols else zero).alias(n) for n in names])

    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the pre-aggregated flows are the only rows shuffled; the grid already sits in the same
    # hash partitioning (see series_grid), so the union, the sum and the windows need no exchange
    moved = (shaped(demand, demand=1, line_shipped=1)
             .unionByName(shaped(accepted, accepted=1))
             .unionByName(shaped(po_open, open_delta=1))
             # a flow outside a given calendar has no stock row to land on: an error, never a dropped row
             .withColumn("date", F.when(F.col("date").between(F.lit(cal.start), F.lit(cal.end)), F.col("date"))
                         .otherwise(F.raise_error(F.concat(F.lit("a flow lies outside the calendar: "), F.col("date").cast("string")))))
             .repartition(n, *SERIES))
    flows = (shaped(grid.select(*SERIES, "date")).unionByName(moved)
             .groupBy(*SERIES, "date")
             .agg(*[F.sum(n).alias(n) for n in ["demand", "line_shipped", "accepted", "open_delta"]]))
    led = replay(flows, SERIES, "date", "accepted", "demand", cal.opening_stock)
    return with_trailing_columns(led)


def with_trailing_columns(led: DataFrame, horizon: int = 14) -> DataFrame:
    """Reorder point, open PO units, 28/7-row demand mean, 28-row sd and the forward out-of-stock
    flag per series and day, from running sums and row offsets only.

    A sliding frame re-reads its 28 rows for every row; a trailing-rows sum is instead the running
    sum minus the running sum 28 rows back (exact in integers), so every column costs O(1) a row.
    The snapshot features share this (dc_id, item_id) partitioning and date order, so they are made
    in the same pass over the dense grid. Row offsets need a dense series: one row a day.
    """
    w = Window.partitionBy(*SERIES).orderBy("date")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = F.col("demand").cast("long")
    x = led.select("*", F.sum(d).over(upto).alias("_cs"), F.sum(d * d).over(upto).alias("_cs2"),
                   F.row_number().over(w).alias("_rn"),
                   F.sum("open_delta").over(upto).alias("open_po_units"),
                   F.sum((F.col("on_hand") <= 0).cast("long")).over(upto).alias("_oos"))

    def back(c: str, n: int):
        return F.col(c) - F.lag(c, n, 0).over(w)

    n28, n7 = F.least(F.col("_rn"), F.lit(28)), F.least(F.col("_rn"), F.lit(7))
    s28, s7, q28 = back("_cs", 28), back("_cs", 7), back("_cs2", 28)
    # out of stock on any of the next ``horizon`` rows; no following row at all gives null
    ahead = F.coalesce(F.lead("_oos", horizon).over(w), F.max("_oos").over(whole)) - F.col("_oos")
    out_next = F.when(F.lead("_oos", 1).over(w).isNotNull(), ahead > 0)
    y = x.select("*", s28.alias("_s28"), s7.alias("_s7"), q28.alias("_q28"), n28.alias("_n28"), n7.alias("_n7"),
                 out_next.alias("out_next_14d"))
    var_num = (F.col("_n28") * F.col("_q28") - F.col("_s28") * F.col("_s28")).cast("double")
    return y.select(
        *[c for c in led.columns], "open_po_units",
        F.expr("CAST((_s28 * 8) div 28 AS INT)").alias("reorder_point"),
        (F.col("_s28") / F.col("_n28")).alias("demand_28d"),
        (F.col("_s7") / F.col("_n7")).alias("demand_7d"),
        (F.sqrt(F.greatest(var_num, F.lit(0.0))) / F.col("_n28")).alias("demand_sd_28d"),
        "out_next_14d")


def fact_inventory_daily(stock: DataFrame, items: DataFrame, carry_rate: float = CARRY_RATE) -> DataFrame:
    """Stock value and state per series and day."""
    value = F.col("on_hand") * F.col("unit_cost")
    return (stock.join(items.select("item_id", "category", "unit_cost"), "item_id")
            .select("date", "dc_id", "item_id", "category", "on_hand", "reorder_point",
                    value.alias("stock_value"),
                    (value.cast("double") * carry_rate / 365).alias("carrying_cost"),
                    (F.col("on_hand") <= 0).alias("out_of_stock"),
                    (F.col("on_hand") <= F.col("reorder_point")).alias("below_reorder_point")))


# ------------------------------------------------------------------------------------------ build
class Build:
    """All staged exports and derived tables of one build, as lazy DataFrames.

    Tables with several consumers are kept once per build, as the reference materialises every
    table. Those that grow with the order lines, the daily ledger and the snapshots are written to the
    shared checkpoint folder, which also cuts their lineage: held in memory, they would take it from
    sorts and joins, which then spill. Small ones (bounded by calendar, items and centres) and exports
    that a caller gives are persisted. Staging is a projection and is done anew by each reader of a
    written export. ``materialize=False`` keeps everything as one lazy plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, cal: Calendar | None = None,
                 exports: dict[str, DataFrame] | None = None, materialize: bool = True):
        self.spark, self.sf_dir, self._cal = spark, sf_dir, cal
        self._exports = exports
        self.materialize = materialize
        self._kept: list[DataFrame] = []
        self._bucketed: list[DataFrame] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(df)
        return df

    def _cut(self, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        df = cut_lineage(df)
        forget_shuffles(self.spark)
        return df

    def _store(self, df: DataFrame, by: str | None = None, dealt: bool = False) -> DataFrame:
        """A table that grows with the input, written small; in buckets of ``by``, if its readers join it by that key."""
        if not self.materialize:
            return df
        if by is None:
            df = cut_lineage(df, "zstd")
        else:
            df = cut_in_buckets(df if dealt else df.repartition(by), by, "zstd")
            self._bucketed.append(df)
        forget_shuffles(self.spark)
        return df

    def release(self) -> None:
        """Unpersist everything this build kept."""
        for df in self._kept:
            df.unpersist()
        for df in self._bucketed:
            forget_buckets(df)
        self._kept.clear()
        self._bucketed.clear()

    @cached_property
    def span(self) -> DataFrame:
        """One row: the first and the last day of any order, shipment or receipt."""
        def ends(df, *days):
            return df.select(F.least(*days).alias("first_day"), F.greatest(*days).alias("last_day"))
        seen = (ends(self.stg_sales_orders, "order_date", "order_date")
                .unionByName(ends(self.stg_shipments, "ship_date", "delivered_date"))
                .unionByName(ends(self.stg_goods_receipts, "received_date", "received_date")))
        return self._cut(seen.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")))

    @cached_property
    def cal(self) -> Calendar:
        """The given calendar, or the whole months of ``span``."""
        if self._cal is not None:
            return self._cal
        first, last = self.span.first()
        return Calendar.covering(first, last) if first else DEFAULT

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        if self._exports is not None:
            return self._exports
        return driver_tables.raw_exports(self.spark, self.sf_dir, keep=self._store)

    def staged(self, name: str) -> DataFrame:
        # exports whose raw frame is already written need no second copy
        df = stage(name, self.raw[name])
        written = self._exports is None and name not in ("warehouses", "delivery_zones")
        return df if written or name in ("order_lines", "products") else self._keep(df)

    # staging
    @cached_property
    def stg_warehouses(self): return self.staged("warehouses")
    @cached_property
    def stg_zones(self): return self.staged("delivery_zones")
    @cached_property
    def stg_suppliers(self): return self.staged("suppliers")
    @cached_property
    def stg_products(self): return self.staged("products")
    @cached_property
    def stg_sales_orders(self): return self.staged("sales_orders")
    @cached_property
    def stg_order_lines(self): return self.staged("order_lines")
    @cached_property
    def stg_shipments(self): return self.staged("shipments")
    @cached_property
    def stg_purchase_orders(self): return self.staged("purchase_orders")
    @cached_property
    def stg_goods_receipts(self): return self.staged("goods_receipts")

    # dimensions
    @cached_property
    def dim_date(self):
        given = self._cal
        span = self.span if given is None else self.spark.createDataFrame(
            [(given.start, given.end)], "first_day date, last_day date")
        return date_dimension(span, self.cal.fiscal_start_month)
    @cached_property
    def dim_dc(self): return self.stg_warehouses
    @cached_property
    def dim_zone(self): return self.stg_zones
    @cached_property
    def dim_supplier(self): return self.stg_suppliers
    @cached_property
    def dim_product(self): return self._store(dim_product(self.stg_products, self.stg_order_lines))
    @cached_property
    def dim_item(self): return self._keep(dim_item(self.stg_products, self.stg_order_lines))
    @cached_property
    def festival_days(self): return festival_days(self.spark, self.cal)

    # facts
    @cached_property
    def fact_order_lines(self):
        return self._store(fact_order_lines(self.stg_sales_orders, self.stg_shipments, self.stg_order_lines,
                                            self.stg_products))
    @cached_property
    def fact_orders(self): return self._store(fact_orders(self.fact_order_lines))
    @cached_property
    def received_orders(self):
        return self._store(received_orders(self.stg_purchase_orders, self.stg_goods_receipts, self.stg_suppliers,
                                           self.stg_products))
    @cached_property
    def fact_purchase_orders(self): return self.received_orders.drop("receipts")
    @cached_property
    def stock_daily(self):
        grid = series_grid(self.dim_dc, self.stg_products.select("item_id").distinct(), self.cal,
                           int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self._cut(stock_daily(grid, self.fact_order_lines, self.stg_goods_receipts, self.received_orders,
                                     self.dim_item, self.cal))
    @cached_property
    def stg_inventory(self):
        """The stock export, where there is one, else the replayed ledger."""
        if "inventory_daily" in self.raw:
            return self.staged("inventory_daily")
        return self.stock_daily.select(F.col("date").alias("stock_date"), "dc_id", "item_id", "on_hand", "reorder_point")
    @cached_property
    def fact_demand_daily(self):
        return self.stock_daily.select("date", "dc_id", "item_id", F.col("demand").alias("qty_ordered"),
                                       F.col("line_shipped").alias("qty_shipped"))
    @cached_property
    def fact_inventory_daily(self): return self._keep(fact_inventory_daily(self.stg_inventory.withColumnRenamed("stock_date", "date"), self.dim_item))

