"""The whole build as one lazy object: staging, model, features, scores, marts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from godown.config import RISK_HIGH, RISK_WATCH
from godown.operators.abc import abc_runs, class_on, mondays_and_months
from godown.operators.allocation import allocate
from godown.plans import features, sparse
from godown.plans.model import Build


def risk_band(score) -> F.Column:
    return F.when(score >= RISK_HIGH, "High").when(score >= RISK_WATCH, "Watch").otherwise("Low")


def baseline_scores(snapshots: DataFrame) -> DataFrame:
    """A fixed, SQL-expressible risk score: 1 - stock_to_reorder_point / 10 (in [0, 1]).

    Every score consumer (bands, gauges, watch lists, calibration, the long table) takes a scores
    frame; with this one they can be checked exactly against SQL. The trained model's scores
    (``godown.plans.ml``) have the same shape.
    """
    s = F.lit(1.0) - F.col("stock_to_reorder_point") / F.lit(10.0)
    return snapshots.select("snapshot_date", "dc_id", "item_id", s.alias("risk_score"),
                            risk_band(s).alias("risk_band"))


class Tables(Mapping):
    """Tables of a build by name, each built when it is first read: a check builds none that it does not read."""

    def __init__(self, build: Build, names: tuple[str, ...], changed: Mapping[str, DataFrame] | None = None):
        self._build, self._names, self._changed = build, names, changed or {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._changed[name] if name in self._changed else getattr(self._build, name)

    def __contains__(self, name: object) -> bool:
        return name in self._names

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def __or__(self, other: Mapping[str, DataFrame]) -> Tables:
        return Tables(self._build, (*self._names, *(n for n in other if n not in self._names)), self._changed | dict(other))


class Pipeline(Build):
    @cached_property
    def line_stock(self) -> DataFrame:
        """Units of each order line that the ledger's stock could serve, in the order of the orders."""
        before = F.lag("on_hand", 1, self.cal.opening_stock).over(Window.partitionBy("dc_id", "item_id").orderBy("date"))
        supply = self.stock_daily.select("date", "dc_id", "item_id", (before + F.col("accepted")).alias("available"))
        lines = self.fact_order_lines.select("order_id", "sku", "dc_id", "item_id", F.col("order_date").alias("date"), "qty_ordered")
        return self._cut(allocate(lines, supply, ["dc_id", "item_id", "date"], ["order_id", "sku"], "qty_ordered", "available", "qty_from_stock"))

    @cached_property
    def product_flows(self) -> DataFrame:
        return self._cut(sparse.daily_flows(self.fact_order_lines, self.stg_goods_receipts, self.received_orders, ["dc_id", "sku"], self.cal))

    @cached_property
    def product_runs(self) -> DataFrame:
        return sparse.stock_runs(self.product_flows, ["dc_id", "sku"], self.cal)

    @cached_property
    def product_snapshots(self) -> DataFrame:
        """Snapshots by centre and product, with each product's own supplier and class; from the sparse ledger."""
        stock = self._cut(sparse.states_on(self.product_flows, ["dc_id", "sku"], sparse.mondays(self.cal), self.cal))
        snaps = features.stockout_snapshots(stock.withColumnRenamed("sku", "item_id"), self.dim_product.drop("item_id").withColumnRenamed("sku", "item_id"),
                                            self.fact_purchase_orders, self.festival_days, self.cal)
        return self._cut(snaps.withColumnRenamed("item_id", "sku"))

    @cached_property
    def product_snapshot_runs(self) -> DataFrame:
        """``product_snapshots`` before it is spread over the days: a row a run of snapshots with one state, its product's class
        and supplier, and the features of the state. A product without a supplier has none, as there."""
        runs = sparse.state_runs(self.product_flows, ["dc_id", "sku"], sparse.mondays(self.cal), self.cal)
        items = self.dim_product.select("sku", "abc_class", "supplier_id").filter(F.col("supplier_id").isNotNull())
        return runs.join(items, "sku").select("*", *features.state_features())

    @cached_property
    def product_supplier_weeks(self) -> DataFrame:
        """A snapshot day and centre: the mean on-time rate of its snapshots' suppliers, each as often as it has series there."""
        series = self.product_flows.select("dc_id", "sku").distinct()
        of_supplier = (series.join(self.dim_product.select("sku", "supplier_id"), "sku").filter(F.col("supplier_id").isNotNull())
                       .groupBy("dc_id", "supplier_id").agg(F.count(F.lit(1)).alias("_series")))
        wanted = of_supplier.select("supplier_id").distinct().select("supplier_id", F.explode(sparse.mondays(self.cal)).alias("date"))
        rates = features.supplier_trailing(self.fact_purchase_orders, wanted).select("date", "supplier_id", "supplier_on_time_180d")
        return (rates.join(of_supplier, "supplier_id").groupBy("date", "dc_id")
                .agg((F.sum(F.col("_series") * F.col("supplier_on_time_180d")) / F.sum("_series")).alias("supplier_on_time_180d")))

    @cached_property
    def stockout_snapshots(self) -> DataFrame:
        return self._cut(features.stockout_snapshots(self.stock_daily, self.dim_item, self.fact_purchase_orders,
                                                     self.festival_days, self.cal))

    @cached_property
    def product_abc_runs(self) -> DataFrame:
        """Each product's class set anew on the first of every month, from the value shipped by then."""
        return self._cut(abc_runs(self.fact_order_lines, "sku", "ship_date", "cogs", mondays_and_months(self.cal.start, self.cal.end)[1]))

    @cached_property
    def snapshots_as_of(self) -> DataFrame:
        """The snapshots with each item's class from the value shipped up to the snapshot's day: nothing later is known."""
        runs = abc_runs(self.fact_order_lines, "item_id", "ship_date", "cogs", mondays_and_months(self.cal.start, self.cal.end)[0])
        return self._cut(class_on(self.stockout_snapshots, runs, "item_id", "snapshot_date"))

    @cached_property
    def stockout_scores(self) -> DataFrame:
        return self._keep(baseline_scores(self.stockout_snapshots))

    @cached_property
    def training(self):
        """(metric rows, chosen model, fitted models with their scored test rows); trained once a build."""
        from godown.plans import ml
        return ml.train_and_evaluate(self.stockout_snapshots, self.cal)

    @cached_property
    def trained_scores(self) -> DataFrame:
        """Scores, bands and reasons of the chosen model for every snapshot."""
        from godown.plans import ml
        return self._cut(ml.stockout_scores(self.stockout_snapshots, self.training[1], self.cal))

    @cached_property
    def trained_workbench(self) -> DataFrame:
        """The long table with the chosen model's scores and reasons."""
        return self._store(self.workbench(self.trained_scores))

    @cached_property
    def mart_lanes(self) -> DataFrame:
        from godown.plans import marts
        return self._keep(marts.mart_lanes(self.fact_order_lines))

    @cached_property
    def mart_nodes(self) -> DataFrame:
        from godown.plans import marts
        return self._keep(marts.mart_nodes(self.fact_inventory_daily, self.fact_order_lines))

    @cached_property
    def mart_suppliers(self) -> DataFrame:
        from godown.plans import marts
        return self._store(marts.mart_suppliers(self.fact_purchase_orders, self.stg_products))

    @cached_property
    def sc_workbench(self) -> DataFrame:
        return self._store(self.workbench())

    def tables(self) -> Tables:
        """The tables the checks read, by name."""
        return Tables(self, ("dim_supplier", "stg_sales_orders", "stg_shipments", "dim_zone", "stg_order_lines",
                             "fact_inventory_daily", "stg_goods_receipts", "stg_purchase_orders", "stg_products",
                             "fact_purchase_orders", "dim_product", "fact_order_lines", "stockout_snapshots", "stockout_scores",
                             "sc_workbench", "line_stock"))

    def workbench(self, scores: DataFrame | None = None) -> DataFrame:
        from godown.plans import marts
        return marts.workbench(self, scores if scores is not None else self.stockout_scores)
