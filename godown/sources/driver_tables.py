"""Adapter: the driver's TPC-H-like parquet tables as the ten raw exports of a distributor.

Only integer and decimal arithmetic is used, so an independent SQL engine computes the same rows.

Mapping (region = distribution centre, nation = delivery city, part = product, orders = sales orders):
  warehouses       dc_id = r_regionkey, lat 12 + 4.0 r, lon 72 + 3.5 r
  delivery_zones   zone_id = n_nationkey, served by its region, lat 8 + 1.1 n, lon 70 + (7 n mod 25),
                   standard transit 1 + n mod 3 days, road_km = rounded road distance to the centre
  suppliers        raw name s_name + ' Foods FMCG'; every seventh supplier (key mod 7 = 0) is typed in
                   capitals with two trailing spaces; quoted lead 5 + key mod 6 days; hub at its nation
  products         sku = p_partkey, category = p_type, stock item = brand/type, unit cost = retail price,
                   case of 6 (1 + key mod 4), supplier = key mod (number of suppliers)
  sales orders     order date = o_orderdate, promised = order date + 1 + transit days
  shipments        ship = order date (+1 when key mod 3 = 0); delivered = ship + transit (+2 when key mod 5 = 0)
  order lines      lineitem summed by (order, part); a returned line ('R') ships a quarter short
  purchase orders  one per order line, po_id = 'order_id-sku' (a pair, so that no two collide), placed on the
                   order date with the product's supplier, promised after the quoted lead; dates written day first
  goods receipts   by the number k = order_id * 1,000,000 + sku, of which only remainders are formed: none when
                   k mod 101 = 0; split in two when k mod 7 = 0; 90% when mod 11 = 0; 5% rejected when mod 13 = 0
The stock ledger (inventory_daily) is replayed from these flows by ``godown.plans.stock``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from godown.functions.geo import road_km

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
PO_RULE_MULTIPLIER = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(x: str):
    return F.lit(Decimal(x))


def _coord(base: str, step: str, key) -> F.Column:
    # exact decimal arithmetic, then one rounding to double (same double in any engine)
    return (_dec(base) + _dec(step) * key).cast("double")


def warehouses(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(r.alias("dc_id"), F.col("r_name").alias("dc_city"),
                         _coord("12", "4.0", r).alias("lat"), _coord("72", "3.5", r).alias("lon"))


def delivery_zones(nation: DataFrame, region: DataFrame) -> DataFrame:
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    lat, lon = _coord("8", "1.1", n), (F.lit(70.0) + (n * 7 % 25).cast("double"))
    dc_lat, dc_lon = _coord("12", "4.0", r), _coord("72", "3.5", r)
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(n.alias("zone_id"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                    lat.alias("lat"), lon.alias("lon"), r.alias("serving_dc"),
                    F.round(road_km(lat, lon, dc_lat, dc_lon), 0).alias("road_km"),
                    (n % 3 + 1).alias("std_transit_days")))


def suppliers(supplier: DataFrame, nation: DataFrame, region: DataFrame, part: DataFrame) -> DataFrame:
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    name = F.concat(F.col("s_name"), F.lit(" Foods FMCG"))
    raw_name = F.when(k % 7 == 0, F.concat(F.upper(name), F.lit("  "))).otherwise(name)
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "n_name", "r_name")
    # a supplier's category is the type of its first product (part key = supplier key)
    first_part = part.select(F.col("p_partkey").alias("s_suppkey"), F.col("p_type"))
    return (supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey, "left")
            .join(first_part, "s_suppkey", "left")
            .select(k.alias("supplier_id"), raw_name.alias("supplier"), F.col("p_type").alias("category"),
                    F.col("n_name").alias("hub"), F.col("r_name").alias("state"),
                    _coord("8.5", "1.1", nk).alias("lat"), (F.lit(70.5) + (nk * 7 % 25).cast("double")).alias("lon"),
                    (k % 6 + 5).cast("int").alias("quoted_lead_days")))


def products(part: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    n_suppliers = supplier.select(F.count(F.lit(1))).scalar()
    cost = F.col("p_retailprice").cast("decimal(18,2)")
    return part.select(
        k.alias("sku"), F.col("p_type").alias("category"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("item_id"),
        (k % n_suppliers).alias("supplier_id"), cost.alias("unit_cost"),
        (cost * _dec("1.25")).cast("decimal(18,2)").alias("unit_price"),
        ((k % 4 + 1) * 6).cast("int").alias("case_qty"))


def sales_orders_and_shipments(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order with the order, promise, shipment and delivery (customer's nation = city)."""
    o = F.col("o_orderkey")
    transit = F.col("c_nationkey") % 3 + 1
    order_date = F.to_date(F.col("o_orderdate"))
    ship = F.date_add(order_date, F.when(o % 3 == 0, 1).otherwise(0))
    return (orders.select("o_orderkey", "o_custkey", "o_orderdate")
            .join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
            .select(o.alias("order_id"), F.col("c_nationkey").alias("zone_id"),
                    order_date.alias("order_date"), F.date_add(order_date, transit + 1).alias("promised_date"),
                    ship.alias("ship_date"),
                    F.date_add(ship, transit + F.when(o % 5 == 0, 2).otherwise(0)).alias("delivered_date"),
                    F.concat(F.lit("C"), (o % 3).cast("string")).alias("carrier")))


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Lines summed to (order, part). Lineitem is hash-partitioned on the order key once: the sum
    and the later join to the order header both reuse that partitioning."""
    q = F.col("l_quantity").cast("int")
    shipped = q - F.when(F.col("l_returnflag") == "R", F.floor(q / 4).cast("int")).otherwise(0)
    return (lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
            .repartition("l_orderkey")
            .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"))
            .agg(F.sum(q).cast("int").alias("qty_ordered"), F.sum(shipped).cast("int").alias("qty_shipped")))


def purchase_orders_typed(lines: DataFrame, headers: DataFrame, products_: DataFrame,
                          suppliers_: DataFrame) -> DataFrame:
    """One purchase order per order line, typed (dates as DATE), with the supplier's quoted lead."""
    lead = suppliers_.select("supplier_id", "quoted_lead_days")
    return (lines.join(headers.select("order_id", "dc_id", "order_date"), "order_id")
            .join(products_.select("sku", "supplier_id"), "sku")
            .join(lead, "supplier_id")
            .select(F.concat_ws("-", F.col("order_id").cast("string"), F.col("sku").cast("string")).alias("po_id"),
                    "order_id", "supplier_id", "dc_id", "sku", "order_date",
                    F.date_add("order_date", F.col("quoted_lead_days")).alias("promised_date"),
                    "qty_ordered", "quoted_lead_days"))


def _po_mod(n: int) -> F.Column:
    """(order_id * PO_RULE_MULTIPLIER + sku) mod n, from the parts (no product that could overflow)."""
    return (F.col("order_id") % n * (PO_RULE_MULTIPLIER % n) + F.col("sku") % n) % n


def goods_receipts(po: DataFrame) -> DataFrame:
    """One or two receipts per purchase order, generated in a single pass (array + explode)."""
    q, lead = F.col("qty_ordered"), F.col("quoted_lead_days")
    p4 = _po_mod(4).cast("int")
    split = _po_mod(7) == 0
    first_qty = (F.when(split, F.floor(q / 2)).when(_po_mod(11) == 0, F.floor(q * 9 / 10)).otherwise(q)).cast("int")
    first = F.struct(F.date_add("order_date", lead - 1 + p4).alias("received_date"), first_qty.alias("qty"))
    second = F.when(split, F.struct(F.date_add("order_date", lead + 2 + p4).alias("received_date"),
                                    (q - F.floor(q / 2)).cast("int").alias("qty")))
    r = (po.filter(_po_mod(101) != 0)
         .select("po_id", (_po_mod(13) == 0).alias("rejects"), F.explode(F.filter(F.array(first, second), lambda x: x.isNotNull())).alias("r")))
    got = F.col("r.qty")
    return r.select("po_id", F.col("r.received_date").alias("received_date"), got.alias("qty_received"),
                    F.when(F.col("rejects"), F.floor(got / 20)).otherwise(0).cast("int").alias("qty_rejected"))


def raw_exports(spark: SparkSession, sf_dir: str, keep=lambda df, by=None, dealt=False: df) -> dict[str, DataFrame]:
    """The raw exports (except the stock ledger) built from the driver tables.

    ``keep`` is applied to the intermediates two exports share (order headers, lines, products, suppliers, purchase
    orders), so a build that writes them computes each once; ``by`` is the key by which all their readers join them, ``dealt``
    whether the rows already lie by it."""
    t = {name: read(spark, sf_dir, name) for name in DRIVER_TABLES}
    wh = warehouses(t["region"])
    zones = delivery_zones(t["nation"], t["region"])
    sups = suppliers(t["supplier"], t["nation"], t["region"], t["part"])
    prods = products(t["part"], t["supplier"])
    headers = sales_orders_and_shipments(t["orders"], t["customer"])
    # the serving centre of each order comes from its city; the zone table has one row per nation
    headers = keep(headers.join(F.broadcast(zones.select("zone_id", F.col("serving_dc").alias("dc_id"))), "zone_id"), "order_id")
    lines = keep(order_lines(t["lineitem"]), "order_id", dealt=True)
    prods, sups = keep(prods), keep(sups)
    po = keep(purchase_orders_typed(lines, headers, prods, sups.select("supplier_id", "quoted_lead_days")), "po_id")
    day_first = "dd/MM/yyyy"
    return {
        "warehouses": wh,
        "delivery_zones": zones,
        "suppliers": sups,
        "products": prods,
        "sales_orders": headers.select("order_id", "zone_id", "dc_id", "order_date", "promised_date"),
        "shipments": headers.select("order_id", "ship_date", "delivered_date", "carrier"),
        "order_lines": lines,
        "purchase_orders": po.select("po_id", "supplier_id", "dc_id", "sku",
                                     F.date_format("order_date", day_first).alias("order_date"),
                                     F.date_format("promised_date", day_first).alias("promised_date"),
                                     "qty_ordered"),
        "goods_receipts": goods_receipts(po),
    }
