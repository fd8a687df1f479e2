"""Sparse ledger against the dense one, line allocation against a walk, and a whole build from text exports."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from godown.config import Calendar
from godown.operators.allocation import allocate
from godown.plans import checks, model, sparse
from godown.plans.build import Pipeline
from godown.sources.exports import EXPORTS, read_text_csv

KEYS = ["dc_id", "item_id"]


def flows(spark, seed=3):
    """Lines, purchase orders and receipts of a few series, one of them with a single flow, over four months."""
    rnd = random.Random(seed)
    cal = Calendar.covering(date(2000, 1, 3), date(2000, 4, 28))
    day = lambda k: cal.start + timedelta(days=k)
    lines, pos, receipts = [], [], []
    for s in range(6):
        for k in range(rnd.choice([1, 20, 60])):
            lines.append((0, f"i{s}", day(rnd.randint(0, 120)), rnd.randint(1, 30), 0))
        for k in range(rnd.choice([0, 10])):
            placed, came = rnd.randint(0, 100), rnd.choice([None, rnd.randint(1, 20)])
            pos.append((f"{s}-{k}", 0, f"i{s}", day(placed), None if came is None else day(placed + came), rnd.randint(1, 60)))
            if came is not None:
                receipts.append((f"{s}-{k}", day(placed + came), pos[-1][5], rnd.choice([0, 0, 1])))
    lines += [(0, "i9", cal.start, 60, 0), (0, "i9", cal.end, 1, 0), (0, "i8", cal.end, 50, 0)]
    return cal, (spark.createDataFrame(lines, "dc_id int, item_id string, order_date date, qty_ordered int, qty_shipped int"),
                 spark.createDataFrame(receipts, "po_id string, received_date date, qty_received int, qty_rejected int"),
                 spark.createDataFrame(pos, "po_id string, dc_id int, item_id string, order_date date, last_received date, qty_ordered int"))


def test_sparse_states_are_those_of_the_dense_ledger(spark):
    cal, (lines, receipts, pos) = flows(spark)
    items, dcs = lines.select("item_id").distinct(), spark.createDataFrame([(0,)], "dc_id int")
    dense = model.stock_daily(model.series_grid(dcs, items, cal, 4), lines, receipts, pos, items, cal)
    every = F.sequence(F.lit(cal.start), F.lit(cal.end))
    small = sparse.daily_flows(lines, receipts, pos, KEYS, cal)
    got = sparse.states_on(small, KEYS, every, cal)
    columns = ["dc_id", "item_id", "date", "demand", "on_hand", "open_po_units", "reorder_point", "demand_28d", "demand_7d", "demand_sd_28d", "out_next_14d"]
    want = sorted(map(tuple, dense.select(*columns).collect()))
    assert sorted(map(tuple, got.select(*columns).collect())) == want and len(want) == 8 * 121
    some = sparse.states_on(small, KEYS, sparse.mondays(cal), cal)
    mondays = {r for r in want if r[2].weekday() == 0 and r[2] >= cal.snapshot_from}
    assert set(map(tuple, some.select(*columns).collect())) == mondays and mondays
    # The runs cover the calendar, and each says what the dense ledger says on every one of its days.
    by_day = {}
    for r in sparse.stock_runs(small, KEYS, cal).collect():
        for k in range((r.valid_to - r.valid_from).days + 1):
            assert by_day.setdefault((r.item_id, r.valid_from + timedelta(days=k)), (r.on_hand, r.open_po_units)) == (r.on_hand, r.open_po_units)
    assert by_day == {(r[1], r[2]): (r[4], r[5]) for r in want}
    assert sparse.states_on(small.filter("false"), KEYS, every, cal).collect() == []


def test_a_flow_outside_the_calendar_is_an_error(spark):
    cal, (lines, receipts, pos) = flows(spark)
    late = lines.unionByName(lines.limit(1).withColumn("order_date", F.lit(date(2009, 1, 1))))
    with pytest.raises(Exception, match="outside the calendar"):
        sparse.daily_flows(late, receipts, pos, KEYS, cal).collect()


def test_allocation_against_a_walk(spark):
    rnd = random.Random(5)
    requests = [(rnd.randint(0, 5), k, rnd.randint(0, 9)) for k in range(200)]
    supply = {0: 0, 1: 1000, 2: 40, 3: -3, 4: None}  # 5: no row
    got = allocate(spark.createDataFrame(requests, "key int, place int, qty long"),
                   spark.createDataFrame(list(supply.items()), "key int, units long"), ["key"], ["place"], "qty", "units", "served")
    left, want = defaultdict(int, {k: max(v or 0, 0) for k, v in supply.items()}), {}
    for key, place, qty in sorted(requests, key=lambda r: r[1]):
        want[place] = min(qty, left[key])
        left[key] -= want[place]
    assert {r.place: r.served for r in got.collect()} == want and got.columns == ["key", "place", "qty", "served"]


def test_a_changed_line_breaks_the_balance(build):
    t = build.tables()
    assert checks.stock_balance(t).count() == 0
    line = t["line_stock"].filter("qty_from_stock > 0").orderBy("order_id", "sku").first()
    changed = t["line_stock"].withColumn("qty_from_stock", F.col("qty_from_stock") - F.when(
        (F.col("order_id") == line.order_id) & (F.col("sku") == line.sku), 1).otherwise(0))
    assert [(r.date, r.dc_id, r.item_id) for r in checks.stock_balance(t | {"line_stock": changed}).collect()] == [(line.date, line.dc_id, line.item_id)]


def test_a_build_from_ten_text_exports(spark, build, tmp_path):
    """Ids like DC-1 and S00001 all the way: staging, ledger, snapshots, marts, all checks and all breaks."""
    def keyed(c, name):
        return F.concat(F.lit({"dc_id": "DC-", "serving_dc": "DC-", "supplier_id": "S", "sku": "P", "zone_id": "Z", "order_id": "O", "po_id": "PO-"}[name]), c.cast("string"))
    kept = build.raw["products"].filter("sku <= 24").select("sku")
    lines = build.raw["order_lines"].join(kept, "sku", "left_semi")
    pos = build.raw["purchase_orders"].join(kept, "sku", "left_semi")
    small = {"products": build.raw["products"].join(kept, "sku", "left_semi"), "order_lines": lines, "purchase_orders": pos,
             "goods_receipts": build.raw["goods_receipts"].join(pos.select("po_id"), "po_id", "left_semi")}
    for name in ("sales_orders", "shipments"):
        small[name] = build.raw[name].join(lines.select("order_id").distinct(), "order_id", "left_semi")

    def export(name, df):
        df.select(*[(keyed(F.col(c), c) if c in ("dc_id", "serving_dc", "supplier_id", "sku", "zone_id", "order_id", "po_id") else F.col(c).cast("string")).alias(c)
                    for c, _, _ in EXPORTS[name]]).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / name))
        return read_text_csv(spark, str(tmp_path / name), name)

    files = {name: export(name, small.get(name, build.raw.get(name))) for name in EXPORTS if name != "inventory_daily"}
    first = Pipeline(spark, exports=files)
    (first.stock_daily.select(F.col("date").alias("stock_date"), "dc_id", F.col("item_id").alias("sku"), "on_hand", "reorder_point")
     .write.option("header", True).csv(str(tmp_path / "inventory_daily")))
    first.release()
    b = Pipeline(spark, exports=files | {"inventory_daily": read_text_csv(spark, str(tmp_path / "inventory_daily"), "inventory_daily")})
    assert b.stg_inventory.columns == ["stock_date", "dc_id", "item_id", "on_hand", "reorder_point"]
    assert b.stockout_snapshots.select("dc_id", "supplier_id").first().supplier_id.startswith("S")
    t = b.tables()
    bad = {key: (r.violations, r.mutated_violations) for key in checks.CHECKS for r in checks.check_counts(t, key).collect()}
    # 24 products cannot have the class shares of a whole range
    assert {k: v[0] for k, v in bad.items() if k != "check_abc_shares"} == dict.fromkeys(set(bad) - {"check_abc_shares"}, 0)
    assert all(v[1] > 0 for v in bad.values())
    b.release()
