"""Keys, calendars and folders that must hold beyond the driver tables' sizes and dates."""

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from godown.config import Calendar
from godown.plans.model import date_dimension, series_grid, stock_daily
from godown.session import checkpoint_dir
from godown.sources import driver_tables as D


def test_purchase_orders_of_large_part_keys_stay_apart(spark):
    """Order 1 with part 1,000,005 and order 2 with part 5 once shared a key."""
    lines = spark.createDataFrame([(1, 1_000_005, 10, 10), (2, 5, 20, 20)], "order_id long, sku long, qty_ordered int, qty_shipped int")
    headers = spark.createDataFrame([(1, 0, date(2000, 1, 1)), (2, 0, date(2000, 1, 2))], "order_id long, dc_id int, order_date date")
    products = spark.createDataFrame([(1_000_005, 1), (5, 1)], "sku long, supplier_id long")
    suppliers = spark.createDataFrame([(1, 7)], "supplier_id long, quoted_lead_days int")
    po = D.purchase_orders_typed(lines, headers, products, suppliers)
    assert {(r.po_id, r.qty_ordered) for r in po.collect()} == {("1-1000005", 10), ("2-5", 20)}
    got = {r.po_id: r.q for r in D.goods_receipts(po).groupBy("po_id").agg(F.sum("qty_received").alias("q")).collect()}
    for order, sku, q in ((1, 1_000_005, 10), (2, 5, 20)):
        k = order * 1_000_000 + sku  # the rules are remainders of this number
        want = None if k % 101 == 0 else q if k % 7 == 0 or k % 11 else q * 9 // 10
        assert got.get(f"{order}-{sku}") == want


def test_rules_are_remainders_of_the_whole_number(spark):
    keys = [(o, s) for o in (1, 999, 10**12) for s in (5, 1_000_005, 10**13 + 7)]
    df = spark.createDataFrame(keys, "order_id long, sku long")
    for n in (4, 7, 11, 13, 101):
        assert [r.m for r in df.select(D._po_mod(n).alias("m")).collect()] == [(o * 1_000_000 + s) % n for o, s in keys]


def test_calendar_follows_the_data(spark):
    cal = Calendar.covering(date(2003, 5, 17), date(2012, 12, 2))
    assert (cal.start, cal.end, cal.snapshot_from) == (date(2003, 5, 1), date(2012, 12, 31), date(2003, 6, 1))
    assert cal.festival_days[0].year == 2003 and cal.festival_days[-1].year == 2012 and cal.train_end < cal.test_start < cal.end
    span = spark.createDataFrame([(date(2003, 5, 17), date(2003, 8, 2))], "first_day date, last_day date")
    days = [r.date for r in date_dimension(span).orderBy("date").collect()]
    assert (days[0], days[-1], len(days)) == (date(2003, 5, 1), date(2003, 8, 31), 123)
    assert Calendar.covering(date(1995, 1, 1), date(2001, 8, 16)) == Calendar()


def test_a_flow_outside_a_given_calendar_is_an_error(spark):
    cal = Calendar(start=date(2000, 1, 1), end=date(2000, 1, 31))
    items = spark.createDataFrame([("i",)], "item_id string")
    dcs = spark.createDataFrame([(0,)], "dc_id int")

    def ledger(day):
        lines = spark.createDataFrame([(0, "i", day, 3, 3)], "dc_id int, item_id string, order_date date, qty_ordered int, qty_shipped int")
        pos = spark.createDataFrame([], "po_id string, dc_id int, item_id string, order_date date, last_received date, qty_ordered int")
        receipts = spark.createDataFrame([], "po_id string, received_date date, qty_received int, qty_rejected int")
        return stock_daily(series_grid(dcs, items, cal, 2), lines, receipts, pos, items, cal)

    assert ledger(date(2000, 1, 31)).agg(F.sum("demand")).first()[0] == 3
    with pytest.raises(Exception, match="outside the calendar"):
        ledger(date(2000, 2, 1)).collect()


def test_no_machine_local_folder_on_a_cluster():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", setCheckpointDir=lambda _: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        checkpoint_dir(session)
