"""How often rows move: the sparse ledger's flows and series."""

from datetime import date

from pyspark.sql import functions as F

from godown.config import Calendar
from godown.plans import sparse

CAL = Calendar.covering(date(2000, 1, 3), date(2000, 4, 28))
KEYS = ["dc_id", "sku"]


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


def listed(spark):
    """Lines and purchase orders that list their receipts, on one day and on others, with a null quantity."""
    a, b = date(2000, 1, 3), date(2000, 2, 1)
    lines = spark.createDataFrame([(0, 1, a, 60), (0, 1, b, 5), (0, 1, b, None), (1, 1, b, None), (None, 2, b, 4)],
                                  "dc_id long, sku long, order_date date, qty_ordered int")
    pos = spark.createDataFrame([(0, 1, a, b, 9, [(b, 4), (b, 5)]), (0, 1, a, None, 7, None), (1, 3, b, b, 2, [(b, None)])],
                                "dc_id long, sku long, order_date date, last_received date, qty_ordered int, receipts array<struct<date:date,units:int>>")
    return lines, pos, a, b


def test_flows_and_series_move_once(spark, tmp_path):
    lines, pos, a, b = listed(spark)
    flows = sparse.daily_flows(lines, None, pos, KEYS, CAL)
    assert len(exchanges(flows)) == 1
    assert {tuple(r) for r in flows.collect()} == {(0, 1, a, 60, 0, 16), (0, 1, b, 5, 9, -9), (1, 1, b, None, 0, 0), (None, 2, b, 4, 0, 0), (1, 3, b, 0, 0, 0)}
    flows.write.parquet(str(tmp_path / "flows"))
    stored = spark.read.parquet(str(tmp_path / "flows"))
    runs = sparse.stock_runs(stored, KEYS, CAL)
    assert len(exchanges(runs)) == 1
    assert len(exchanges(sparse.state_runs(stored, KEYS, sparse.mondays(CAL), CAL))) == 1
    got = sorted((r.dc_id, r.valid_from, r.valid_to, r.on_hand, r.open_po_units) for r in runs.filter("sku = 1 and dc_id = 0").collect())
    assert got == [(0, a.replace(day=1), date(2000, 1, 2), 50, 0), (0, a, date(2000, 1, 31), 0, 16), (0, b, CAL.end, 4, 7)]
    assert runs.filter(F.col("dc_id").isNull()).count() == 2
