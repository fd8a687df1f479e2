"""What must not grow with the input: tables held in memory, tables that a check does not read, rows worked out a snapshot."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from godown.config import Calendar
from godown.plans import checks, model, sparse
from godown.plans.build import Pipeline
from godown.sources import sinks

CAL = Calendar(start=date(2000, 1, 1), end=date(2005, 12, 31), snapshot_from=date(2000, 2, 1))
FLOWS = "dc_id long, sku long, date date, demand long, accepted long, open_delta long"


@pytest.fixture(scope="module")
def own(spark):
    b = Pipeline(spark, "/root/testdata/sf0.001")
    yield b
    b.release()


def test_a_check_builds_only_the_tables_it_reads(own):
    t = own.tables()
    assert checks.check_counts(t, "check_supplier_names").first()["violations"] == 0
    assert not {"line_stock", "stock_daily", "stockout_snapshots", "sc_workbench", "fact_order_lines"} & set(own.__dict__)
    assert "line_stock" in t and len(t) == 16 and "line_stock" not in own.__dict__
    with pytest.raises(KeyError):
        t["raw"]


def test_tables_of_order_lines_are_not_held_in_memory(own):
    for name in ("stg_order_lines", "stg_purchase_orders", "stg_goods_receipts", "stg_sales_orders", "fact_order_lines", "fact_purchase_orders"):
        df = getattr(own, name)
        assert not df.storageLevel.useMemory and df.inputFiles(), name


def test_tables_dealt_once_meet_without_an_exchange(spark, own):
    pairs = [(own.stg_purchase_orders, own.stg_goods_receipts, "po_id"), (own.stg_sales_orders, own.stg_shipments, "order_id"),
             (own.stg_sales_orders, own.stg_order_lines, "order_id")]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for a, b, key in pairs:
            plan = a.join(b, key)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_released_build_leaves_no_table_in_the_catalog(spark):
    b = Pipeline(spark, "/root/testdata/sf0.001")
    before = {t.name for t in spark.catalog.listTables()}
    assert b.stg_order_lines.count() and {t.name for t in spark.catalog.listTables()} - before
    b.release()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_listed_receipts_are_those_found_by_key(spark):
    """Orders listed twice, without a receipt, with an unknown supplier; receipts without an order or quantities, two on a day."""
    day, late = date(2000, 3, 1), date(2000, 3, 9)
    pos = spark.createDataFrame([("a", 1, 0, 7, day, day, 10), ("a", 1, 1, 7, day, day, 10), ("b", 1, 0, 7, day, day, 5), ("c", 9, 0, 7, day, day, 3),
                                 (None, 1, 0, 7, day, day, 2)],
                                "po_id string, supplier_id long, dc_id long, sku long, order_date date, promised_date date, qty_ordered int")
    receipts = spark.createDataFrame([("a", day, 4, 1), ("a", day, 3, 0), ("a", late, 2, None), ("a", late, None, 0), ("c", day, 3, 0), ("x", day, 9, 0),
                                      (None, day, 8, 0)], "po_id string, received_date date, qty_received int, qty_rejected int")
    sups = spark.createDataFrame([(1, 5)], "supplier_id long, quoted_lead_days int")
    prods = spark.createDataFrame([(7, "i", 2)], "sku long, item_id string, unit_cost int").withColumn("unit_cost", F.col("unit_cost").cast("decimal(18,2)"))
    listed = model.received_orders(pos, receipts, sups, prods)
    fact = model.fact_purchase_orders(pos, receipts, sups, prods)
    assert fact.columns == [c for c in listed.columns if c != "receipts"] and fact.count() == 4
    got, want = (sorted(map(tuple, model.accepted_daily(receipts, df, ["dc_id", "item_id"]).collect())) for df in (listed, fact))
    assert got == want == [(0, "i", day, 6), (0, "i", late, None), (1, "i", day, 6), (1, "i", late, None)]


def test_a_run_of_snapshots_with_one_state_is_one_row(spark):
    flows = spark.createDataFrame([(0, 1, date(2002, 5, 8), 70, 0, 70), (0, 1, date(2002, 6, 3), 0, 30, -70), (1, 2, date(2000, 1, 1), 1, 0, 0),
                                   (1, 2, date(2005, 12, 31), 1, 0, 0)], FLOWS)
    days = sparse.mondays(CAL)
    runs = sparse.state_runs(flows, ["dc_id", "sku"], days, CAL).collect()
    asked = [d for d in (CAL.start + timedelta(i) for i in range((CAL.end - CAL.start).days + 1)) if d.weekday() == 0 and d >= CAL.snapshot_from]
    for key in ((0, 1), (1, 2)):
        held = [r.held for r in runs if (r.dc_id, r.sku) == key]
        assert sorted(d for h in held for d in h) == asked and len(held) <= 12  # 309 rows a series before


def test_states_are_those_of_every_day_walked(spark):
    """Against a walk of all days, with an empty start, an order on a Monday, and flows on the first and last day."""
    cal = Calendar(start=date(2000, 1, 1), end=date(2000, 6, 26), snapshot_from=date(2000, 1, 1), opening_stock=0)
    moves = {date(2000, 1, 1): (2, 0, 2), date(2000, 1, 10): (5, 9, 5), date(2000, 1, 11): (0, 3, -2), date(2000, 3, 6): (40, 0, 40),
             date(2000, 3, 20): (0, 50, -45), date(2000, 6, 26): (99, 0, 99)}
    flows = spark.createDataFrame([(0, 1, d, *v) for d, v in moves.items()], FLOWS)
    got = {r.date: r for r in sparse.states_on(flows, ["dc_id", "sku"], sparse.mondays(cal), cal).collect()}
    every = [cal.start + timedelta(i) for i in range((cal.end - cal.start).days + 1)]
    stock, total, opened, on_hand, opens, demand = cal.opening_stock, 0, 0, {}, {}, {}
    for d in every:
        demand[d], accepted, delta = moves.get(d, (0, 0, 0))
        stock, opened = max(stock + accepted - demand[d], 0), opened + delta
        on_hand[d], opens[d] = stock, opened
    assert set(got) == {d for d in every if d.weekday() == 0}
    for d, r in got.items():
        back = [demand[x] for x in every if 0 <= (d - x).days < 28]
        ahead = [on_hand[x] <= 0 for x in every if 0 < (x - d).days <= 14]
        assert (r.on_hand, r.open_po_units, r.demand, r.reorder_point) == (on_hand[d], opens[d], demand[d], sum(back) * 8 // 28), d
        assert r.demand_28d == pytest.approx(sum(back) / len(back)) and r.demand_7d == pytest.approx(sum(back[-7:]) / len(back[-7:]))
        assert r.out_next_14d == (any(ahead) if ahead else None), d


def test_the_order_of_an_export_is_checked_on_plain_columns(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 3 else f"t{i}") for i in range(50)], "a long, b string")
    sinks.export(df, f"{tmp_path}/x")
    plan = sinks.manifest(spark, f"{tmp_path}/x", df.schema)._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(" not in plan[plan.index("Window"):].split("\n", 1)[1]  # no keys are formed below the window
    assert sinks.verified(df, f"{tmp_path}/x").first().asDict() == {"rows": 50, "ordered": True, "same": True}
