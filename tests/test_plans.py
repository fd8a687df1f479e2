"""Plan guards for scale: pruning reaches the scans, and no nested-loop or cartesian joins appear
where the data grows."""

from godown.plans.build import Pipeline
from godown.plans.features import supplier_trailing
from conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_scan_is_pruned(spark):
    b = Pipeline(spark, SF, materialize=False)
    p = _plan(b.stg_order_lines)
    assert "l_orderkey" in p and "l_extendedprice" not in p and "l_shipdate" not in p


def test_fact_plans_have_no_nested_loops(spark):
    b = Pipeline(spark, SF, materialize=False)
    for df in (b.fact_order_lines, b.fact_purchase_orders):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_feature_plans_pair_nothing(spark):
    b = Pipeline(spark, SF, materialize=False)
    snaps = b.stockout_snapshots
    p = _plan(snaps)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    sup = supplier_trailing(b.fact_purchase_orders, snaps.selectExpr("snapshot_date AS date", "supplier_id"))
    assert "CartesianProduct" not in _plan(sup)


def test_supplier_leakage_in_every_week(build):
    """A leaked supplier feature after the first week of a month is seen by the full recount only."""
    from pyspark.sql import functions as F

    from godown.plans import checks
    t = build.tables()
    assert checks.supplier_leakage(t, sample=None).count() == 0
    late = t["stockout_snapshots"].withColumn("supplier_on_time_180d", F.col("supplier_on_time_180d") + F.when(
        F.dayofmonth("snapshot_date") > 7, 0.1).otherwise(0.0))
    broken = t | {"stockout_snapshots": late}
    want = late.filter(F.dayofmonth("snapshot_date") > 7).select("snapshot_date", "supplier_id").distinct().count()
    assert checks.supplier_leakage(broken).count() == 0
    assert checks.supplier_leakage(broken, sample=None).select("snapshot_date", "supplier_id").distinct().count() == want > 0
