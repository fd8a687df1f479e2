"""Text-first CSV scan, typed staging, day-first dates, and the sinks."""

import tempfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from godown.sources.exports import read_text_csv, stage
from godown.sources.sinks import gated_export, materialise, typed_extract


def _csv(tmp: Path, name: str, text: str) -> str:
    p = tmp / name
    p.write_text(text)
    return str(p)


def test_text_scan_and_day_first_dates(spark):
    tmp = Path(tempfile.mkdtemp(prefix="godown-test-"))
    path = _csv(tmp, "purchase_orders.csv",
                "po_id,supplier_id,dc_id,sku,order_date,promised_date,qty_ordered\n"
                "P1,S001,DC-1,BE-001,31/03/2024,07/04/2024,12\n"
                "P2,S002,DC-2,BE-002,01/04/2024,09/04/2024,24\n")
    raw = read_text_csv(spark, path, "purchase_orders")
    assert all(f.dataType.simpleString() == "string" for f in raw.schema.fields)
    rows = stage("purchase_orders", raw).orderBy("po_id").collect()
    assert rows[0].order_date == date(2024, 3, 31) and rows[1].promised_date == date(2024, 4, 9)
    assert rows[0].qty_ordered == 12


def test_supplier_names_cleaned_in_staging(spark):
    tmp = Path(tempfile.mkdtemp(prefix="godown-test-"))
    path = _csv(tmp, "suppliers.csv",
                "supplier_id,supplier,category,hub,state,lat,lon,quoted_lead_days\n"
                "S001,GANGA FOODS FMCG  ,Snacks,Pune,MH,18.5,73.8,6\n")
    s = stage("suppliers", read_text_csv(spark, path, "suppliers")).first()
    assert s.supplier == "Ganga Foods FMCG" and s.quoted_lead_days == 6 and s.lat == 18.5


def test_bad_value_fails_the_build(spark):
    tmp = Path(tempfile.mkdtemp(prefix="godown-test-"))
    path = _csv(tmp, "goods_receipts.csv", "po_id,received_date,qty_received,qty_rejected\nP1,2024-04-01,ten,0\n")
    with pytest.raises(Exception):
        stage("goods_receipts", read_text_csv(spark, path, "goods_receipts")).collect()


def test_materialise_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="godown-test-") + "/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    back = materialise(df, out)
    assert sorted(back.collect()) == sorted(df.collect())
    back2 = materialise(df.filter("k = 1"), out)  # full refresh replaces the table
    assert back2.count() == 1


def test_gated_export(spark):
    out = tempfile.mkdtemp(prefix="godown-test-")
    t = {"dim": spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")}
    ok, _ = gated_export(t, lambda: [("rule", 1, "(1,)")], out + "/blocked", ["dim"])
    assert not ok and not Path(out, "blocked").exists()
    ok, _ = gated_export(t, lambda: [("rule", 0, None)], out + "/open", ["dim"])
    assert ok
    back = spark.read.option("header", True).csv(out + "/open/dim").collect()
    assert [r.k for r in back] == ["1", "2"]


def test_exports_are_proved_by_reading(spark):
    from pyspark.sql import functions as F

    from godown.sources import sinks
    out = tempfile.mkdtemp(prefix="godown-test-")
    rows = [(k % 7 if k % 5 else None, f' "{k}", \t' if k % 3 else "", None if k % 4 else k / 3) for k in range(200)] + [(1, None, 0.5)] * 2
    df = spark.createDataFrame(rows, "k int, v string, x double").repartition(3)
    sinks.export(df, out + "/good")
    assert tuple(sinks.verified(df, out + "/good").first()) == (202, True, True)
    assert sinks.manifest(spark, out + "/good", df.schema).agg(F.sum("rows")).first()[0] == 202
    df.write.options(**sinks.CSV).csv(out + "/unordered")
    assert tuple(sinks.verified(df, out + "/unordered").first()) == (202, False, True)
    sinks.export(df.withColumn("x", F.when(F.col("k") == 1, 0.75).otherwise(F.col("x"))), out + "/changed")
    assert tuple(sinks.verified(df, out + "/changed").first()) == (202, True, False)
    for part in (0, 1):  # each file is ordered, but not one after the other
        df.filter(F.hash("v", "x") % 2 == part).coalesce(1).sort(*[F.col(c).asc_nulls_last() for c in df.columns]).write.mode("append").options(**sinks.CSV).csv(out + "/parts")
    assert sinks.verified(df, out + "/parts").first()["rows"] <= 202 and not sinks.verified(df, out + "/parts").first()["ordered"]
    sinks.export(df.filter("false"), out + "/empty")
    assert tuple(sinks.verified(df.filter("false"), out + "/empty").first()) == (0, True, True)


def test_typed_extract(spark):
    out = tempfile.mkdtemp(prefix="godown-test-") + "/x"
    df = spark.createDataFrame([("Lane", 1.0), ("Node", 2.0), ("Lane", 3.0)], "record_type string, v double")
    assert typed_extract(df, out) == 3
    assert spark.read.parquet(out).filter(F.col("record_type") == "Node").count() == 1
    with pytest.raises(TypeError):
        typed_extract(df.withColumn("m", F.create_map(F.lit("a"), F.lit(1))), out + "2")


def test_exports_as_a_distributor_writes_them(spark):
    """Products with six columns and stock by product: the product itself is what is stocked."""
    tmp = Path(tempfile.mkdtemp(prefix="godown-test-"))
    path = _csv(tmp, "products.csv", "sku,category,supplier_id,unit_cost,unit_price,case_qty\nBE-001,Tea,S001,10.50,12.00,6\n")
    p = stage("products", read_text_csv(spark, path, "products")).first()
    assert p.item_id == "BE-001" and str(p.unit_cost) == "10.50" and p.case_qty == 6
    path = _csv(tmp, "inventory_daily.csv", "stock_date,dc_id,sku,on_hand,reorder_point\n2024-04-01,DC-1,BE-001,5,7\n")
    i = stage("inventory_daily", read_text_csv(spark, path, "inventory_daily")).first()
    assert (i.stock_date, i.item_id, i.on_hand) == (date(2024, 4, 1), "BE-001", 5)


def test_released_builds_read_changed_data(spark):
    from conftest import SF
    from godown.plans import registry
    first = registry.build_for(spark, SF)
    assert registry.build_for(spark, SF) is first
    registry.release(spark, SF)
    assert registry.build_for(spark, SF) is not first
