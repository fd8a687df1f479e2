"""Column helpers: name cleaning, fiscal labels, guarded ratios."""

from datetime import date

from pyspark.sql import functions as F

from godown.functions.dates import fiscal_year_label
from godown.functions.ratios import capped_ratio, safe_div
from godown.functions.text import clean_name


def test_clean_name_cases(spark):
    rows = [("ARJUN FOODS FMCG  ",), ("Arjun foods fmcg",), ("arjun  foods",), ("  mixed CaSe words ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(clean_name(F.col("s"))).collect()]
    assert got == ["Arjun Foods FMCG", "Arjun Foods FMCG", "Arjun  Foods", "Mixed Case Words"]


def test_fiscal_year_edges(spark):
    days = [(date(2024, 3, 31),), (date(2024, 4, 1),), (date(2000, 1, 15),), (date(1999, 12, 31),)]
    got = [r[0] for r in spark.createDataFrame(days, "d date").select(fiscal_year_label(F.col("d"))).collect()]
    assert got == ["FY 2023-24", "FY 2024-25", "FY 1999-00", "FY 1999-00"]


def test_capped_ratio_null_and_zero(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (10, 4), (1000, 1)], "a int, b int")
    got = [r[0] for r in df.select(capped_ratio(F.col("a"), F.col("b"), 120)).collect()]
    assert got == [120.0, 120.0, 2.5, 120.0]
    assert df.select(safe_div(F.col("a"), F.col("b"))).first()[0] is None
