"""Registered queries, part 8: ABC classes as of a day, from the value shipped up to and on it.

The default class reads the whole period, so a snapshot's class knows later sales. These do not. The SQL joins every day to
the running value of each key and ranks each day by itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from godown.plans.registry import query


def _classed(key: str, days: str) -> str:
    """Relation ``classed``: day, key and class, for the keys with a shipment by that day."""
    return f""",
days AS (SELECT date AS day FROM dim_date WHERE {days}),
sent AS (
  SELECT {key} AS id, ship_date, sum(sum(cogs)) OVER (PARTITION BY {key} ORDER BY ship_date) AS worth
  FROM fact_order_lines GROUP BY {key}, ship_date),
worths AS (
  SELECT a.day, a.id, s.worth FROM (SELECT day, id FROM days, (SELECT DISTINCT id FROM sent)) a
  ASOF JOIN sent s ON s.id = a.id AND a.day >= s.ship_date),
classed AS (
  SELECT day, id, CASE WHEN 100 * before < 80 * whole THEN 'A' WHEN 100 * before < 95 * whole THEN 'B' ELSE 'C' END AS abc_class
  FROM (SELECT *, sum(worth) OVER (PARTITION BY day) AS whole,
               sum(worth) OVER (PARTITION BY day ORDER BY worth DESC, id ROWS UNBOUNDED PRECEDING) - worth AS before FROM worths))
"""


@query("abc_as_of_runs", _classed("sku", "date = month") + """
SELECT id AS sku, CAST(day AS VARCHAR) AS valid_from,
       CAST(lead(day) OVER (PARTITION BY id ORDER BY day) - 1 AS VARCHAR) AS valid_to, abc_class
FROM (SELECT *, lag(abc_class) OVER (PARTITION BY id ORDER BY day) AS was FROM classed) WHERE was IS DISTINCT FROM abc_class""")
def abc_as_of_runs(b):
    """Each product's class over time, set anew on the first of every month: a row a change."""
    return b.product_abc_runs.select("sku", "valid_from", "valid_to", "abc_class")


@query("snapshot_abc_as_of", _classed("item_id", "isodow(date) = 1") + """
SELECT CAST(s.snapshot_date AS VARCHAR) AS snapshot_date, CAST(s.dc_id AS BIGINT) AS dc_id, s.item_id, s.abc_class,
       ifnull(c.abc_class, 'C') AS abc_class_as_of
FROM stockout_snapshots s LEFT JOIN classed c ON c.day = s.snapshot_date AND c.id = s.item_id""")
def snapshot_abc_as_of(b):
    """Every snapshot's class from the sales up to its day, next to the class of the whole period."""
    s = b.snapshots_as_of.select("snapshot_date", "dc_id", "item_id", F.col("abc_class").alias("abc_class_as_of"))
    return b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "abc_class").join(s, ["snapshot_date", "dc_id", "item_id"])


@query("abc_class_drift", _classed("item_id", "isodow(date) = 1") + """
SELECT CAST(s.snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS snapshots,
       count(*) FILTER (WHERE ifnull(c.abc_class, 'C') <> s.abc_class) AS differing,
       count(*) FILTER (WHERE ifnull(c.abc_class, 'C') = 'A') AS class_a, coalesce(sum(s.stockout_14d) FILTER (WHERE c.abc_class = 'A'), 0)::BIGINT AS stockouts_a
FROM stockout_snapshots s LEFT JOIN classed c ON c.day = s.snapshot_date AND c.id = s.item_id GROUP BY s.snapshot_date""")
def abc_class_drift(b):
    """How many snapshots a week carry another class when later sales are unknown, and the stockouts of class A then."""
    s = b.snapshots_as_of.withColumnRenamed("abc_class", "now").join(
        b.stockout_snapshots.select("snapshot_date", "dc_id", "item_id", "abc_class"), ["snapshot_date", "dc_id", "item_id"])
    return s.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("snapshots"), F.count_if(F.col("now") != F.col("abc_class")).alias("differing"),
        F.count_if(F.col("now") == "A").alias("class_a"),
        F.coalesce(F.sum(F.when(F.col("now") == "A", F.col("stockout_14d"))), F.lit(0)).cast("long").alias("stockouts_a"))
