"""Operators against brute force on small fixtures."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from godown.operators.abc import abc_classes, abc_runs, class_on
from godown.operators.intervals import next_on_or_after, open_deltas, trailing_stats
from godown.operators.prefix import ordered_prefix_sums, prefix_sums
from godown.operators.replay import replay


def test_replay_equals_recursion(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for key in range(4):
        on = 50
        for t in range(60):
            rec, dem = rng.choice([0, 0, 0, 30]), rng.randint(0, 12)
            on = max(on + rec - dem, 0)
            rows.append((key, t, rec, dem))
            expected[(key, t)] = on
    df = spark.createDataFrame(rows, "k int, t int, rec long, dem long")
    got = {(r.k, r.t): r.on_hand for r in replay(df, ["k"], "t", "rec", "dem", 50).collect()}
    assert got == expected


def test_replay_shipped_balances(spark):
    df = spark.createDataFrame([(0, t, 0 if t % 5 else 20, 7) for t in range(30)], "k int, t int, rec long, dem long")
    r = replay(df, ["k"], "t", "rec", "dem", 10).orderBy("t").collect()
    prev = 10
    for row in r:
        assert row.on_hand == prev + row.rec - row.shipped
        assert 0 <= row.shipped <= row.dem
        prev = row.on_hand


def test_open_deltas_match_interval_join(spark):
    d0 = date(2000, 1, 1)
    ivs = [(1, d0 + timedelta(days=2), d0 + timedelta(days=5), 3), (1, d0 + timedelta(days=4), None, 7),
           (1, d0 + timedelta(days=5), d0 + timedelta(days=5), 11), (2, d0, d0 + timedelta(days=1), 1)]
    df = spark.createDataFrame(ivs, "k int, s date, e date, q int")
    days = [(k, d0 + timedelta(days=i)) for k in (1, 2) for i in range(8)]
    grid = spark.createDataFrame(days, "k int, date date")
    deltas = open_deltas(df, ["k"], "s", "e", "q")
    got = (grid.join(deltas, ["k", "date"], "left").fillna(0, ["open_delta"])
           .select("k", "date", F.sum("open_delta").over(Window.partitionBy("k").orderBy("date")).alias("open")).collect())
    for r in got:
        want = sum(q for k, s, e, q in ivs if k == r.k and s <= r.date and (e is None or e > r.date))
        assert r.open == want, r


def test_trailing_stats_window(spark):
    d0 = date(2000, 1, 1)
    rows = [(1, d0 + timedelta(days=i), i) for i in range(0, 400, 7)]
    t = trailing_stats(spark.createDataFrame(rows, "k int, date date, x long"), ["k"], "date", 180, ["x"]).collect()
    for r in t:
        want = sum(x for _, d, x in rows if r.date - timedelta(days=180) < d <= r.date)
        assert r.x_trailing == want


def test_next_event(spark):
    dates = spark.createDataFrame([(date(2000, 1, d),) for d in (1, 5, 10, 20)], "date date")
    ev = spark.createDataFrame([(date(2000, 1, 5),), (date(2000, 1, 15),)], "day date")
    got = {r.date.day: r.next_event for r in next_on_or_after(dates, "date", ev, "day").collect()}
    assert got == {1: date(2000, 1, 5), 5: date(2000, 1, 5), 10: date(2000, 1, 15), 20: None}


def test_prefix_sums_match_cumsum(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v long")
    got = {r.id: (r.inc, r.exc) for r in ordered_prefix_sums(
        ordered_prefix_sums(df, [F.col("v").desc(), F.col("id")], {"inc": F.col("v")}, buckets=7),
        [F.col("v").desc(), F.col("id")], {"exc": F.col("v")}, buckets=3, inclusive=False).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    run = 0
    for i, v in order:
        assert got[i] == (run + v, run)
        run += v


def test_abc_boundary(spark):
    # values 50, 30, 15, 5, 0: the item crossing 80% stays A; a tie is broken by key; no sales is C
    rows = [("a", D(50)), ("b", D(30)), ("c", D(15)), ("d", D(5)), ("e", D(0)), ("f", None)]
    df = spark.createDataFrame(rows, "sku string, value decimal(18,2)")
    got = {r.sku: r.abc_class for r in abc_classes(df, "sku").collect()}
    assert got == {"a": "A", "b": "A", "c": "B", "d": "C", "e": "C", "f": "C"}
    tie = spark.createDataFrame([("y", D(40)), ("x", D(40)), ("z", D(20))], "sku string, value decimal(18,2)")
    got = {r.sku: r.abc_class for r in abc_classes(tie, "sku").collect()}
    assert got == {"x": "A", "y": "A", "z": "B"}  # z has 80% before it: not below 0.80


def test_bucketed_prefix_sums_match_cumsum(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, 1.5, -2.5]), rng.choice([None, 1, 2, 7]), rng.choice([None, D("1.25"), D("-3.50")]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double, w long, m decimal(18,2)")

    def rank(v, ascending):  # nulls least, NaN greatest
        k = (0, 0.0) if v is None else (2, 0.0) if v != v else (1, float(v))
        return k if ascending else tuple(-p for p in k)

    for buckets in (1, 2, 37, 500):
        for first, way, inclusive in (("x", True, True), ("x", False, False), ("m", False, True), ("w", False, False), ("w", True, True)):
            out, totals = prefix_sums(df, [(first, way), ("id", True)], {"n": F.col("w"), "money": F.col("m"), "_m": F.lit(1)}, buckets, inclusive)
            at = df.columns.index(first)
            n, money, want = 0, D(0), {}
            for r in sorted(rows, key=lambda r: (rank(r[at], way), r[0])):
                before = (n, money)
                n, money = n + (r[2] or 0), money + (r[3] or 0)
                want[r[0]] = (n, money) if inclusive else before
            assert {r.id: (r.n, r.money) for r in out.collect()} == want
            assert (totals["n"], totals["money"], totals["_m"]) == (n, money, len(rows))
    assert out.columns == [*df.columns, "n", "money", "_m"]


def test_bucketed_prefix_sums_of_dates_texts_and_nothing(spark):
    rows = [(date(2000, 1, 1) + timedelta(days=i % 5), f"t{i:03}") for i in range(400)] + [(None, "a"), (None, None)]
    df = spark.createDataFrame(rows, "d date, t string")
    out, totals = prefix_sums(df, [("d", False), ("t", True)], {"n": F.lit(1)}, buckets=9)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or date.min).toordinal(), r[1] is not None, r[1] or ""))
    assert [(r.d, r.t) for r in out.orderBy("n").collect()] == order and totals == {"n": len(rows)}
    out, totals = prefix_sums(df.limit(0), [("t", True)], {"n": F.lit(1)}, buckets=9)
    assert out.count() == 0 and totals == {"n": 0}
    with pytest.raises(ValueError, match="ascending"):
        prefix_sums(df, [("t", False)], {"n": F.lit(1)})


def test_bucketed_prefix_sums_move_rows_once(spark):
    df = spark.range(20000).select("id", (F.col("id") % 7).alias("v"))
    out, _ = prefix_sums(df, [("v", False), ("id", True)], {"s": F.col("v")}, buckets=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning" not in plan
    per_bucket = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_bucket) > 1


def test_classes_as_of_days_use_only_earlier_sales(spark):
    rng = random.Random(8)
    d0 = date(2000, 1, 1)
    days = [d0 + timedelta(days=7 * i) for i in range(1, 12)]
    sales = [(rng.choice("abcdefghijk"), d0 + timedelta(days=rng.randrange(90)), rng.choice([None, D(1), D(5), D("20.25"), D(0)])) for _ in range(400)]
    sales += [("late", days[-1] + timedelta(days=1), D(10 ** 6)), (None, d0, D(3)), ("a", None, D(4)), ("z", days[3], D(10 ** 4)), ("nil", d0, None)]
    df = spark.createDataFrame(sales, "sku string, day date, v decimal(18,2)")
    runs = abc_runs(df, "sku", "day", "v", days, buckets=5)
    on = spark.createDataFrame([(k, d) for k in [*"abcdefghijkz", "late", "nil", "none", None] for d in [*days, d0]] + [("a", None)], "sku string, on date")
    got = {(r.sku, r.on): r.abc_class for r in class_on(on, runs, "sku", "on").collect()}
    assert len(got) == on.count()
    for d in days:
        worth = {}
        for k, day, v in sales:
            if k and day and day <= d:
                worth[k] = worth.get(k, 0) + (v or 0)
        whole, before = sum(worth.values()), D(0)
        for k in sorted(worth, key=lambda k: (-worth[k], k)):
            assert got[k, d] == ("A" if before < whole * D("0.8") else "B" if before < whole * D("0.95") else "C"), (k, d)
            before += worth[k]
        assert {got[k, d] for k in ("late", "none", None)} == {"C"}
    assert got["a", d0] == got["a", None] == "C"
    held = {}
    for r in runs.orderBy("sku", "valid_from").collect():
        last = held.get(r.sku)
        assert last is None or (last.valid_to == r.valid_from - timedelta(days=1) and last.abc_class != r.abc_class)
        held[r.sku] = r
    assert all(r.valid_to is None for r in held.values()) and abc_runs(df.limit(0), "sku", "day", "v", days).count() == 0
