"""Measures of every scope in one pass against the measures of one scope at a time."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from godown.plans import kpis
from godown.plans.marts import WORKBENCH_COLUMNS, typed

WEEKS = [date(2000, 1, 3), date(2000, 1, 10)]


@pytest.fixture(scope="module")
def wb(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        kind = rng.choice(["Lane", "Node", "Supplier", "Snapshot"])
        base = dict(record_type=kind, dc_city=rng.choice(["EAST", "WEST", None]), category=rng.choice(["A", "B", None]))
        if kind == "Snapshot":
            base.update(fiscal_year="FY 1999-00", period_date=WEEKS[i % 2], risk_band=rng.choice(["High", "Watch", "Low"]))
        else:
            base.update(fiscal_year=rng.choice(["FY 1998-99", "FY 2000-01", None]), period_date=date(1999, 1, 1))
        if kind == "Lane":
            base.update(lines=rng.randint(0, 3), otif_lines=0, lead_days_sum=rng.randint(0, 9))
        if kind == "Node":
            base.update(stock_value_days=rng.choice([0.0, 1024.0]), days=1, cogs=rng.randint(0, 5) / 4, carrying_cost=0.25)
        rows.append(base)
    names = sorted({k for r in rows for k in r})
    kinds = dict(WORKBENCH_COLUMNS)
    return typed(spark.createDataFrame([tuple(r.get(k) for k in names) for r in rows], ", ".join(f"{k} {kinds[k]}" for k in names))).cache()


@pytest.mark.parametrize("week", [None, WEEKS[0], date(1990, 1, 1)])
def test_every_scope_is_its_own_scope(wb, week):
    rows = kpis.kpis_every_scope(wb, week).collect()
    got = {(r.warehouse, r.period, r.category): r for r in rows}
    assert len(got) == len(rows) and {k[0] for k in got} <= {"All", "EAST", "WEST"} and {k[2] for k in got} <= {"All", "A", "B"}
    for w, p, c in (("All", "All", "All"), ("EAST", "All", "All"), ("All", "FY 2000-01", "B"), ("WEST", "FY 1998-99", "A"), ("All", "All", "A")):
        want = kpis.kpis(wb, kpis.Scope(w, p, c, week)).first().asDict()
        assert {k: got[w, p, c][k] for k in want} == pytest.approx(want, abs=1e-6), (w, p, c)


def test_every_scope_of_nothing(wb):
    assert kpis.kpis_every_scope(wb.filter(F.lit(False))).count() == 0
    only = kpis.kpis_every_scope(wb.filter("record_type = 'Snapshot' AND dc_city = 'EAST' AND category = 'A'")).collect()
    assert {(r.warehouse, r.period, r.category) for r in only} == {(w, "All", c) for w in ("All", "EAST") for c in ("All", "A")}
    assert all(r.otif is None and r.products > 0 for r in only)
