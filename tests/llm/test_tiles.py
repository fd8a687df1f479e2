"""Operator 7 reads the blocks that it pairs; it does not move them."""

import numpy as np

from godown.llm import int8_neardup


def test_tiles_do_not_go_through_a_shuffle(spark, monkeypatch):
    plans, cut = [], int8_neardup.cut_lineage

    def watched(df, *args, **kwargs):
        if df.columns == ["a", "b", "n"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, *args, **kwargs)
    monkeypatch.setattr(int8_neardup, "cut_lineage", watched)
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 16))
    x = np.concatenate([c + rnd.normal(size=(40, 16)) * 0.2 for c in centres])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, x[0, :8].tolist()), (1001, x[0, :8].tolist()), (1002, [0.0] * 16), (1003, None), (None, x[1].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in int8_neardup.near_duplicates(df.repartition(4), block=32).collect()}
    assert len(plans) == 1 and "Exchange" not in plans[0] and "vectorsx" in plans[0]
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    want = dict(enumerate(((unit @ unit.T >= int8_neardup.THRESHOLD).sum(axis=1) - 1).tolist()))
    assert got == want | {1000: 1, 1001: 1, 1002: 0, 1003: 0, None: 0} and sum(want.values()) > 100


def test_groups_of_cells_hold_every_length(spark, monkeypatch):
    """More lengths than groups: a group holds cells of several, which are never paired with each other."""
    monkeypatch.setattr(int8_neardup, "GROUPS", 2)
    rows = [(10 * d + k, [1.0] * d + [k * 1e-3]) for d in range(1, 8) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in int8_neardup.near_duplicates(df).collect()}
    assert got == {v: (2, v // 10 * 10) for v, _ in rows}
