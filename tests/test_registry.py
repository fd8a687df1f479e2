"""Features driven by a registry table: a row more or less changes the model and its importances."""

import pytest
from pyspark.sql import functions as F

from godown.config import FEATURES
from godown.plans import ml


def table(spark, features):
    return spark.createDataFrame([(k, f, kind) for k, (f, kind) in enumerate(features)], "position int, feature string, kind string")


def test_registry_drives_model_and_importances(spark, build):
    some = build.stockout_snapshots.filter(F.xxhash64("item_id") % 10 == 0)
    rows = [x for x in FEATURES if x[0] not in ("demand_cv", "abc_class", "cover_days")] + [("on_hand", "numeric")]
    features = ml.registered(table(spark, rows), some)
    assert features == tuple(rows)
    _, chosen, fitted = ml.train_and_evaluate(some, build.cal, models=(ml.LR,), features=features)
    model = fitted[chosen][0]
    _, _, test = ml.temporal_split(some, build.cal, features)
    importance = {r.feature: r.importance for r in ml.permutation_importance(model, test, repeats=1, features=features).collect()}
    assert importance.keys() == {f for f, _ in rows}
    scores = ml.stockout_scores(some, ml.LR, build.cal, features=features)
    assert scores.count() == some.count() and scores.filter("reasons LIKE '%low stock cover%'").isEmpty()


def test_one_kind_only(spark):
    data = spark.createDataFrame([(float(k % 2), float(k % 7), "ab"[k % 2]) for k in range(60)], "label double, x double, c string")
    for features in ((("x", "numeric"),), (("c", "categorical"),)):
        assert ml.score(ml.make_model(ml.LR, 60, features=features).fit(data), data).filter("score IS NULL").isEmpty()


def test_bad_registries(spark, build):
    s = build.stockout_snapshots
    for bad in ([("no_such_column", "numeric")], [("on_hand", "text")], [("on_hand", "numeric"), ("on_hand", "categorical")]):
        with pytest.raises(ValueError):
            ml.registered(table(spark, bad), s)


def test_profile_counts_missing(spark):
    df = spark.createDataFrame([(True, 1.0, "a"), (True, None, None), (True, 3.0, "b"), (False, 99.0, "c")], "outcome_known boolean, x double, c string")
    got = {r.feature: r for r in ml.feature_profile(df, (("x", "numeric"), ("c", "categorical"))).collect()}
    assert (got["x"].snapshots, got["x"].missing, got["x"].categories, got["x"].least, got["x"].greatest) == (3, 1, None, 0.0, 3.0)
    assert (got["c"].snapshots, got["c"].missing, got["c"].categories, got["c"].mean) == (3, 1, 2, None)
