"""Stockout-risk model on Spark ML: out-of-time split, logistic regression and gradient-boosted
trees against the reorder-point rule, model choice, permutation importance, refit, scores with
risk bands and reason codes.
"""

from __future__ import annotations

from pyspark.ml import Pipeline as MLPipeline
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.config import DEFAULT, FEATURES, MODEL_CHOICE_MARGIN, REASON_MAX, REASON_MIN_DROP, REASONS, Calendar
from godown.plans import metrics
from godown.plans.build import risk_band
from godown.session import cut_lineage

KEYS = ["snapshot_date", "dc_id", "item_id"]
SEED = 7
LR, GBT, RULE = "Logistic regression", "Gradient boosting", "Reorder-point rule"


def registered(table: DataFrame, snapshots: DataFrame) -> tuple[tuple[str, str], ...]:
    """The rows of a feature registry (``feature``, ``kind``; a bounded table), in the order of its ``position`` or of
    the names. A feature that the snapshots lack, an unknown kind and a feature listed twice are errors."""
    rows = sorted((*((r["position"],) if "position" in table.columns else ()), r["feature"], r["kind"]) for r in table.collect())
    features = tuple(r[-2:] for r in rows)
    unknown = [f for f, kind in features if f not in snapshots.columns or kind not in ("numeric", "categorical")]
    if unknown or len({f for f, _ in features}) < len(features):
        raise ValueError(f"features that are unknown or listed twice: {unknown or features}")
    return features


def of_kind(features, kind: str) -> list[str]:
    return [f for f, k in features if k == kind]


def prepared(snapshots: DataFrame, features=FEATURES) -> DataFrame:
    """Numeric features with nulls as 0, categoricals as text, label as double."""
    return snapshots.select(
        *KEYS, "outcome_known", "below_reorder_point", F.col("stockout_14d").cast("double").alias("label"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in of_kind(features, "numeric")],
        *[F.col(c).cast("string").alias(c) for c in of_kind(features, "categorical") if c not in KEYS])


def feature_profile(snapshots: DataFrame, features=FEATURES) -> DataFrame:
    """A row a registered feature, in one pass over the snapshots with a known outcome: ``snapshots``, ``missing`` (nulls),
    ``categories`` (distinct values; null for numbers), and ``mean``, ``least`` and ``greatest`` as the model sees it,
    nulls as 0 (null for categories)."""
    cells = F.explode(F.array(*[F.struct(
        F.lit(f).alias("feature"), F.lit(kind).alias("kind"), F.col(f).isNull().alias("absent"),
        (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if kind == "numeric" else F.lit(None).cast("double")).alias("value"),
        (F.col(f).cast("string") if kind == "categorical" else F.lit(None).cast("string")).alias("text")) for f, kind in features])).alias("x")
    return (snapshots.filter("outcome_known").select(cells).select("x.*").groupBy("feature", "kind")
            .agg(F.count(F.lit(1)).alias("snapshots"), F.count_if("absent").alias("missing"),
                 F.count_distinct("text").alias("categories"), F.round(F.avg("value"), 9).alias("mean"),
                 F.round(F.min("value"), 9).alias("least"), F.round(F.max("value"), 9).alias("greatest"))
            .withColumn("categories", F.when(F.col("kind") == "categorical", F.col("categories"))))


def temporal_split(snapshots: DataFrame, cal: Calendar = DEFAULT, features=FEATURES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labelled, train, test): train up to ``train_end``, test from ``test_start``, the gap unused."""
    labelled = prepared(snapshots, features).filter(F.col("outcome_known"))
    train = labelled.filter(F.col("snapshot_date") <= F.lit(cal.train_end))
    test = labelled.filter(F.col("snapshot_date") >= F.lit(cal.test_start))
    return labelled, train, test


def _encoders(scale: bool, features=FEATURES):
    """Stages that turn the registered features into one vector; either kind may be absent."""
    numeric, categorical = of_kind(features, "numeric"), of_kind(features, "categorical")
    stages, parts = [], []
    if categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categorical]
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                                    dropLast=False, handleInvalid="keep"))
    if numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="num"))
        parts.append("num")
        if scale:
            stages.append(StandardScaler(inputCol="num", outputCol="num_scaled", withMean=True, withStd=True))
            parts = ["num_scaled"]
    stages.append(VectorAssembler(inputCols=[*parts, *[f"{c}_ohe" for c in categorical]], outputCol="features"))
    return stages


def make_model(name: str, n_train: int, gbt_rounds: int = 300, features=FEATURES) -> MLPipeline:
    if name == LR:
        # L2 with C = 0.5 on a summed log-loss equals regParam = 1 / (C n) on Spark's mean loss
        clf = LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / (0.5 * max(n_train, 1)),
                                 elasticNetParam=0.0, standardization=False, maxIter=3000)
        return MLPipeline(stages=[*_encoders(True, features), clf])
    clf = GBTClassifier(featuresCol="features", labelCol="label", maxDepth=4, stepSize=0.05, maxIter=gbt_rounds,
                        seed=SEED, validationIndicatorCol="is_validation", validationTol=0.0001)
    return MLPipeline(stages=[*_encoders(False, features), clf])


def with_validation(df: DataFrame, share: float = 0.1) -> DataFrame:
    """Deterministic 10% validation flag from a hash of the row key (for early stopping)."""
    h = F.abs(F.xxhash64(*[F.col(k).cast("string") for k in KEYS], F.lit(SEED))) % 1000
    return df.withColumn("is_validation", h < int(share * 1000))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def evaluate(scored: DataFrame, share) -> dict:
    """ROC AUC, average precision, Brier and capture at ``share`` for a scored test frame."""
    auc = metrics.roc_auc(scored, "label", "score").first()[0]
    ap = metrics.average_precision(scored, "label", "score").first()[0]
    br = metrics.brier(scored, "label", "score").first()[0]
    cap = metrics.capture_at_share(scored, F.lit(share), "label", "score", KEYS).first()[0]
    return dict(roc_auc=auc, pr_auc=ap, brier=br, capture_at_rule_share=cap)


def train_and_evaluate(snapshots: DataFrame, cal: Calendar = DEFAULT, gbt_rounds: int = 300,
                       models: tuple[str, ...] = (LR, GBT), features=FEATURES):
    """Fit each model on the train window, evaluate on the test window, add the rule, choose.

    Returns (metrics rows, chosen model name, {name: (fitted model, scored test frame)}).
    The train frame is checkpointed: the fitters make many passes over it.
    """
    _, train, test = temporal_split(snapshots, cal, features)
    train = cut_lineage(with_validation(train))
    test = cut_lineage(test)
    n_train, n_test = train.count(), test.count()
    rule = test.select(F.col("below_reorder_point").cast("double").alias("score"), "label", *KEYS)
    rule_share = rule.agg(F.avg("score")).first()[0]
    base_rate = test.agg(F.avg("label")).first()[0]
    rows, fitted = [], {}
    for name in models:
        m = make_model(name, n_train, gbt_rounds, features).fit(train)
        scored = cut_lineage(score(m, test).select(*KEYS, "label", "score"))  # four metrics read it
        fitted[name] = (m, scored)
        rows.append(dict(model=name, **evaluate(scored, rule_share)))
    r = evaluate(rule, rule_share)
    r["brier"] = None
    r["capture_at_rule_share"] = rule.agg(F.sum(F.col("label") * F.col("score")) / F.greatest(F.sum("label"), F.lit(1.0))).first()[0]
    rows.append(dict(model=RULE, **r))
    chosen = choose_model(rows)
    for row in rows:
        row.update(chosen=row["model"] == chosen, base_rate=base_rate, rule_share=rule_share, train_rows=n_train,
                   test_rows=n_test, train_end=cal.train_end.isoformat(), test_start=cal.test_start.isoformat())
    return rows, chosen, fitted


def choose_model(rows: list[dict], margin: float = MODEL_CHOICE_MARGIN) -> str:
    """The linear model unless another model beats its ROC AUC by ``margin`` or more."""
    ml = [r for r in rows if r["model"] != RULE]
    lr = next(r["roc_auc"] for r in ml if r["model"] == LR)
    best = max(ml, key=lambda r: r["roc_auc"])
    return LR if best["roc_auc"] - lr < margin else best["model"]


def metrics_frame(spark, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(r["model"], r["roc_auc"], r["pr_auc"], r["brier"], r["capture_at_rule_share"], r["chosen"], r["base_rate"],
          r["rule_share"], r["train_rows"], r["test_rows"], r["train_end"], r["test_start"]) for r in rows],
        "model string, roc_auc double, pr_auc double, brier double, capture_at_rule_share double, chosen boolean, "
        "base_rate double, rule_share double, train_rows long, test_rows long, train_end string, test_start string")


def permutation_importance(model: PipelineModel, test: DataFrame, repeats: int = 5, features=FEATURES) -> DataFrame:
    """Mean and sd of the ROC AUC drop when one feature's values are permuted across test rows.

    A permutation is a join on row rank: each row takes the feature value of the row whose rank in a hash order (seeded
    per repeat) equals its own rank in key order. The order does not depend on the feature, so there is one ranking a
    repeat; all features and repeats are scored in one long frame and ranked in one pass.
    """
    from godown.operators.prefix import prefix_sums
    features = [f for f, _ in features]
    base = metrics.roc_auc(score(model, test), "label", "score").first()[0]
    ranked, _ = prefix_sums(test.withColumnsRenamed({c: f"_k_{c}" for c in KEYS}).withColumns({c: F.col(f"_k_{c}") for c in KEYS}),
                            [(f"_k_{k}", True) for k in KEYS], {"rid": F.lit(1).cast("long")})
    ranked = cut_lineage(ranked)
    h = F.xxhash64(*[F.col(f"_k_{k}").cast("string") for k in KEYS], F.lit(SEED * 100) + F.col("repeat"))
    hashed = (ranked.select(*[f"_k_{k}" for k in KEYS], F.struct(*features).alias("_donor"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
              .withColumn("_h", h))
    # all repeats are ranked in one pass; each has as many rows as the test frame
    donors, totals = prefix_sums(hashed, [("repeat", True), ("_h", True), *[(f"_k_{k}", True) for k in KEYS]], {"rid": F.lit(1).cast("long")})
    donors = donors.select("repeat", (F.col("rid") - F.col("repeat") * (totals["rid"] // repeats)).alias("rid"), "_donor")
    long = ranked.join(donors, "rid").select("*", F.explode(F.array(*map(F.lit, features))).alias("feature"))
    for f in features:
        long = long.withColumn(f, F.when(F.col("feature") == f, F.col("_donor")[f]).otherwise(F.col(f)))
    auc = metrics.roc_auc_by(score(model, long).select("feature", "repeat", "label", "score"), ["feature", "repeat"])
    return (auc.withColumn("drop", F.lit(base) - F.col("roc_auc")).groupBy("feature")
            .agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std")).orderBy(F.desc("importance")))


def reference_values(labelled: DataFrame, reasons=REASONS) -> dict[str, float]:
    """Reset value per reason factor: the exact median of labelled history, or the listed constant."""
    medians = metrics.exact_medians(labelled, [feat for _, feat, ref in reasons if ref == "median"])
    return {feat: medians[feat] if ref == "median" else float(ref) for _, feat, ref in reasons}


def scores_with_reasons(model, rows: DataFrame, refs: dict[str, float],
                        min_drop: float = REASON_MIN_DROP, top: int = REASON_MAX, reasons=REASONS) -> DataFrame:
    """``model`` is a fitted pipeline or any function adding a ``score`` column.

    Score every row; then score it once per factor with that factor reset, in one long frame
    (variant 0 is the row as is), and keep up to ``top`` factors whose reset lowers the risk by more
    than ``min_drop``, largest first, ties in listed order."""
    variants = F.explode(F.sequence(F.lit(0), F.lit(len(reasons)))).alias("variant")
    long = rows.select("*", variants)
    for i, (_, feat, _) in enumerate(reasons, start=1):
        long = long.withColumn(feat, F.when(F.col("variant") == i, F.lit(refs[feat])).otherwise(F.col(feat)))
    scorer = model if callable(model) else (lambda df: score(model, df))
    s = scorer(long).select(*KEYS, "variant", "score")
    wide = s.groupBy(*KEYS).agg(*[F.max(F.when(F.col("variant") == i, F.col("score"))).alias(f"p{i}")
                                  for i in range(len(reasons) + 1)])
    # drops are compared at 12 decimals so that float noise cannot decide a drop of exactly min_drop
    drops = F.array(*[F.struct(F.round(F.col("p0") - F.col(f"p{i}"), 12).alias("drop"), F.lit(-i).alias("neg_order"),
                               F.lit(label).alias("label")) for i, (label, _, _) in enumerate(reasons, start=1)])
    kept = F.filter(drops, lambda x: x["drop"] > min_drop)
    ordered = F.reverse(F.array_sort(kept))  # by drop, then earlier listed factor first
    texts = F.array_join(F.transform(F.slice(ordered, 1, top), lambda x: x["label"]), ", ")
    return wide.select(*KEYS, F.col("p0").alias("risk_score"), risk_band(F.col("p0")).alias("risk_band"),
                       texts.alias("reasons"))


def stockout_scores(snapshots: DataFrame, chosen: str, cal: Calendar = DEFAULT, gbt_rounds: int = 300,
                    features=FEATURES) -> DataFrame:
    """Refit the chosen model on every labelled snapshot and score every snapshot, with bands and reasons."""
    labelled, _, _ = temporal_split(snapshots, cal, features)
    labelled = cut_lineage(with_validation(labelled))
    final = make_model(chosen, labelled.count(), gbt_rounds, features).fit(labelled)
    reasons = [r for r in REASONS if (r[1], "numeric") in features]
    return scores_with_reasons(final, prepared(snapshots, features), reference_values(labelled, reasons), reasons=reasons)
