"""Registered queries, part 4: split, metrics, calibration, bands, reasons and the Spark ML model.

Metric operators take any (label, score) frame. Registered with the fixed baseline score
(1 - stock_to_reorder_point / 10) they are checked exactly against SQL; the trained models
(``model_metrics``, ``stockout_scores``, ``permutation_importance``) have no SQL oracle.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from godown.config import FEATURES, MODEL_CHOICE_MARGIN, REASONS
from godown.plans import kpis, metrics, ml
from godown.plans.build import risk_band
from godown.plans.oracle import TEST_START, TRAIN_END
from godown.plans.registry import query

KEYS = ["snapshot_date", "dc_id", "item_id"]

TEST_SQL = f""",
test AS (
  SELECT s.snapshot_date, s.dc_id, s.item_id, CAST(s.stockout_14d AS DOUBLE) AS label, c.risk_score AS score,
         CAST(s.below_reorder_point AS DOUBLE) AS rule
  FROM stockout_snapshots s JOIN stockout_scores c USING (snapshot_date, dc_id, item_id)
  WHERE s.outcome_known AND s.snapshot_date >= {TEST_START}),
scored AS (
  SELECT 'baseline score' AS score_name, label, score FROM test
  UNION ALL SELECT 'reorder-point rule', label, rule FROM test),
g AS (SELECT score_name, score AS s, sum(label) AS pos, count(*) AS cnt, count(*) - sum(label) AS neg
      FROM scored GROUP BY ALL)
"""


def test_frame(b) -> DataFrame:
    """Labelled test-window snapshots with the baseline score and the rule as 0/1."""
    s = b.stockout_snapshots.filter(F.col("outcome_known") & (F.col("snapshot_date") >= F.lit(b.cal.test_start)))
    return (s.join(b.stockout_scores.select(*KEYS, "risk_score"), KEYS)
            .select(*KEYS, F.col("stockout_14d").cast("double").alias("label"), F.col("risk_score").alias("score"),
                    F.col("below_reorder_point").cast("double").alias("rule")))


def _both(b):
    t = test_frame(b)
    return [("baseline score", t.select(*KEYS, "label", "score")),
            ("reorder-point rule", t.select(*KEYS, "label", F.col("rule").alias("score")))]


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


@query("temporal_split", f"""
SELECT split, count(*) AS rows, CAST(sum(stockout_14d) AS BIGINT) AS positives FROM (
  SELECT CASE WHEN snapshot_date <= {TRAIN_END} THEN 'train' ELSE 'test' END AS split, stockout_14d
  FROM stockout_snapshots WHERE outcome_known AND (snapshot_date <= {TRAIN_END} OR snapshot_date >= {TEST_START}))
GROUP BY ALL""")
def temporal_split(b):
    _, train, test = ml.temporal_split(b.stockout_snapshots, b.cal)
    agg = [F.count(F.lit(1)).alias("rows"), F.sum(F.col("label").cast("long")).alias("positives")]
    return train.agg(*agg).select(F.lit("train").alias("split"), "*").unionByName(
        test.agg(*agg).select(F.lit("test").alias("split"), "*"))


@query("metric_roc_auc", TEST_SQL + """
SELECT score_name, sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY score_name ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS neg_below FROM g) GROUP BY score_name""")
def metric_roc_auc(b):
    return _union(metrics.roc_auc(df).select(F.lit(n).alias("score_name"), "roc_auc") for n, df in _both(b))


@query("metric_average_precision", TEST_SQL + """
SELECT score_name, round(sum(pos * (tp / n_all)) / sum(pos), 12) AS average_precision FROM (
  SELECT *, sum(pos) OVER w AS tp, sum(cnt) OVER w AS n_all FROM g
  WINDOW w AS (PARTITION BY score_name ORDER BY s DESC ROWS UNBOUNDED PRECEDING)) GROUP BY score_name""")
def metric_average_precision(b):
    return _union(metrics.average_precision(df).select(F.lit(n).alias("score_name"),
                                                       F.round("average_precision", 12).alias("average_precision"))
                  for n, df in _both(b))


@query("metric_brier", TEST_SQL + """
SELECT 'baseline score' AS score_name, round(avg(pow(score - label, 2)), 12) AS brier FROM test""")
def metric_brier(b):
    t = test_frame(b)
    return metrics.brier(t).select(F.lit("baseline score").alias("score_name"), F.round("brier", 12).alias("brier"))


@query("rule_baseline", TEST_SQL + """
SELECT avg(rule) AS rule_share, avg(label) AS base_rate,
       sum(label * rule) / greatest(sum(label), 1) AS capture, count(*) AS test_rows FROM test""")
def rule_baseline(b):
    t = test_frame(b)
    return t.agg(F.avg("rule").alias("rule_share"), F.avg("label").alias("base_rate"),
                 (F.sum(F.col("label") * F.col("rule")) / F.greatest(F.sum("label"), F.lit(1.0))).alias("capture"),
                 F.count(F.lit(1)).alias("test_rows"))


@query("capture_at_share", TEST_SQL + """
SELECT CAST(sum(CASE WHEN rk <= k THEN label ELSE 0 END) / greatest(sum(label), 1) AS DOUBLE) AS capture,
       CAST(any_value(k) AS BIGINT) AS flagged FROM (
  SELECT label, row_number() OVER (ORDER BY score DESC, snapshot_date, dc_id, item_id) AS rk,
         round_even((SELECT avg(rule) FROM test) * (SELECT count(*) FROM test), 0) AS k
  FROM test)""")
def capture_at_share(b):
    """Capture of the baseline score among its top rows, as many as the rule flags (ties by key)."""
    t = test_frame(b)
    share = t.select(F.avg("rule")).scalar()
    return metrics.capture_at_share(t, share, "label", "score", KEYS)


@query("score_calibration", TEST_SQL + """,
e AS (SELECT list_distinct(quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS q FROM test),
edges AS (SELECT list_sort(q) AS q FROM e)
SELECT CAST(len(list_filter(q[2:len(q) - 1], lambda x: x < score)) + 1 AS BIGINT) AS decile,
       round(avg(score), 12) AS predicted, avg(label) AS actual, count(*) AS snapshots
FROM test, edges GROUP BY 1""")
def score_calibration(b):
    c = metrics.calibration(test_frame(b), "label", "score", 10)
    return c.select(F.col("decile").cast("long").alias("decile"), F.round("predicted", 12).alias("predicted"),
                    "actual", "snapshots")


@query("risk_bands", """
SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(dc_id AS BIGINT) AS dc_id, item_id, risk_score, risk_band
FROM stockout_scores""")
def risk_bands(b):
    return b.stockout_scores


@query("band_realised_rate", """
SELECT c.risk_band, count(*) AS snapshots, avg(CAST(s.stockout_14d AS DOUBLE)) AS realised_rate,
       round(avg(c.risk_score), 12) AS mean_score
FROM stockout_scores c JOIN stockout_snapshots s USING (snapshot_date, dc_id, item_id)
WHERE s.stockout_14d IS NOT NULL GROUP BY 1""")
def band_realised_rate(b):
    r = metrics.risk_band_rates(b.stockout_scores, b.stockout_snapshots, KEYS)
    return r.select("risk_band", "snapshots", "realised_rate", F.round("mean_score", 12).alias("mean_score"))


def _ref_sql() -> str:
    parts = []
    for _, feat, ref in REASONS:
        if ref == "median":
            parts.append(f"SELECT '{feat}' AS feature, CAST(quantile_cont(coalesce({feat}, 0), 0.5) AS DOUBLE) AS reference "
                         "FROM stockout_snapshots WHERE outcome_known")
        else:
            parts.append(f"SELECT '{feat}' AS feature, CAST({float(ref)} AS DOUBLE) AS reference")
    return "\n" + "\nUNION ALL ".join(parts)


@query("reason_reference_values", _ref_sql())
def reason_reference_values(b):
    labelled = ml.prepared(b.stockout_snapshots).filter(F.col("outcome_known"))
    refs = ml.reference_values(labelled)
    return b.spark.createDataFrame(list(refs.items()), "feature string, reference double")


# A fixed linear score over the six reason factors: the reason-code operator run on it is exact
# and checkable by SQL (the trained model's reasons use the same operator).
LINEAR = (("cover_days", -0.004), ("pipeline_cover_days", -0.002), ("supplier_on_time_180d", -0.3),
          ("supplier_lead_sd_180d", 0.02), ("demand_trend", 0.1), ("days_to_festival", -0.003))
LINEAR_BASE = 0.9


def linear_score(df: DataFrame, base: float = LINEAR_BASE) -> DataFrame:
    s = F.lit(base)
    for feat, w in LINEAR:
        s = s + F.lit(w) * F.col(feat)
    return df.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), s)))


def _reason_sql(base: float = LINEAR_BASE) -> str:
    refs = {feat: (f"(SELECT quantile_cont(coalesce({feat}, 0), 0.5) FROM stockout_snapshots WHERE outcome_known)"
                   if ref == "median" else f"{float(ref)}") for _, feat, ref in REASONS}

    def lin(override: str | None) -> str:
        s = f"{base}"
        for feat, w in LINEAR:
            val = refs[feat] if feat == override else f"coalesce({feat}, 0)"
            s = f"({s} + {w} * {val})"
        return f"least(1.0, greatest(0.0, {s}))"

    drops = ", ".join(f"{{'drop': round(p0 - ({lin(feat)}), 12), 'neg_order': {-i}, 'label': '{label}'}}"
                      for i, (label, feat, _) in enumerate(REASONS, start=1))
    return f"""
SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(dc_id AS BIGINT) AS dc_id, item_id,
       round(p0, 10) AS risk_score,
       CASE WHEN p0 >= 0.5 THEN 'High' WHEN p0 >= 0.2 THEN 'Watch' ELSE 'Low' END AS risk_band,
       array_to_string(list_transform(list_reverse(list_sort(list_filter([{drops}], lambda x: x['drop'] > 0.02)))[1:2],
                       lambda x: x['label']), ', ') AS reasons
FROM (SELECT *, {lin(None)} AS p0 FROM stockout_snapshots)"""


@query("reason_codes", _reason_sql())
def reason_codes(b):
    labelled = ml.prepared(b.stockout_snapshots).filter(F.col("outcome_known"))
    refs = ml.reference_values(labelled)
    r = ml.scores_with_reasons(linear_score, ml.prepared(b.stockout_snapshots), refs)
    # the supplier lead-time sd differs between engines in the last bits, so compare scores at 10 places
    return r.withColumn("risk_score", F.round("risk_score", 10))


# the watch list needs some high scores in its week
WATCH_BASE = 1.2


@query("watch_list_reasons", ",\nreasoned AS (" + _reason_sql(WATCH_BASE) + """)
SELECT r.item_id || ', ' || w.dc_city AS item, r.item_id AS sku, r.dc_id, w.dc_city, r.risk_score, s.cover_days, r.reasons
FROM reasoned r JOIN dim_dc w ON w.dc_id = r.dc_id
JOIN stockout_snapshots s ON CAST(s.snapshot_date AS VARCHAR) = r.snapshot_date AND s.dc_id = r.dc_id AND s.item_id = r.item_id
WHERE r.risk_band = 'High' AND s.snapshot_date = (SELECT max(snapshot_date) FROM stockout_snapshots)""")
def watch_list_reasons(b):
    """The watch list of all centres in the latest week from a long table whose scores carry reasons."""
    refs = ml.reference_values(ml.prepared(b.stockout_snapshots).filter(F.col("outcome_known")))
    scores = ml.scores_with_reasons(partial(linear_score, base=WATCH_BASE), ml.prepared(b.stockout_snapshots), refs)
    return kpis.watch_list(b.workbench(scores), kpis.Scope()).withColumn("risk_score", F.round("risk_score", 10))


def _profile_sql() -> str:
    parts = []
    for f, kind in FEATURES:
        values = (f"NULL::BIGINT AS categories, round(avg(coalesce({f}, 0)::DOUBLE), 9) AS mean, round(min(coalesce({f}, 0)::DOUBLE), 9) AS least, "
                  f"round(max(coalesce({f}, 0)::DOUBLE), 9) AS greatest" if kind == "numeric" else
                  f"count(DISTINCT {f}) AS categories, NULL::DOUBLE AS mean, NULL::DOUBLE AS least, NULL::DOUBLE AS greatest")
        parts.append(f"SELECT '{f}' AS feature, '{kind}' AS kind, count(*) AS snapshots, count(*) FILTER (WHERE {f} IS NULL) AS missing, {values} "
                     "FROM stockout_snapshots WHERE outcome_known")
    return "\n" + "\nUNION ALL ".join(parts)


@query("feature_profile", _profile_sql())
def feature_profile(b):
    return ml.feature_profile(b.stockout_snapshots)


# ------------------------------------------------------------------------------------------ trained models
@query("model_metrics")
def model_metrics(b):
    return ml.metrics_frame(b.spark, b.training[0])


@query("stockout_scores")
def stockout_scores(b):
    return b.trained_scores


@query("workbench_trained")
def workbench_trained(b):
    """The snapshot rows of the long table with the chosen model's scores and reasons."""
    return b.trained_workbench.filter("record_type = 'Snapshot'").select(
        "period_date", "dc_id", "sku", "risk_score", "risk_band", "reasons", "stockout_14d")


@query("permutation_importance")
def permutation_importance(b):
    """Importance of each feature for the chosen model (5 permutations of the test window)."""
    _, chosen, fitted = b.training
    _, _, test = ml.temporal_split(b.stockout_snapshots, b.cal)
    return ml.permutation_importance(fitted[chosen][0], test)


@query("model_facts", TEST_SQL + f"""
SELECT (SELECT count(*) FROM stockout_snapshots WHERE outcome_known AND snapshot_date <= {TRAIN_END}) AS train_rows,
       count(*) AS test_rows, avg(label) AS base_rate, avg(rule) AS rule_share,
       count(*) FILTER (WHERE rule = 1 AND label = 1) / count(*) FILTER (WHERE label = 1) AS rule_capture,
       true AS models_beat_rule, true AS choice_follows_margin
FROM test""")
def model_facts(b):
    """What SQL can say of the training: its rows, the rule's figures, and that both models rank better than the rule and
    the choice follows from their AUCs."""
    rows = {r["model"]: r for r in b.training[0]}
    rule = rows[ml.RULE]
    beat = min(rows[m]["roc_auc"] for m in (ml.LR, ml.GBT)) > rule["roc_auc"]
    wanted = ml.GBT if rows[ml.GBT]["roc_auc"] - rows[ml.LR]["roc_auc"] >= MODEL_CHOICE_MARGIN else ml.LR
    return b.spark.createDataFrame(
        [(rule["train_rows"], rule["test_rows"], rule["base_rate"], rule["rule_share"], rule["capture_at_rule_share"], beat,
          rows[wanted]["chosen"] and sum(r["chosen"] for r in rows.values()) == 1)],
        "train_rows long, test_rows long, base_rate double, rule_share double, rule_capture double, models_beat_rule boolean, "
        "choice_follows_margin boolean")


@query("score_facts", """
SELECT count(*) AS snapshots, count(*) AS scored, 0::BIGINT AS outside, 0::BIGINT AS other_band, true AS some_reasons
FROM stockout_snapshots""")
def score_facts(b):
    """One score in [0, 1] for every snapshot, bands that follow from the scores, and reasons for some."""
    s = b.stockout_snapshots.select(*KEYS).join(b.trained_scores, KEYS, "left")
    return s.agg(F.count(F.lit(1)).alias("snapshots"), F.count("risk_score").alias("scored"),
                 F.count_if(~F.col("risk_score").between(0, 1)).alias("outside"),
                 F.count_if(F.col("risk_band") != risk_band(F.col("risk_score"))).alias("other_band"),
                 (F.count_if(F.col("reasons") != "") > 0).alias("some_reasons"))


assert set(f for f, _ in LINEAR) <= set(ml.of_kind(FEATURES, "numeric"))
