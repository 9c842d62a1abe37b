"""Queries: metrics of score tables, thresholds, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow.operators import evaluate, score
from plantflow.plans import sql_tables  # noqa: F401  (defines the common tables)
from plantflow.plans.registry import common, query, rounded
from plantflow.session import durable
from plantflow.sources import star_inputs as inputs

_COUNTS = """count(*) AS n_samples, CAST(sum(label) AS BIGINT) AS n_positive, max(t) AS threshold,
  count(*) FILTER (prob < t AND label = 0) AS tn, count(*) FILTER (prob >= t AND label = 0) AS fp,
  count(*) FILTER (prob < t AND label = 1) AS fn, count(*) FILTER (prob >= t AND label = 1) AS tp"""
_RATES = """round((tp + tn) / n_samples, 6) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""

common(
    "ranking",
    """
SELECT model, split, CASE WHEN p > 0 AND n > 0 THEN area / (p::DOUBLE * n) END AS roc_auc, CASE WHEN p > 0 AND n > 0 THEN step / p END AS pr_auc FROM (
  SELECT model, split, sum(fp * (ctp - tp / 2.0)) AS area, sum(tp * (ctp / (ctp + cfp)::DOUBLE)) AS step, max(ctp) AS p, max(cfp) AS n FROM (
    SELECT *, CAST(sum(tp) OVER w AS DOUBLE) AS ctp, CAST(sum(fp) OVER w AS DOUBLE) AS cfp FROM (
      SELECT model, split, prob, CAST(sum(label) AS DOUBLE) AS tp, CAST(sum(1 - label) AS DOUBLE) AS fp FROM scored GROUP BY model, split, prob)
    WINDOW w AS (PARTITION BY model, split ORDER BY prob DESC)) GROUP BY model, split)""",
    ("scored",),
)
common(
    "thresholds",
    """
SELECT model, arg_max(t, (f1, -t)) AS threshold, max(f1) AS f1 FROM (
  SELECT c.model, c.t, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1 FROM (
    SELECT c.model, c.t, count(*) FILTER (s.prob >= c.t AND s.label = 1) AS tp, count(*) FILTER (s.prob >= c.t AND s.label = 0) AS fp, count(*) FILTER (s.prob < c.t AND s.label = 1) AS fn
    FROM (SELECT DISTINCT model, round_even(prob * 1000, 0)::DOUBLE / 1000.0::DOUBLE AS t FROM scored WHERE split = 'validation') c
    JOIN (SELECT * FROM scored WHERE split = 'validation') s ON s.model = c.model GROUP BY c.model, c.t) c) GROUP BY model""",
    ("scored",),
)
common(
    "tuned_metrics",
    f"""
SELECT c.model, c.split, n_samples, n_positive, round(threshold, 6) AS threshold, tn, fp, fn, tp, {_RATES}, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM (SELECT s.model, s.split, {_COUNTS} FROM scored s JOIN (SELECT model, threshold AS t FROM thresholds) USING (model) GROUP BY s.model, s.split) c
LEFT JOIN ranking r ON r.model = c.model AND r.split = c.split""",
    ("scored", "ranking", "thresholds"),
)


@query("confusion_counts", f"SELECT model, split, {_COUNTS} FROM (SELECT *, 0.5::DOUBLE AS t FROM scored) GROUP BY model, split", ("scored",))
def confusion_counts(spark, sf_dir):
    return evaluate.confusion(inputs.scored(spark, sf_dir))


@query(
    "rate_metrics",
    f"SELECT model, split, {_RATES} FROM (SELECT model, split, {_COUNTS} FROM (SELECT *, 0.6::DOUBLE AS t FROM scored) GROUP BY model, split)",
    ("scored",),
)
def rate_metrics(spark, sf_dir):
    rates = evaluate.with_rates(evaluate.confusion(inputs.scored(spark, sf_dir), 0.6))
    return rounded(rates.select("model", "split", "accuracy", "precision", "recall", "f1"))


@query("ranking_metrics", "SELECT model, split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM ranking", ("ranking",))
def ranking_metrics(spark, sf_dir):
    """ROC-AUC and average precision; the counter score is full of ties."""
    return rounded(evaluate.ranking_metrics(inputs.scored(spark, sf_dir)))


@query(
    "one_class_ranking",
    "SELECT split, CAST(NULL AS DOUBLE) AS roc_auc, CAST(NULL AS DOUBLE) AS pr_auc FROM scored GROUP BY split",
    ("scored",),
)
def one_class_ranking(spark, sf_dir):
    """Ranking metrics are NULL when only one class occurs."""
    return evaluate.ranking_metrics(inputs.scored(spark, sf_dir).filter(F.col("label") == 0), ["split"])


@query("threshold_by_f1", "SELECT model, round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM thresholds", ("thresholds",))
def threshold_by_f1(spark, sf_dir):
    return rounded(evaluate.best_threshold(inputs.scored(spark, sf_dir).filter(F.col("split") == "validation")))


@query("tuned_evaluation", "SELECT * FROM tuned_metrics", ("tuned_metrics",))
def tuned_evaluation(spark, sf_dir):
    """Threshold tuned on validation only; every split evaluated with it."""
    return rounded(evaluate.tuned_evaluation(inputs.scored(spark, sf_dir)))


@query(
    "long_metrics",
    """
SELECT model, split || '_' || CASE WHEN name IN ('tn', 'fp', 'fn', 'tp') THEN 'cm_' || name ELSE name END AS metric, value
FROM (UNPIVOT (SELECT model, split, accuracy::DOUBLE AS accuracy, precision::DOUBLE AS precision, recall::DOUBLE AS recall, f1::DOUBLE AS f1, roc_auc, pr_auc, tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp, threshold, n_samples::DOUBLE AS n_samples, n_positive::DOUBLE AS n_positive FROM tuned_metrics)
  ON accuracy, precision, recall, f1, roc_auc, pr_auc, tn, fp, fn, tp, threshold, n_samples, n_positive INTO NAME name VALUE value)""",
    ("tuned_metrics",),
)
def long_metrics(spark, sf_dir):
    return rounded(evaluate.long_metrics(evaluate.tuned_evaluation(inputs.scored(spark, sf_dir))))


@query(
    "model_comparison",
    "SELECT model, "
    + ", ".join(f"max({m}) FILTER (split = '{s}') AS {s}_{m}" for s in ("validation", "test") for m in ("precision", "recall", "f1", "roc_auc", "pr_auc"))
    + " FROM tuned_metrics GROUP BY model",
    ("tuned_metrics",),
)
def model_comparison(spark, sf_dir):
    metrics = durable(evaluate.tuned_evaluation(inputs.scored(spark, sf_dir)))
    one, two = metrics.filter(F.col("model") == "ratio"), metrics.filter(F.col("model") != "ratio")
    return rounded(evaluate.compare_models(one, two))


@query(
    "best_model",
    "SELECT model, f1 FROM tuned_metrics WHERE split = 'validation' ORDER BY f1 DESC, CASE model WHEN 'ratio' THEN 1 ELSE 2 END LIMIT 1",
    ("tuned_metrics",),
)
def best_model(spark, sf_dir):
    return rounded(evaluate.best_model(evaluate.tuned_evaluation(inputs.scored(spark, sf_dir)), ["ratio", "counter"]))


_NOTES = """SELECT split, CASE event_id % 4 WHEN 0 THEN 'Scheduled' WHEN 1 THEN 'Mechanical' WHEN 2 THEN 'Electrical' ELSE 'Quality' END AS truth,
  CASE WHEN k < 40 THEN CASE event_id % 4 WHEN 0 THEN 'Scheduled' WHEN 1 THEN 'Mechanical' WHEN 2 THEN 'Electrical' ELSE 'Quality' END WHEN k < 60 THEN 'Other' ELSE 'Scheduled' END AS said
FROM (SELECT *, CASE WHEN day(ts) <= 17 THEN 'train' WHEN day(ts) <= 22 THEN 'validation' ELSE 'test' END AS split FROM ev) WHERE day(ts) <= 30"""


def _said(spark, sf_dir):
    from plantflow.operators import features

    events = features.time_split(inputs.events(spark, sf_dir), inputs.EVENT_DAYS, date="ts")
    kind = F.element_at(F.array(*[F.lit(v) for v in ("Scheduled", "Mechanical", "Electrical", "Quality")]), (F.col("event_id") % 4 + 1).cast("int"))
    return events.select(
        "split", kind.alias("truth"), F.when(F.col("k") < 40, kind).when(F.col("k") < 60, "Other").otherwise("Scheduled").alias("said")
    )


@query(
    "multiclass_report",
    f"""
WITH said AS ({_NOTES}), labels AS (SELECT DISTINCT split, truth AS label FROM said UNION SELECT DISTINCT split, said FROM said),
per AS (SELECT l.split, l.label, count(*) FILTER (s.truth = l.label)::DOUBLE AS actual, count(*) FILTER (s.said = l.label)::DOUBLE AS predicted, count(*) FILTER (s.truth = l.label AND s.said = l.label)::DOUBLE AS hit
  FROM labels l JOIN said s ON s.split = l.split GROUP BY l.split, l.label)
SELECT split, CAST(sum(actual) AS BIGINT) AS n_samples, round(sum(hit) / sum(actual), 6) AS accuracy, round(avg(CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END), 6) AS precision_macro,
  round(avg(CASE WHEN actual = 0 THEN 0 ELSE hit / actual END), 6) AS recall_macro, round(avg(CASE WHEN actual + predicted = 0 THEN 0 ELSE 2 * hit / (actual + predicted) END), 6) AS f1_macro FROM per GROUP BY split""".replace(
        "WITH said AS", "SELECT * FROM (WITH said AS", 1
    )
    + ")",
    ("ev",),
)
def multiclass_report(spark, sf_dir):
    return rounded(evaluate.multiclass_report(_said(spark, sf_dir)))


@query("multiclass_confusion", f"SELECT split, truth, said, count(*) AS n FROM ({_NOTES}) GROUP BY ALL", ("ev",))
def multiclass_confusion(spark, sf_dir):
    return evaluate.confusion_cells(_said(spark, sf_dir))


@query(
    "misclassified_rows",
    "SELECT model, split, id, label, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS predicted, round(prob, 6) AS prob FROM scored WHERE label <> CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END",
    ("scored",),
)
def misclassified_rows(spark, sf_dir):
    said = inputs.scored(spark, sf_dir).withColumn("predicted", (F.col("prob") >= 0.5).cast("int"))
    return rounded(score.misclassified(said))


@query(
    "risk_levels",
    "SELECT model, id, CASE WHEN prob >= 0.7 THEN 1 ELSE 0 END AS predicted_failure, CASE WHEN prob >= 0.7 THEN 'HIGH' WHEN prob < 0.35 THEN 'LOW' ELSE 'MEDIUM' END AS risk_level FROM scored",
    ("scored",),
)
def risk_levels(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    return score.risk(scored, 0.7).select("model", "id", "predicted_failure", "risk_level")


@query(
    "class_confidence",
    "SELECT model, id, CASE WHEN prob >= 0.5 THEN 'defect' ELSE 'normal' END AS prediction, round(CASE WHEN prob >= 0.5 THEN prob ELSE 1 - prob END, 6) AS confidence FROM scored",
    ("scored",),
)
def class_confidence(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    return rounded(score.binary_decision(scored).select("model", "id", "prediction", "confidence"))
