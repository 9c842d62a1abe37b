"""Feature attribution per prediction and its wording."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plantflow import wording
from plantflow.functions import columns as fn
from plantflow.operators.score import Scorer

TOP_FEATURES = 5


def neutralisation_importance(windows: DataFrame, features: Sequence[str], scorer: Scorer, key: Sequence[str] = ("machine_id",)) -> DataFrame:
    """How far the score falls when one feature is set to its training mean in the whole window.

    `windows` hold standardised values, so the mean is 0. Each window becomes one
    row per feature plus itself, all scored in a single batch call:
    `(key..., base_prob, feature, value, contribution)`. `value` is the feature's
    real value in the last row, from the array `actual` where windows carry one.
    """
    key = list(key)
    if "actual" not in windows.columns:
        windows = windows.withColumn("actual", F.element_at("window", -1))
    changed = F.explode(F.sequence(F.lit(0), F.lit(len(features))))
    varied = windows.select(*key, "window", "actual", changed.alias("_f")).withColumn(
        "varied",
        F.transform("window", lambda row: F.transform(row, lambda v, i: F.when(i + 1 == F.col("_f"), F.lit(0.0)).otherwise(v))),
    )
    scored = scorer(varied, "varied")
    base = F.max(F.when(F.col("_f") == 0, F.col("prob"))).over(W.partitionBy(*key))
    names = F.array(*[F.lit(f) for f in features])
    return (
        scored.withColumn("base_prob", base)
        .filter(F.col("_f") > 0)
        .select(
            *key,
            "base_prob",
            F.element_at(names, F.col("_f")).alias("feature"),
            F.element_at("actual", F.col("_f")).alias("value"),
            (F.col("base_prob") - F.col("prob")).alias("contribution"),
            F.col("_f").alias("feature_order"),
        )
    )


def linear_contributions(rows: DataFrame, background: DataFrame, coefficients: dict[str, float], key: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Contribution of each feature of a linear model: coefficient times the distance from the background mean."""
    names = list(coefficients)
    means = background.agg(F.struct(*[F.avg(c).alias(c) for c in names]).alias("m"))
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(c).cast("double").alias("value"),
                (F.lit(float(coefficients[c])) * (F.col(c) - F.col(f"_m.{c}"))).alias("contribution"),
                F.lit(i + 1).alias("feature_order"),
            )
            for i, c in enumerate(names)
        ]
    )
    return rows.withColumn("_m", means.scalar()).select(*key, F.inline(entries))


def background_sample(df: DataFrame, id_column: str, n: int = 50, seed: int = 42) -> DataFrame:
    """A seeded sample of exactly `n` rows (all rows if fewer): the smallest hashes, found without a full sort."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_column).cast("string")).cast("binary"))
    return df.orderBy(digest, F.col(id_column)).limit(n)


def top_contributions(contributions: DataFrame, key: Sequence[str] = ("machine_id",), k: int = TOP_FEATURES) -> DataFrame:
    """The `k` strongest features per key with their rank and direction."""
    strongest = W.partitionBy(*key).orderBy(F.abs("contribution").desc(), F.col("feature_order"))
    return (
        contributions.withColumn("rank", F.row_number().over(strongest))
        .filter(F.col("rank") <= k)
        .withColumns({"direction": fn.direction("contribution"), "contribution": F.round("contribution", 6)})
        .drop("feature_order")
    )


def explanation_lists(top: DataFrame, key: Sequence[str] = ("machine_id",)) -> DataFrame:
    """The ranked features of each key as one array of records."""
    record = F.struct("rank", "feature", "value", "contribution", "direction")
    return top.groupBy(*key).agg(F.sort_array(F.collect_list(record)).alias("feature_explanations"))


def _named(explanations: Column, direction: str, limit: int) -> Column:
    chosen = F.filter(explanations, lambda e: e["direction"] == direction)
    names = F.transform(F.slice(chosen, 1, limit), lambda e: fn.readable(e["feature"]))
    return F.when(F.size(chosen) > 0, F.array_join(names, ", "))


def human_summary(risk_level: Column, probability: Column, explanations: Column, vision_class: Column, vision_confidence: Column) -> Column:
    """One paragraph from whatever parts are available."""
    explanations = F.coalesce(explanations, F.array().cast("array<struct<rank:int,feature:string,value:double,contribution:double,direction:string>>"))
    up, down = _named(explanations, "increases_risk", 3), _named(explanations, "decreases_risk", 2)
    parts = F.array(
        F.when(risk_level.isNotNull(), F.format_string(wording.SUMMARY_RISK, risk_level, fn.percent(F.coalesce(probability, F.lit(0.0)))))
        .when(probability.isNull(), F.lit(wording.SUMMARY_NO_RISK)),
        F.when(up.isNotNull(), F.format_string(wording.SUMMARY_UP, up)),
        F.when(down.isNotNull(), F.format_string(wording.SUMMARY_DOWN, down)),
        F.when(vision_class == "defect", F.format_string(wording.SUMMARY_DEFECT, fn.percent(vision_confidence)))
        .when(vision_class.isNotNull(), F.format_string(wording.SUMMARY_NO_DEFECT, fn.percent(vision_confidence))),
    )
    said = F.array_compact(parts)
    return F.when(F.size(said) == 0, F.lit(wording.SUMMARY_NONE)).otherwise(F.array_join(said, " "))


def explanation_record(findings: DataFrame) -> DataFrame:
    """Add the explanation record of every machine: each part says whether it is available and why not.

    Reads `pm_status, pm_reason, failure_probability, predicted_failure, risk_level,
    feature_explanations, vision_status, vision_reason, vision_class, vision_confidence`.
    """
    scored = F.col("pm_status") == "ok"
    seen = F.col("vision_status") == "ok"
    empty = F.array().cast("array<struct<rank:int,feature:string,value:double,contribution:double,direction:string>>")
    features = F.when(scored, F.coalesce(F.col("feature_explanations"), empty)).otherwise(empty)
    record = F.struct(
        F.struct(
            F.col("pm_status").alias("status"),
            F.when(~scored, F.col("pm_reason")).alias("reason"),
            F.when(scored, F.col("failure_probability")).alias("probability"),
            F.when(scored, F.col("predicted_failure")).alias("predicted_failure"),
            F.when(scored, F.col("risk_level")).alias("risk_level"),
        ).alias("prediction"),
        features.alias("feature_explanations"),
        F.transform(features, lambda f: f["feature"]).alias("top_features"),
        F.struct(
            seen.alias("available"),
            F.when(~seen, F.col("vision_reason")).alias("reason"),
            F.when(seen, F.col("vision_class")).alias("predicted_class"),
            F.when(seen, F.col("vision_confidence")).alias("confidence"),
        ).alias("vision_explanation"),
        human_summary(
            F.when(scored, F.col("risk_level")),
            F.col("failure_probability"),
            features,
            F.when(seen, F.col("vision_class")),
            F.col("vision_confidence"),
        ).alias("human_summary"),
        F.struct(
            F.when(scored, F.lit("permutation_importance")).otherwise("unavailable").alias("tabular"),
            F.when(seen, F.lit("classifier")).otherwise("unavailable").alias("vision"),
        ).alias("method"),
    )
    return findings.withColumn("xai", record)
