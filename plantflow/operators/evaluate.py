"""Metrics of a score table `(groups..., label, prob)`, exact and without a global sort.

Every function takes the columns that separate the score sets (`model`,
`split`) and returns one row per set. A set may hold most of the data: counts
are partial aggregates, and ranking metrics run over distinct scores with
two-level running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plantflow.functions.columns import safe_ratio
from plantflow.operators import skew

SETS = ("model", "split")
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def confusion(df: DataFrame, threshold: Column | float = 0.5, sets: Sequence[str] = SETS) -> DataFrame:
    """tn, fp, fn, tp at `prob >= threshold`; the threshold may be a column that is constant per set."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    said, true = F.col("prob") >= cut, F.col("label") == 1
    return df.groupBy(*sets).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("label").cast("bigint").alias("n_positive"),
        F.max(cut).alias("threshold"),
        F.count_if(~said & ~true).alias("tn"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
        F.count_if(said & true).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the confusion counts; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "accuracy": safe_ratio(tp + F.col("tn"), F.col("n_samples")),
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def ranking_metrics(df: DataFrame, sets: Sequence[str] = SETS) -> DataFrame:
    """ROC-AUC (ties count half) and average precision; NULL when a set has one class only."""
    per_score = df.groupBy(*sets, "prob").agg(
        F.sum("label").cast("bigint").alias("tp"), F.sum(1 - F.col("label")).cast("bigint").alias("fp")
    )
    ranked = skew.running_totals(per_score, sets, "prob", ["tp", "fp"], descending=True)
    positives, negatives = F.col("tp_all"), F.col("fp_all")
    area = F.col("fp") * (F.col("tp_upto") - F.col("tp") / 2.0)
    step = F.col("tp") * (F.col("tp_upto") / (F.col("tp_upto") + F.col("fp_upto")))
    totals = ranked.groupBy(*sets).agg(
        F.sum(area).alias("area"),
        F.sum(step).alias("step"),
        F.max(positives).alias("p"),
        F.max(negatives).alias("n"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return totals.select(
        *sets,
        F.when(both, F.col("area") / (F.col("p").cast("double") * F.col("n"))).alias("roc_auc"),
        F.when(both, F.col("step") / F.col("p")).alias("pr_auc"),
    )


def best_threshold(df: DataFrame, sets: Sequence[str] = ("model",)) -> DataFrame:
    """The score, among the scores rounded to 3 decimals, whose cut has the highest F1; the lowest wins ties.

    A candidate is compared with the unrounded scores. Scores are first counted
    per thousandth, so at most about a thousand rows per set reach the window.
    """
    scaled = F.col("prob") * 1000
    floor = F.floor(scaled).cast("int")
    # Largest thousandth that does not exceed the score, exact in spite of the product's rounding.
    mark = (
        F.when((floor + 1) / F.lit(1000.0) <= F.col("prob"), floor + 1)
        .when(floor / F.lit(1000.0) > F.col("prob"), floor - 1)
        .otherwise(floor)
    )
    counted = (
        df.select(*sets, "label", mark.alias("mark"), F.rint(scaled).cast("int").alias("candidate"))
        .groupBy(*sets, "mark", "candidate")
        .agg(F.sum("label").cast("bigint").alias("pos"), F.count(F.lit(1)).alias("n"))
    )
    zero = F.lit(0).cast("bigint")
    entries = F.array(
        F.struct(F.col("mark").alias("at"), F.col("pos"), F.col("n"), F.lit(False).alias("candidate")),
        F.struct(F.col("candidate").alias("at"), zero.alias("pos"), zero.alias("n"), F.lit(True).alias("candidate")),
    )
    line = (
        counted.select(*sets, F.inline(entries))
        .groupBy(*sets, "at")
        .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.max("candidate").alias("candidate"))
    )
    above = W.partitionBy(*sets).orderBy(F.col("at").desc()).rowsBetween(W.unboundedPreceding, 0)
    scored = (
        line.withColumn("tp", F.sum("pos").over(above))
        .withColumn("said", F.sum("n").over(above))
        .withColumn("p", F.sum("pos").over(W.partitionBy(*sets)))
        .filter("candidate")
        .withColumn("f1", safe_ratio(2 * F.col("tp"), F.col("said") + F.col("p")))
    )
    choice = F.max_by(F.struct("at", "f1"), F.struct(F.col("f1"), -F.col("at")))
    return (
        scored.groupBy(*sets)
        .agg(choice.alias("best"))
        .select(*sets, (F.col("best.at") / F.lit(1000.0)).alias("threshold"), F.col("best.f1").alias("f1"))
    )


def evaluate(df: DataFrame, thresholds: DataFrame | None = None, sets: Sequence[str] = SETS, default: float = 0.5) -> DataFrame:
    """All metrics of every set; `thresholds(model, threshold)` gives one cut for all splits of a model."""
    if thresholds is None:
        counted = confusion(df, default, sets)
    else:
        # one row per model, a handful: read once, used as literals by every task
        cuts = thresholds.agg(F.map_from_entries(F.collect_list(F.struct("model", "threshold"))).alias("cuts"))
        cut = F.coalesce(F.try_element_at(cuts.scalar(), F.col("model")), F.lit(float(default)))
        counted = confusion(df.withColumn("_cut", cut), F.col("_cut"), sets)
    return with_rates(counted).join(ranking_metrics(df, sets), list(sets), "left")


def tuned_evaluation(df: DataFrame, tune_on: str = "validation") -> DataFrame:
    """Tune each model's threshold on one split only and evaluate every split with it."""
    return evaluate(df, best_threshold(df.filter(F.col("split") == tune_on)))


def multiclass_report(df: DataFrame, sets: Sequence[str] = ("split",), truth: str = "truth", said: str = "said") -> DataFrame:
    """Accuracy and macro precision, recall and F1 over the labels seen as truth or as prediction."""
    cells = df.groupBy(*sets, truth, said).agg(F.count(F.lit(1)).alias("n"))
    parts = F.array(
        F.struct(F.col(truth).alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), F.when(F.col(truth) == F.col(said), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col(said).alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
    )
    per_label = (
        cells.select(*sets, F.inline(parts))
        .groupBy(*sets, "label")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hit")])
        .withColumn("precision", safe_ratio(F.col("hit"), F.col("predicted")))
        .withColumn("recall", safe_ratio(F.col("hit"), F.col("actual")))
        .withColumn("f1", safe_ratio(2 * F.col("hit"), F.col("predicted") + F.col("actual")))
    )
    return per_label.groupBy(*sets).agg(
        F.sum("actual").alias("n_samples"),
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def confusion_cells(df: DataFrame, sets: Sequence[str] = ("split",), truth: str = "truth", said: str = "said") -> DataFrame:
    return df.groupBy(*sets, truth, said).agg(F.count(F.lit(1)).alias("n"))


# --- class weights --------------------------------------------------------


def positive_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add `weight`: negatives / positives for a positive row, 1 for the others."""
    counts = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n")).alias("c"))
    ratio = (F.col("_c.n") - F.col("_c.p")) / F.greatest(F.col("_c.p"), F.lit(1))
    return (
        df.withColumn("_c", counts.scalar())
        .withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
        .drop("_c")
    )


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight of each class, `n / (classes * n_class)`, one row per class; a row without a label belongs to none."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t"))
    return counts.withColumn("_t", totals.scalar()).select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight")
    )


def with_balanced_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add the balanced class weight to every row; the class table is read as one map. Rows without a label weigh nothing."""
    table = balanced_weights(df, label).agg(F.map_from_entries(F.collect_list(F.struct(label, "weight"))).alias("m"))
    return df.withColumn("weight", F.try_element_at(table.scalar(), F.col(label)))


# --- comparison -----------------------------------------------------------


def long_metrics(metrics: DataFrame, names: Sequence[str] = tuple([*METRICS, "tn", "fp", "fn", "tp", "threshold", "n_samples", "n_positive"])) -> DataFrame:
    """Metrics as `(model, metric, value)` named `<split>_<metric>`; undefined ones are left out."""
    doubles = metrics.select("model", "split", *[F.col(c).cast("double").alias(c) for c in names])
    tall = doubles.unpivot(["model", "split"], list(names), "name", "value")
    cell = F.when(F.col("name").isin("tn", "fp", "fn", "tp"), F.concat(F.lit("cm_"), "name")).otherwise(F.col("name"))
    return tall.filter(F.col("value").isNotNull()).select(
        "model", F.concat_ws("_", "split", cell).alias("metric"), "value"
    )


def compare_models(*metrics: DataFrame, splits: Sequence[str] = ("validation", "test")) -> DataFrame:
    """One row per model with its metrics of the chosen splits side by side, from any number of metric tables."""
    stacked = metrics[0]
    for other in metrics[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    wanted = [m for m in METRICS if m != "accuracy"]
    chosen = stacked.filter(F.col("split").isin(list(splits)))
    return chosen.groupBy("model").agg(
        *[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in splits for m in wanted]
    )


def best_model(metrics: DataFrame, order: Sequence[str], split: str = "validation") -> DataFrame:
    """The model with the highest F1 on a split; the one named first in `order` wins ties."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    candidates = metrics.filter(F.col("split") == split)
    best = F.max_by(F.struct("model", "f1"), F.struct(F.col("f1"), -F.when(place == 0, len(order) + 1).otherwise(place)))
    return candidates.agg(best.alias("b")).select(F.col("b.model").alias("model"), F.col("b.f1").alias("f1"))
