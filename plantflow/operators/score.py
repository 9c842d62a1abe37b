"""Recent windows, sequences and batch scoring of every machine at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plantflow.config import SEQUENCE_SHIFTS, SHIFTS
from plantflow.functions import columns as fn
from plantflow.operators import skew
from plantflow.operators.features import shift_sequence

SPLITS_NEWEST_FIRST = ("test", "validation", "train")

Scorer = Callable[[DataFrame, str], DataFrame]


def _split_rank(split: str = "split") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SPLITS_NEWEST_FIRST]), F.col(split))


def latest_rows(df: DataFrame, n: int, key: str = "machine_id", order: Sequence[Column] | None = None) -> DataFrame:
    """The latest `n` rows per key, only for keys that have as many; `position` 1 is the oldest.

    Ranks are cut to `n` before the shuffle, so a large key sends `n` rows per task.
    """
    latest = order or [F.col("sim_day").desc(), fn.shift_order("shift").desc()]
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*latest))).filter(F.col("_rank") <= n)
    counted = ranked.withColumn("_have", F.count(F.lit(1)).over(W.partitionBy(key)))
    return counted.filter(F.col("_have") == n).withColumn("position", n + 1 - F.col("_rank")).drop("_rank", "_have")


def latest_window(df: DataFrame, n: int = SEQUENCE_SHIFTS, key: str = "machine_id") -> DataFrame:
    """The latest `n` shifts per machine from the newest split that holds as many for it."""
    order = W.partitionBy(key, "split").orderBy(F.col("sim_day").desc(), fn.shift_order("shift").desc())
    ranked = df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
    full = (
        ranked.withColumn("_have", F.count(F.lit(1)).over(W.partitionBy(key, "split")))
        .filter(F.col("_have") == n)
        .withColumn("_split_rank", _split_rank())
    )
    chosen = full.withColumn("_best", F.min("_split_rank").over(W.partitionBy(key)))
    return (
        chosen.filter(F.col("_split_rank") == F.col("_best"))
        .withColumn("position", n + 1 - F.col("_rank"))
        .drop("_rank", "_have", "_split_rank", "_best")
    )


def latest_record(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row per key by an explicit order: a plain aggregate, whatever the size of the key."""
    last = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(key).agg(last.alias("_last")).select("_last.*")


def _vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def sequences(
    df: DataFrame,
    columns: Sequence[str],
    n: int = SEQUENCE_SHIFTS,
    within: Sequence[str] = ("split",),
    keep: Sequence[str] = ("machine_id", "split", "sim_day", "date", "shift"),
    label: str | None = None,
) -> DataFrame:
    """Sliding windows of `n` consecutive shifts per machine, `window array<array<double>>`.

    Windows stay inside one value of `within`; the label is that of the last
    row. Pass `within=()` for windows across all splits.
    """
    order = [F.col("sim_day"), fn.shift_order("shift", SHIFTS)]
    rows = W.partitionBy("machine_id", *within).orderBy(*order).rowsBetween(-(n - 1), 0)
    wanted = [c for c in keep if c in df.columns]
    stacked = df.withColumn("window", F.collect_list(_vector(columns)).over(rows))
    return stacked.filter(F.size("window") == n).select(*wanted, *([label] if label else []), "window")


def window_as_of(
    df: DataFrame,
    columns: Sequence[str],
    day: int,
    shift: str,
    n: int = SEQUENCE_SHIFTS,
    keep: Sequence[str] = ("machine_id", "split", "sim_day", "date", "shift"),
    label: str | None = None,
) -> DataFrame:
    """The windows of `n` shifts that end at one (day, shift), across all splits; one per machine that has it.

    Only rows up to the anchor are read, and of each machine only its last `n` are
    ranked and stacked.
    """
    place = fn.shift_order("shift", SHIFTS)
    anchor = fn.shift_order(F.lit(shift), SHIFTS)
    until = df.filter((F.col("sim_day") < day) | ((F.col("sim_day") == day) & (place <= anchor)))
    latest = W.partitionBy("machine_id").orderBy(F.col("sim_day").desc(), place.desc())
    last = until.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= n)
    wanted = [c for c in keep if c in df.columns] + ([label] if label else [])
    stacked = last.groupBy("machine_id").agg(
        F.min_by(F.struct(*wanted), "_back").alias("_last"),
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("o"), _vector(columns).alias("v")))), lambda r: r["v"]
        ).alias("window"),
    )
    ends = (F.col("_last.sim_day") == day) & (F.col("_last.shift") == shift)
    return stacked.filter((F.size("window") == n) & ends).select("_last.*", "window")


ANCHOR = "anchor"


def anchored_rows(
    df: DataFrame, anchors: DataFrame, n: int = SEQUENCE_SHIFTS, key: str = "machine_id", order: Sequence[str] = ("sim_day", "shift")
) -> DataFrame:
    """The `n` rows up to each anchor `(machine, day, shift)`, across all splits, for any number of anchors at once.

    Adds `anchor` (`machine|day|shift`) and `position` (1 is the oldest). An anchor that the table does not hold, or
    with fewer rows up to it, has none. One sorted pass over the machines: every row looks `n` rows ahead for anchors,
    and only rows that stand before one go on; a row that several anchors share is copied for each.
    """
    day, shift = order
    wanted = anchors.select(key, day, shift).filter(F.col(key).isNotNull()).distinct().withColumn("_anchored", F.lit(True))
    marked = df.join(skew.checked_broadcast(wanted), [key, day, shift], "left")
    by_time = W.partitionBy(key).orderBy(F.col(day), fn.shift_order(shift, SHIFTS))
    here = F.when(F.col("_anchored"), F.struct(F.col("_place").alias("at"), F.concat_ws("|", key, day, shift).alias("anchor")))
    placed = marked.withColumn("_place", F.row_number().over(by_time))
    ahead = placed.withColumn("_ahead", F.collect_list(here).over(by_time.rowsBetween(0, n - 1)))
    near = ahead.withColumn("_a", F.explode(F.filter("_ahead", lambda a: a["at"] >= n)))
    return near.select(*df.columns, F.col("_a.anchor").alias(ANCHOR), (n + F.col("_place") - F.col("_a.at")).cast("int").alias("position"))


def window_arrays(rows: DataFrame, columns: Sequence[str], key: str = "machine_id") -> DataFrame:
    """Latest rows as one array per machine, oldest first."""
    ordered = F.sort_array(F.collect_list(F.struct("position", _vector(columns).alias("v"))))
    return rows.groupBy(key).agg(F.transform(ordered, lambda r: r["v"]).alias("window"))


# --- scorers --------------------------------------------------------------


@dataclass(frozen=True)
class RecurrentWeights:
    """Weights of a one-layer gated recurrent classifier over `[input, state]`."""

    wz: np.ndarray
    bz: np.ndarray
    wr: np.ndarray
    br: np.ndarray
    wn: np.ndarray
    bn: np.ndarray
    wo: np.ndarray
    bo: np.ndarray

    @property
    def hidden(self) -> int:
        return len(self.bz)

    @property
    def inputs(self) -> int:
        return self.wz.shape[0] - self.hidden

    @staticmethod
    def from_table(table: DataFrame) -> RecurrentWeights:
        """Read `(name, rows, values)`; eight small arrays."""
        stored = table.collect()
        parts = {r["name"]: np.array(r["values"], dtype=float) for r in stored}
        shapes = {r["name"]: r["rows"] for r in stored}
        return RecurrentWeights(**{k: v.reshape(shapes[k], -1) if k.startswith("w") else v for k, v in parts.items()})

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(k, int(np.shape(v)[0]), [float(x) for x in np.ravel(v)]) for k, v in vars(self).items()]
        return spark.createDataFrame(rows, "name string, rows int, values array<double>")

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        """Failure probability of each sequence in `(rows, steps, inputs)`."""

        def squash(x: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))

        state = np.zeros((batch.shape[0], self.hidden))
        for step in batch.transpose(1, 0, 2):
            joined = np.hstack([step, state])
            keep, reset = squash(joined @ self.wz + self.bz), squash(joined @ self.wr + self.br)
            candidate = np.tanh(np.hstack([step, reset * state]) @ self.wn + self.bn)
            state = (1.0 - keep) * candidate + keep * state
        return squash(state @ self.wo + self.bo).ravel()


def recurrent_scorer(weights: RecurrentWeights) -> Scorer:
    """Score an array-of-arrays column in Arrow batches; the weights travel as one broadcast."""

    def score(df: DataFrame, column: str = "window") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(weights)

        @F.pandas_udf("double")
        def forward(flat: pd.Series) -> pd.Series:
            model = shared.value
            if flat.empty:
                return pd.Series([], dtype=float)
            batch = np.stack(flat.to_numpy()).astype(float).reshape(len(flat), -1, model.inputs)
            return pd.Series(model.probabilities(batch))

        return df.withColumn("prob", forward(F.flatten(column)))

    return score


def linear_scorer(coefficients: Sequence[float], intercept: float = 0.0) -> Scorer:
    """Logistic score of the window's mean vector, as a plain column expression."""

    def score(df: DataFrame, column: str = "window") -> DataFrame:
        rows = F.col(column)
        weights = F.array(*[F.lit(float(c)) for c in coefficients])
        total = F.aggregate(rows, F.lit(0.0), lambda s, row: s + fn.dot(row, weights))
        return df.withColumn("prob", fn.sigmoid(F.lit(float(intercept)) + total / F.size(rows)))

    return score


def risk(df: DataFrame, threshold: float = 0.5, prob: str = "prob") -> DataFrame:
    """Prediction and risk level from the tuned threshold."""
    return df.withColumns(
        {
            "predicted_failure": (F.col(prob) >= threshold).cast("int"),
            "risk_level": fn.risk_level(prob, threshold),
        }
    )


def important_signals(df: DataFrame, columns: Sequence[str], means: dict, stds: dict, k: int = 3) -> DataFrame:
    """Add the names of the `k` columns that deviate most from training, ranked inside the row."""
    deviations = [
        F.struct(
            F.coalesce(-F.abs((F.col(c) - means[c]) / stds[c]), F.lit(float("inf"))).alias("d"),
            F.lit(i).alias("i"),
            F.lit(c).alias("name"),
        )
        for i, c in enumerate(columns)
    ]
    ranked = F.slice(F.array_sort(F.array(*deviations)), 1, k)
    return df.withColumn("important_signals", F.transform(ranked, lambda d: d["name"]))


def binary_decision(df: DataFrame, prob: str = "prob", positive: str = "defect", negative: str = "normal") -> DataFrame:
    """Class name and the confidence of that class."""
    yes = F.col(prob) >= 0.5
    return df.withColumns(
        {
            "prediction": F.when(yes, positive).otherwise(negative),
            "confidence": F.when(yes, F.col(prob)).otherwise(1.0 - F.col(prob)),
        }
    )


def misclassified(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return df.filter(F.col(label) != F.col(predicted))
