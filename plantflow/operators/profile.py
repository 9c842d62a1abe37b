"""Descriptive aggregates and train-only statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from plantflow.config import DANGER_SIGMA, TARGET, WARNING_SIGMA
from plantflow.operators import skew


def numeric_columns(df: DataFrame, skip: Sequence[str] = (TARGET, "sim_day")) -> list[str]:
    """Names of the numeric columns, without the label and the day number."""
    kinds = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [c for c, kind in df.dtypes if (kind in kinds or kind.startswith("decimal")) and c not in skip]


def rate_by_key(df: DataFrame, target: str = TARGET, key: str = "machine_id", digits: int = 4) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.avg(target), digits).alias("rate"))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing values and duplicate rows, in one row.

    Rows are first combined with their copies, so the totals follow from the
    distinct rows without a second read.
    """
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    missing = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return distinct.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum(missing * F.col("_copies")), F.lit(0)).alias("missing_values_total"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str], digits: int = 3, hot: bool | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column."""
    columns = list(columns)
    basics = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    quartiles = skew.exact_quantiles(df, [], columns, [0.25, 0.5, 0.75], hot=hot)
    both = basics.withColumn("_q", quartiles.select(F.struct(*columns)).scalar())
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}.count").alias("count"),
            *[F.round(F.col(f"{c}.{m}"), digits).alias(m) for m in ("mean", "std", "min")],
            *[
                F.round(F.element_at(F.col(f"_q.{c}"), i), digits).alias(name)
                for i, name in ((1, "q25"), (2, "q50"), (3, "q75"))
            ],
            F.round(F.col(f"{c}.max"), digits).alias("max"),
        )
        for c in columns
    ]
    return both.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are known, `(a, b, r)`.

    One aggregate; each unordered pair is computed once. `corr` itself skips a
    row where either side is NULL.
    """
    pairs = list(combinations(columns, 2))

    def pair_column(name: str, other: str) -> str:
        return f"{name}|{other}"

    totals = df.agg(
        *[F.corr(a, b).alias(pair_column(a, b)) for a, b in pairs],
        *[F.when(F.var_pop(c) > 0, F.lit(1.0)).alias(pair_column(c, c)) for c in columns],
    )
    rows = []
    for a in columns:
        for b in columns:
            source = pair_column(a, b) if pair_column(a, b) in totals.columns else pair_column(b, a)
            rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{source}`"), digits).alias("r")))
    return totals.select(F.inline(F.array(*rows)))


def scaler_statistics(df: DataFrame, columns: Sequence[str], split: str = "train") -> DataFrame:
    """Mean and sample deviation on the training rows, `(column, mean, std)`; a zero deviation becomes 1."""
    train = df.filter(F.col("split") == split)
    totals = train.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}.mean").alias("mean"),
            F.when(F.col(f"{c}.std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}.std")).alias("std"),
        )
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def train_medians(df: DataFrame, columns: Sequence[str], split: str = "train", hot: bool | None = None) -> DataFrame:
    """Exact medians of the training rows, `(column, median)`."""
    found = skew.exact_quantiles(df.filter(F.col("split") == split), [], columns, [0.5], hot=hot)
    rows = [F.struct(F.lit(c).alias("column"), F.element_at(c, 1).alias("median")) for c in columns]
    return found.select(F.inline(F.array(*rows)))


def standardise(df: DataFrame, statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply stored means and deviations to every split."""
    wide = statistics.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "std")))).alias("stats")
    )
    scaled = df.withColumn("_stats", wide.scalar())

    def z(c: str):
        stat = F.try_element_at(F.col("_stats"), F.lit(c))
        return (F.col(c) - stat["mean"]) / stat["std"]

    return scaled.withColumns({c: z(c) for c in columns}).drop("_stats")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def counts_by_split(df: DataFrame, column: str, values: Sequence, split: str = "split") -> DataFrame:
    """Counts of each value per split, one column per value."""
    return df.groupBy(split).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def healthy_baseline(df: DataFrame, columns: Sequence[str], split: str = "train", status: str = "RUNNING") -> DataFrame:
    """Mean of each feature over running training rows, in one row."""
    healthy = df.filter((F.col("split") == split) & (F.col("operating_status") == status))
    return healthy.agg(*[F.avg(c).alias(c) for c in columns])


def downtime_by_status(production: DataFrame) -> DataFrame:
    """Mean downtime hours per status: the origin of the what-if downtime constants."""
    return production.groupBy("operating_status").agg((F.avg("downtime_minutes") / 60.0).alias("downtime_hours"))


def sigma_thresholds(
    df: DataFrame, columns: Sequence[str], key: str = "machine_type", warning: float = WARNING_SIGMA, danger: float = DANGER_SIGMA
) -> DataFrame:
    """Normal, warning and danger level per key and channel, `(key, channel, mean, warning, danger)`."""
    levels = df.groupBy(key).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("channel"),
            F.col(f"{c}.m").alias("mean"),
            (F.col(f"{c}.m") + warning * F.col(f"{c}.s")).alias("warning"),
            (F.col(f"{c}.m") + danger * F.col(f"{c}.s")).alias("danger"),
        )
        for c in columns
    ]
    return levels.select(key, F.inline(F.array(*rows)))


def sigma_bands(df: DataFrame, thresholds: DataFrame, channel: str, key: str = "machine_type") -> DataFrame:
    """Label each reading of one channel NORMAL, WARNING or DANGER by its key's levels."""
    levels = thresholds.filter(F.col("channel") == channel).select(key, "warning", "danger")
    band = (
        F.when(F.col(channel) >= F.col("danger"), "DANGER")
        .when(F.col(channel) >= F.col("warning"), "WARNING")
        .when(F.col(channel).isNotNull(), "NORMAL")
    )
    return df.join(skew.checked_broadcast(levels), key, "left").withColumn("band", band).drop("warning", "danger")
