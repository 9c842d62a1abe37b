"""Leakage-safe shift features, the next-shift label and the time split.

The windows here run over the shift table, which holds at most one row per
machine, day and shift: the size of a machine's group is set by the calendar,
not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, WindowSpec, functions as F

from plantflow.config import HISTORY_COLUMNS, ROLLING_SHIFTS, SHIFTS, TARGET, Shift, SplitDays
from plantflow.functions import columns as fn


def shift_sequence(shifts: Sequence[Shift] = SHIFTS, key: str = "machine_id", *, descending: bool = False, by: Sequence[str] = ("date",)) -> WindowSpec:
    """A machine's shifts in the order in which they happened (unknown days last)."""
    order = [*[F.col(c) for c in by], fn.shift_order("shift", shifts)]
    return W.partitionBy(key).orderBy(*[c.desc_nulls_first() if descending else c.asc_nulls_last() for c in order])


def add_production_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "downtime_ratio": fn.downtime_ratio("downtime_minutes"),
            "production_efficiency": fn.production_efficiency("production_count", "downtime_minutes"),
        }
    )


def add_history(
    df: DataFrame,
    columns: Sequence[str] = HISTORY_COLUMNS,
    windows: Sequence[int] = ROLLING_SHIFTS,
    shifts: Sequence[Shift] = SHIFTS,
    order: WindowSpec | None = None,
) -> DataFrame:
    """Previous-shift value and rolling means of strictly earlier shifts, all from one sort."""
    order = order or shift_sequence(shifts)
    new = {}
    for c in [c for c in columns if c in df.columns]:
        new[f"{c}_lag1"] = F.lag(c, 1).over(order)
        for n in windows:
            new[f"{c}_rollmean_{n}"] = F.avg(c).over(order.rowsBetween(-n, -1))
    return df.withColumns(new)


def add_recent_maintenance(df: DataFrame, count: str = "maintenance_count_past_7d") -> DataFrame:
    return df.withColumn("has_recent_maintenance", (F.col(count) > 0).cast("int"))


def add_target(
    df: DataFrame,
    flag: str = "failure_occurred_this_shift",
    target: str = TARGET,
    shifts: Sequence[Shift] = SHIFTS,
    order: WindowSpec | None = None,
) -> DataFrame:
    """Failure flag of the next shift; NULL where there is none (or it has no readings)."""
    return df.withColumn(target, F.lead(flag, 1).over(order or shift_sequence(shifts)).cast("int"))


def build_features(integrated: DataFrame, shifts: Sequence[Shift] = SHIFTS) -> DataFrame:
    """The labelled feature table: ratios, history, maintenance flag, next-shift label."""
    enriched = add_recent_maintenance(add_production_ratios(integrated)).withColumn("_place", fn.shift_order("shift", shifts))
    order = W.partitionBy("machine_id").orderBy(F.col("date").asc_nulls_last(), F.col("_place").asc_nulls_last())
    labelled = add_target(add_history(enriched, order=order), order=order)
    return labelled.filter(F.col(TARGET).isNotNull()).drop("_place")


def feature_summary(integrated: DataFrame, features: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows before and after, rows without a next shift and positive rate, in one row."""
    before = integrated.agg(F.count(F.lit(1)).alias("n"))
    after = features.agg(F.count(F.lit(1)).alias("rows_after"), F.avg(target).alias("failure_next_shift_positive_rate"))
    return after.select(
        before.scalar().alias("rows_before"),
        (before.scalar() - F.col("rows_after")).alias("rows_dropped_no_future_shift"),
        "rows_after",
        "failure_next_shift_positive_rate",
    )


# --- time split -----------------------------------------------------------


def split_of(day: str, days: SplitDays) -> F.Column:
    """Split that holds a day number; NULL outside every range."""
    label = F.lit(None).cast("string")
    for name, (low, high) in days.ranges().items():
        label = F.when(F.col(day).between(low, high), F.lit(name)).otherwise(label)
    return label


def time_split(df: DataFrame, days: SplitDays = SplitDays(), date: str = "date") -> DataFrame:
    """Add `sim_day` and `split`; rows outside every day range are dropped."""
    numbered = df.withColumn("sim_day", fn.sim_day(F.to_date(date), days.start))
    return numbered.withColumn("split", split_of("sim_day", days)).filter(F.col("split").isNotNull())


def split_summary(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("failure_rate"))


def overlapping_days(df: DataFrame) -> DataFrame:
    """Days that occur in more than one split (there must be none); checks every pair of splits."""
    days = df.select("sim_day", "split").distinct()
    return days.groupBy("sim_day").agg(F.sort_array(F.collect_set("split")).alias("splits")).filter(F.size("splits") > 1)


def in_shift_order(df: DataFrame, shifts: Sequence[Shift] = SHIFTS, key: str = "machine_id") -> DataFrame:
    """Sort for a report: machine, day, then the shifts as they happen (a range exchange, not one task)."""
    return df.orderBy(key, F.col("date").asc_nulls_last(), fn.shift_order("shift", shifts))
