"""Shift aggregation, past-only event history and the integrated shift table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from plantflow.config import CHANNELS, MAINTENANCE_DAYS, SHIFTS, Shift
from plantflow.functions import columns as fn
from plantflow.operators import skew
from plantflow.session import group_rows

SHIFT_KEYS = ["machine_id", "date", "shift"]
DAY_MICROS = 86_400_000_000


def with_shift(df: DataFrame, ts: str = "timestamp", shifts: Sequence[Shift] = SHIFTS) -> DataFrame:
    """Add the shift name and the calendar day on which that shift started."""
    return df.withColumns({"shift": fn.shift_name(ts, shifts), "date": fn.shift_date(ts, shifts)})


def shift_measures(columns: Sequence[str] = CHANNELS, flag: str = "failure_flag") -> list:
    """Mean, sample deviation and maximum of each channel, and whether a failure occurred."""
    measures = []
    for c in columns:
        measures += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.max(c).alias(f"{c}_max"),
        ]
    return [*measures, F.max(flag).alias("failure_occurred_this_shift")]


def aggregate_to_shift(
    sensor: DataFrame,
    columns: Sequence[str] = CHANNELS,
    shifts: Sequence[Shift] = SHIFTS,
    ts: str = "timestamp",
) -> DataFrame:
    """One row per machine and shift; readings are combined before they are shuffled."""
    return with_shift(sensor, ts, shifts).groupBy(*SHIFT_KEYS).agg(*shift_measures(columns))


def event_history(
    probes: DataFrame,
    events: DataFrame,
    as_of: str,
    event_ts: str = "timestamp",
    key: str = "machine_id",
    days: int = MAINTENANCE_DAYS,
    last: str = "days_since_last_maintenance",
    recent: str | None = None,
    hot: bool | None = None,
) -> DataFrame:
    """As-of and interval join in one: for each probe, strictly earlier events of its key.

    Adds the days since the latest event (2 decimals, NULL without one) and the
    number of events in `[as_of - days, as_of)`. Probes and events share one
    sorted window, so nothing is compared pairwise. A key with very many rows is
    solved per time bucket with totals carried over from earlier buckets.
    """
    recent = recent or f"maintenance_count_past_{days}d"
    happened = (
        events.filter(F.col(key).isNotNull())  # a missing key matches nothing
        .select(F.col(key).alias("_key"), F.unix_micros(event_ts).alias("_us"))
        .groupBy("_key", "_us")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    if hot is None:
        sizes = probes.select(F.col(key).alias("_key")).unionAll(events.select(F.col(key).alias("_key")))
        hot = skew.has_hot_group(sizes, ["_key"])
    span = days * DAY_MICROS
    if hot:
        found = _history_by_bucket(probes, happened, as_of, key, span)
        with_us = probes.withColumn("_us", F.unix_micros(as_of)).withColumn("_key", F.col(key))
        joined = with_us.join(found, ["_key", "_us"], "left")
        probe = [F.col(c) for c in probes.columns]
    else:
        rows = probes.select(
            F.col(key).alias("_key"),
            F.unix_micros(as_of).alias("_us"),
            F.lit(None).cast("bigint").alias("_n"),
            F.struct(*probes.columns).alias("_probe"),
        ).unionByName(happened.withColumn("_probe", F.lit(None)))
        ordered = W.partitionBy("_key").orderBy("_us")
        past, week = ordered.rangeBetween(W.unboundedPreceding, -1), ordered.rangeBetween(-span, -1)
        joined = (
            rows.withColumn("_last", F.max(F.when(F.col("_n").isNotNull(), F.col("_us"))).over(past))
            .withColumn("_recent", F.sum("_n").over(week))
            .filter(F.col("_probe").isNotNull())
        )
        # The key comes from the partitioning column, so that later windows per key need no exchange.
        probe = [(F.col("_key") if c == key else F.col("_probe").getField(c)).alias(c) for c in probes.columns]
    since = F.round((F.col("_us") - F.col("_last")) / float(DAY_MICROS), 2)
    return joined.select(
        *probe, since.alias(last), F.coalesce("_recent", F.lit(0)).cast("bigint").alias(recent)
    )


def _history_by_bucket(probes: DataFrame, happened: DataFrame, as_of: str, key: str, span: int) -> DataFrame:
    """Latest event and recent count per distinct (key, instant), with bounded groups.

    The recent count is the running count at the instant minus the running
    count at the start of the interval; each is a count inside a time bucket
    (an hour, or less in a burst) plus the total of the earlier buckets.
    """
    instants = probes.select(F.col(key).alias("_key"), F.unix_micros(as_of).alias("_at")).distinct()
    ends = F.array(
        F.struct(F.col("_at").alias("_us"), F.lit(True).alias("_now")),
        F.struct((F.col("_at") - span).alias("_us"), F.lit(False).alias("_now")),
    )
    marks = instants.withColumn("_end", F.explode(ends)).select("_key", "_at", "_end._us", "_end._now")
    rows = marks.withColumn("_n", F.lit(None).cast("bigint")).unionByName(happened, allowMissingColumns=True)
    bucket = skew.time_bucket(rows, ["_key"], group_rows(probes.sparkSession))
    rows = rows.withColumn("_hour", bucket(F.col("_us")))
    event_us = F.when(F.col("_n").isNotNull(), F.col("_us"))
    inside = W.partitionBy("_key", "_hour").orderBy("_us").rangeBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("_key").orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy("_key", "_hour")
        .agg(F.sum("_n").alias("_hn"), F.max(event_us).alias("_hlast"))
        .select(
            "_key",
            "_hour",
            F.coalesce(F.sum("_hn").over(earlier), F.lit(0)).alias("_before"),
            F.max("_hlast").over(earlier).alias("_before_last"),
        )
    )
    counted = (
        rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .withColumn("_in_last", F.max(event_us).over(inside))
        .filter(F.col("_at").isNotNull())
        .join(carried, ["_key", "_hour"])
    )
    total = F.col("_in") + F.col("_before")
    return (
        counted.groupBy("_key", "_at")
        .agg(
            F.max(F.when(F.col("_now"), F.coalesce("_in_last", "_before_last"))).alias("_last"),
            (F.max(F.when(F.col("_now"), total)) - F.max(F.when(~F.col("_now"), total))).alias("_recent"),
        )
        .withColumnRenamed("_at", "_us")
    )


def integrate(
    production: DataFrame,
    sensor: DataFrame,
    maintenance: DataFrame,
    columns: Sequence[str] = CHANNELS,
    shifts: Sequence[Shift] = SHIFTS,
    hot: bool | None = None,
) -> DataFrame:
    """Production shifts with sensor measures and past-only maintenance history.

    Keeps exactly the production rows; a shift without readings has NULL measures.
    """
    if hot is None:  # measured on the inputs, not on the joined rows
        machines = production.select("machine_id").unionAll(maintenance.select("machine_id"))
        hot = skew.has_hot_group(machines, ["machine_id"])
    measured = production.join(aggregate_to_shift(sensor, columns, shifts), SHIFT_KEYS, "left")
    started = measured.withColumn("_shift_start", fn.shift_start("date", "shift", shifts))
    ordered = [*production.columns, *[c for c in started.columns if c not in production.columns]]
    return event_history(started.select(*ordered), maintenance, "_shift_start", hot=hot).drop("_shift_start")


def integration_summary(production: DataFrame, integrated: DataFrame, probe: str = f"{CHANNELS[0]}_mean") -> DataFrame:
    """Rows before and after the join, unmatched shifts and column count, in one row."""
    after = integrated.agg(
        F.count(F.lit(1)).alias("rows_after_merge"),
        F.count_if(F.col(probe).isNull()).alias("unmatched_sensor_rows"),
    )
    before = production.agg(F.count(F.lit(1)).alias("n"))
    return after.select(
        before.scalar().alias("rows_before_merge"),
        "rows_after_merge",
        "unmatched_sensor_rows",
        F.lit(len(integrated.columns)).alias("final_columns"),
    )
