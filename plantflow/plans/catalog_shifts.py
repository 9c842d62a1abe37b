"""Queries: shift aggregation, integration, features, split."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow.config import CHANNELS, ROLLING_SHIFTS, TARGET, Shift
from plantflow.functions import columns as fn
from plantflow.operators import features, integrate, quality
from plantflow.plans import inputs as tables
from plantflow.plans import sql_tables
from plantflow.plans.registry import query, round_sql, rounded
from plantflow.sources import star_inputs as inputs

_DATE = "CAST(date AS VARCHAR) AS date"


def _dated(df):
    return rounded(df.withColumn("date", F.col("date").cast("string")))


@query(
    "shift_aggregate",
    f"SELECT machine_id, {_DATE}, shift, failure_occurred_this_shift, {round_sql(sql_tables.MEASURES)} FROM sensor_shifts",
    ("sensor_shifts",),
)
def shift_aggregate(spark, sf_dir):
    """Mean, deviation and maximum of seven channels per machine and 8-hour shift."""
    return _dated(integrate.aggregate_to_shift(quality.clean_sensor(inputs.sensor_raw(spark, sf_dir))))


UNEQUAL = [Shift("Early", 5, 12), Shift("Late", 12, 21), Shift("Deep", 21, 5)]


@query(
    "unequal_shifts",
    """
SELECT shift, CAST(date AS VARCHAR) AS date, count(*) AS n, round(avg(value), 6) AS mean_value FROM (
  SELECT value, CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'Early' WHEN hour(ts) BETWEEN 12 AND 20 THEN 'Late' ELSE 'Deep' END AS shift,
    CASE WHEN hour(ts) < 5 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END AS date FROM events) GROUP BY shift, date""",
)
def unequal_shifts(spark, sf_dir):
    """Named shifts of different length, one of them across midnight."""
    named = integrate.with_shift(inputs.events(spark, sf_dir), "ts", UNEQUAL)
    return _dated(named.groupBy("shift", "date").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")))


@query(
    "shift_start_lookup",
    "SELECT shift, CASE shift WHEN 'Morning' THEN 6 WHEN 'Afternoon' THEN 14 ELSE 22 END AS start_hour, count(*) AS n, strftime(max(CAST(date AS TIMESTAMP) + to_hours(CASE shift WHEN 'Morning' THEN 6 WHEN 'Afternoon' THEN 14 ELSE 22 END)), '%Y-%m-%d %H:%M:%S') AS latest_start FROM production_clean GROUP BY shift",
    ("production_clean",),
)
def shift_start_lookup(spark, sf_dir):
    started = quality.clean_production(inputs.production_raw(spark, sf_dir)).withColumn("at", fn.shift_start("date", "shift"))
    return started.groupBy("shift").agg(
        F.max(F.hour("at")).alias("start_hour"),
        F.count(F.lit(1)).alias("n"),
        F.date_format(F.max("at"), "yyyy-MM-dd HH:mm:ss").alias("latest_start"),
    )


@query(
    "sensor_join",
    """
SELECT (SELECT count(*) FROM production_clean) AS rows_before_merge, count(*) AS rows_after_merge,
  count(*) FILTER (temperature_k_mean IS NULL) AS unmatched_sensor_rows, 33 AS final_columns FROM integrated""",
    ("integrated",),
)
def sensor_join(spark, sf_dir):
    """Left join of production shifts with readings: row counts and unmatched shifts."""
    production, sensor, maintenance = tables.clean_tables(spark, sf_dir)
    return integrate.integration_summary(production, integrate.integrate(production, sensor, maintenance))


@query(
    "asof_history",
    """
SELECT e.event_id, round((epoch_us(e.ts) - epoch_us(p.ts)) / 86400000000.0::DOUBLE, 2) AS days_since,
  (SELECT count(*) FROM ev q WHERE q.event_type = 'purchase' AND q.user_id = e.user_id AND q.ts < e.ts AND q.ts >= e.ts - INTERVAL 7 DAYS) AS recent
FROM ev e ASOF LEFT JOIN (SELECT user_id, ts FROM ev WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts > p.ts""",
    ("ev",),
)
def asof_history(spark, sf_dir):
    """For every event: days since the user's latest earlier purchase and purchases in the last 7 days."""
    events = inputs.events(spark, sf_dir)
    purchases = events.filter(F.col("event_type") == "purchase")
    probes = events.select("event_id", "user_id", "ts")
    return integrate.event_history(probes, purchases, "ts", "ts", "user_id", last="days_since", recent="recent").select(
        "event_id", "days_since", "recent"
    )


@query(
    "order_history",
    """
SELECT o.o_orderkey, round((epoch_us(o.o_orderdate) - epoch_us(max(p.o_orderdate))) / 86400000000.0::DOUBLE, 2) AS days_since,
  count(p.o_orderkey) FILTER (p.o_orderdate >= o.o_orderdate - INTERVAL 90 DAYS) AS recent
FROM orders o LEFT JOIN orders p ON p.o_custkey = o.o_custkey AND p.o_orderdate < o.o_orderdate
GROUP BY o.o_orderkey, o.o_orderdate""",
)
def order_history(spark, sf_dir):
    """The same history over orders per customer, with a 90-day interval and many equal times."""
    orders = inputs.table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    found = integrate.event_history(orders, orders, "at", "at", "o_custkey", days=90, last="days_since", recent="recent")
    return found.select("o_orderkey", "days_since", "recent")


@query(
    "integrated_shifts",
    f"SELECT * EXCLUDE (shift_at) REPLACE ({_DATE}, {', '.join(f'round({c}, 6) AS {c}' for c in [*sql_tables.MEASURES, 'production_rate', 'quality_score', 'downtime_minutes'])}) FROM integrated",
    ("integrated",),
)
def integrated_shifts(spark, sf_dir):
    return _dated(tables.integrated(spark, sf_dir))


@query(
    "production_ratios",
    f"SELECT machine_id, {_DATE}, shift, round(greatest(least(downtime_minutes / 480.0::DOUBLE, 1.0), 0.0)::DOUBLE, 6) AS downtime_ratio, round(CASE WHEN downtime_minutes / 480.0::DOUBLE < 1 THEN production_count / greatest(8.0::DOUBLE - downtime_minutes / 60.0::DOUBLE, 0.1::DOUBLE) ELSE 0.0 END, 6) AS production_efficiency FROM production_clean",
    ("production_clean",),
)
def production_ratios(spark, sf_dir):
    clean = quality.clean_production(inputs.production_raw(spark, sf_dir))
    return _dated(
        features.add_production_ratios(clean).select("machine_id", "date", "shift", "downtime_ratio", "production_efficiency")
    )


@query(
    "recent_maintenance_flag",
    "SELECT CASE WHEN maintenance_count_past_7d > 0 THEN 1 ELSE 0 END AS has_recent_maintenance, count(*) AS n, round(avg(days_since_last_maintenance), 6) AS mean_days FROM integrated GROUP BY 1",
    ("integrated",),
)
def recent_maintenance_flag(spark, sf_dir):
    flagged = features.add_recent_maintenance(tables.integrated(spark, sf_dir))
    return rounded(
        flagged.groupBy("has_recent_maintenance").agg(
            F.count(F.lit(1)).alias("n"), F.avg("days_since_last_maintenance").alias("mean_days")
        )
    )


_WIDE = [*sql_tables.MEASURES, *sql_tables.HISTORY_NAMES, "production_rate", "quality_score", "downtime_minutes", "downtime_ratio", "production_efficiency"]


@query(
    "feature_table",
    f"SELECT * REPLACE ({_DATE}, {', '.join(f'round({c}, 6) AS {c}' for c in _WIDE)}) FROM split_features",
    ("split_features",),
)
def feature_table(spark, sf_dir):
    """The whole path: clean, integrate, lag and rolling features, label, time split."""
    return _dated(tables.feature_table(spark, sf_dir))


@query(
    "event_history_features",
    "SELECT event_id, lag(value) OVER w AS value_lag1, "
    + ", ".join(f"round(avg(value) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS value_rollmean_{n}" for n in ROLLING_SHIFTS)
    + ", lead(event_type) OVER w AS next_type FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts)",
    ("ev",),
)
def event_history_features(spark, sf_dir):
    """Lag, past-only rolling means and lead on raw events, safe for very active users."""
    from pyspark.sql import Window as W

    from plantflow.operators import skew

    def body(frame, group):
        order = W.partitionBy(*group).orderBy("ts")
        means = {f"value_rollmean_{n}": F.avg("value").over(order.rowsBetween(-n, -1)) for n in ROLLING_SHIFTS}
        return frame.withColumns({"value_lag1": F.lag("value").over(order), "next_type": F.lead("event_type").over(order), **means})

    events = inputs.events(spark, sf_dir)
    done = skew.over_segments(events, ["user_id"], "ts", body, before=max(ROLLING_SHIFTS), after=1)
    return rounded(done.select("event_id", "value_lag1", "next_type", *[f"value_rollmean_{n}" for n in ROLLING_SHIFTS]), 6, "value_lag1")


@query(
    "next_shift_label",
    f"SELECT {TARGET}, count(*) AS n FROM (SELECT lead(failure_occurred_this_shift) OVER (PARTITION BY machine_id ORDER BY date NULLS LAST, {sql_tables.SHIFT_ORDER}) AS {TARGET} FROM integrated) GROUP BY 1",
    ("integrated",),
)
def next_shift_label(spark, sf_dir):
    labelled = features.add_target(tables.integrated(spark, sf_dir))
    return labelled.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n"))


@query(
    "feature_summary",
    f"SELECT (SELECT count(*) FROM integrated) AS rows_before, (SELECT count(*) FROM integrated) - count(*) AS rows_dropped_no_future_shift, count(*) AS rows_after, round(avg({TARGET}), 6) AS failure_next_shift_positive_rate FROM features",
    ("features",),
)
def feature_summary(spark, sf_dir):
    joined = tables.integrated(spark, sf_dir)
    return rounded(features.feature_summary(joined, features.build_features(joined)))


@query(
    "time_split",
    f"SELECT sim_day, split, count(*) AS n, CAST(sum({TARGET}) AS BIGINT) AS positives FROM split_features GROUP BY ALL",
    ("split_features",),
)
def time_split(spark, sf_dir):
    split = tables.feature_table(spark, sf_dir)
    return split.groupBy("sim_day", "split").agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("positives"))


@query(
    "event_time_split",
    f"SELECT split, count(*) AS n, count(DISTINCT sim_day) AS days FROM (SELECT *, {sql_tables.SPLIT.format(d='sim_day')} AS split FROM (SELECT date_diff('day', DATE '2024-01-01', CAST(timestamp AS DATE)) + 1 AS sim_day FROM maintenance_clean)) WHERE split IS NOT NULL GROUP BY split",
    ("maintenance_clean",),
)
def event_time_split(spark, sf_dir):
    """The day ranges applied to event timestamps."""
    notes = quality.clean_maintenance(inputs.maintenance_raw(spark, sf_dir))
    split = features.time_split(notes, inputs.EVENT_DAYS, date="timestamp")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sim_day").alias("days"))


@query(
    "split_day_overlap",
    """
SELECT sim_day, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits FROM (
  SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS sim_day, CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'test' END AS split
  FROM ev WHERE user_id % 2 = 0 OR day(ts) > 20) GROUP BY sim_day HAVING count(DISTINCT split) > 1""",
    ("ev",),
)
def split_day_overlap(spark, sf_dir):
    """Days found in two splits, on a split that leaks on purpose."""
    events = inputs.events(spark, sf_dir)
    leaky = events.select(
        fn.sim_day(F.to_date("ts"), inputs.EVENT_DAYS.start).alias("sim_day"),
        F.when(F.col("user_id") % 2 == 0, "train").when(F.dayofmonth("ts") > 20, "test").alias("split"),
    )
    found = features.overlapping_days(leaky.filter(F.col("split").isNotNull()))
    return found.withColumn("splits", F.array_join("splits", ","))


@query(
    "shift_order_sort",
    f"SELECT machine_id, {_DATE}, shift, {sql_tables.SHIFT_ORDER} AS place, round(production_rate, 6) AS production_rate FROM production_clean ORDER BY machine_id, date NULLS LAST, {sql_tables.SHIFT_ORDER}",
    ("production_clean",),
)
def shift_order_sort(spark, sf_dir):
    """Production rows in the order in which the shifts happen."""
    ordered = features.in_shift_order(quality.clean_production(inputs.production_raw(spark, sf_dir)))
    return _dated(
        ordered.select("machine_id", "date", "shift", fn.shift_order("shift").alias("place"), "production_rate")
    )
