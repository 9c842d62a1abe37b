"""Common SQL tables: the derived inputs and the cleaned, integrated and feature tables."""

from __future__ import annotations

from plantflow.config import CHANNELS, HISTORY_COLUMNS, PHYSICAL_BOUNDS, ROLLING_SHIFTS
from plantflow.plans.registry import common

_TYPE = "CASE user_id % 3 WHEN 0 THEN 'Cnc' WHEN 1 THEN 'Press' ELSE 'Injection_Molder' END"
_TIME = "CASE WHEN event_id % 997 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def normal(column: str) -> str:
    return f"upper(regexp_replace({column}, '^{_BLANK}+|{_BLANK}+$', '', 'g'))"


common("ev", "SELECT event_id, ts, user_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k FROM events")

common(
    "sensor_raw",
    f"""
SELECT * EXCLUDE (event_id, status, long_gap) FROM (
  SELECT event_id, 'M-' || user_id AS machine_id,
    CASE WHEN event_id % 53 = 0 THEN ' ' || lower({_TYPE}) || chr(9) ELSE {_TYPE} END AS machine_type,
    {_TIME} AS timestamp,
    day(ts) BETWEEN 10 AND 15 AND user_id % 3 = 0 AS long_gap,
    CASE WHEN event_type = 'error' THEN 'DOWN' ELSE 'RUNNING' END AS status,
    CASE WHEN event_id % 7 = 0 OR long_gap THEN NULL WHEN event_id % 211 = 0 THEN -(295.0::DOUBLE + value / 9.7::DOUBLE) ELSE 295.0::DOUBLE + value / 9.7::DOUBLE END AS temperature_k,
    305.0::DOUBLE + k / 9.7::DOUBLE AS process_temperature_k,
    CASE WHEN event_id % 11 = 0 OR long_gap THEN NULL WHEN event_id % 211 = 0 THEN 99.0::DOUBLE ELSE value / 19.7::DOUBLE END AS vibration_mm_s,
    CASE WHEN event_id % 13 = 0 OR long_gap THEN NULL ELSE 5.0::DOUBLE + k / 9.7::DOUBLE END AS pressure_bar,
    40.0::DOUBLE + k / 4.9::DOUBLE AS torque_nm,
    1500.0::DOUBLE + value * 5.0::DOUBLE / 1.03::DOUBLE AS rotational_speed_rpm,
    k::DOUBLE AS load_pct,
    (event_id % 240)::DOUBLE AS tool_wear_min,
    CASE WHEN event_id % 53 = 0 THEN ' ' || lower(status) || chr(9) ELSE status END AS operating_status,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failure_flag
  FROM ev
) r, (VALUES (1), (2)) c(copy) WHERE copy = 1 OR event_id % 101 = 0""".replace("SELECT * EXCLUDE (event_id, status, long_gap)", "SELECT r.* EXCLUDE (event_id, status, long_gap)"),
    ("ev",),
)

common(
    "shift_events",
    """
SELECT user_id, CAST(b AS DATE) AS day, CASE hour(b) WHEN 6 THEN 'Morning' WHEN 14 THEN 'Afternoon' ELSE 'Night' END AS shift,
  count(*) AS n, CAST(sum(k) AS BIGINT) AS ks, count(*) FILTER (event_type = 'error') AS errors,
  count(*) FILTER (event_type = 'purchase') AS purchases, day(CAST(b AS DATE)) AS d
FROM (SELECT *, time_bucket(INTERVAL 8 HOURS, ts, INTERVAL 6 HOURS) AS b FROM ev) GROUP BY user_id, b""",
    ("ev",),
)

common(
    "production_raw",
    f"""
SELECT p.* EXCLUDE (user_id, status) FROM (
  SELECT user_id, 'M-' || user_id AS machine_id,
    CASE WHEN user_id % 7 = 0 THEN lower({_TYPE}) ELSE {_TYPE} END AS machine_type,
    CASE WHEN (user_id * 31 + d) % 401 = 0 THEN 'n/a' ELSE CAST(day AS VARCHAR) END AS date, shift,
    ks / 8.0::DOUBLE AS production_rate,
    CAST(CASE WHEN (user_id + d) % 29 = 0 THEN -1 ELSE ks END AS BIGINT) AS production_count,
    CASE WHEN (user_id + d) % 17 = 0 THEN NULL ELSE 100.0::DOUBLE - ks / (9.7::DOUBLE * n) END AS quality_score,
    480.0::DOUBLE * errors / n AS downtime_minutes,
    CASE WHEN errors = n THEN 'DOWN' WHEN purchases > 0 THEN 'MAINTENANCE' ELSE 'RUNNING' END AS status,
    CASE WHEN user_id % 11 = 0 THEN ' ' || lower(status) ELSE status END AS operating_status
  FROM shift_events
) p, (VALUES (1), (2)) c(copy) WHERE copy = 1 OR user_id % 50 = 0""",
    ("shift_events",),
)

common(
    "maintenance_raw",
    f"""
SELECT m.* EXCLUDE (event_id) FROM (
  SELECT event_id, 'M-' || user_id AS machine_id, {_TIME} AS timestamp,
    CASE WHEN event_id % 2 = 0 THEN 'Preventive' ELSE 'Corrective' END AS maintenance_type,
    CASE event_id % 4 WHEN 0 THEN 'Scheduled' WHEN 1 THEN 'Mechanical' WHEN 2 THEN 'Electrical' ELSE 'Quality' END AS incident_type,
    'Replaced ' || k || ' parts!! Spindle checked.' AS maintenance_note,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Low' WHEN event_id % 3 = 1 THEN 'Medium' ELSE 'High' END AS urgency
  FROM ev WHERE event_type = 'purchase'
) m, (VALUES (1), (2)) c(copy) WHERE copy = 1 OR event_id % 101 = 0""",
    ("ev",),
)

# --- cleaned tables -------------------------------------------------------

_typed = f"* REPLACE ({normal('machine_type')} AS machine_type, {normal('operating_status')} AS operating_status, "
common("sensor_valid", f"SELECT * FROM (SELECT {_typed} TRY_CAST(timestamp AS TIMESTAMP) AS timestamp) FROM sensor_raw) WHERE timestamp IS NOT NULL", ("sensor_raw",))
common("sensor_distinct", "SELECT DISTINCT * FROM sensor_valid", ("sensor_valid",))
common(
    "sensor_bounded",
    "SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in PHYSICAL_BOUNDS.items())
    + ") FROM sensor_distinct",
    ("sensor_distinct",),
)
common(
    "sensor_filled",
    "SELECT * REPLACE ("
    + ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS {c}"
        for c in CHANNELS
    )
    + ") FROM sensor_bounded WINDOW w AS (PARTITION BY machine_id ORDER BY timestamp)",
    ("sensor_bounded",),
)
common(
    "sensor_clean",
    "SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN operating_status = 'RUNNING' AND {c} IS NULL THEN median({c}) OVER (PARTITION BY machine_id) ELSE {c} END AS {c}"
        for c in CHANNELS
    )
    + ") FROM sensor_filled",
    ("sensor_filled",),
)
common(
    "production_distinct",
    f"SELECT DISTINCT {_typed} TRY_CAST(date AS DATE) AS date, production_count::DOUBLE AS production_count) FROM production_raw",
    ("production_raw",),
)
common(
    "production_clean",
    """
SELECT * REPLACE (
  CAST(round_even(CASE WHEN production_count < 0 THEN median(production_count) OVER (PARTITION BY machine_id, shift) ELSE production_count END, 0) AS BIGINT) AS production_count,
  coalesce(quality_score, median(quality_score) OVER (PARTITION BY machine_id)) AS quality_score)
FROM production_distinct""",
    ("production_distinct",),
)
common(
    "maintenance_distinct",
    "SELECT DISTINCT * REPLACE (TRY_CAST(timestamp AS TIMESTAMP) AS timestamp) FROM maintenance_raw WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL",
    ("maintenance_raw",),
)
common("maintenance_clean", "SELECT * REPLACE (coalesce(urgency, 'Unknown') AS urgency) FROM maintenance_distinct", ("maintenance_distinct",))

# --- shift tables ---------------------------------------------------------

SHIFT_ORDER = "CASE shift WHEN 'Morning' THEN 0 WHEN 'Afternoon' THEN 1 ELSE 2 END"
SHIFT_SQL = """
SELECT machine_id, CAST(b AS DATE) AS date, CASE hour(b) WHEN 6 THEN 'Morning' WHEN 14 THEN 'Afternoon' ELSE 'Night' END AS shift,
  {measures}, max(failure_flag) AS failure_occurred_this_shift
FROM (SELECT *, time_bucket(INTERVAL 8 HOURS, timestamp, INTERVAL 6 HOURS) AS b FROM sensor_clean) GROUP BY machine_id, b"""
MEASURES = [f"{c}_{s}" for c in CHANNELS for s in ("mean", "std", "max")]
common(
    "sensor_shifts",
    SHIFT_SQL.format(
        measures=", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, max({c}) AS {c}_max" for c in CHANNELS)
    ),
    ("sensor_clean",),
)
common(
    "integrated",
    f"""
SELECT p.*, {", ".join(f"s.{m}" for m in MEASURES)}, s.failure_occurred_this_shift,
  round((epoch_us(p.shift_at) - epoch_us(last_at)) / 86400000000.0::DOUBLE, 2) AS days_since_last_maintenance,
  coalesce(recent, 0) AS maintenance_count_past_7d
FROM (SELECT *, CAST(date AS TIMESTAMP) + to_hours(CASE shift WHEN 'Morning' THEN 6 WHEN 'Afternoon' THEN 14 ELSE 22 END) AS shift_at FROM production_clean) p
LEFT JOIN sensor_shifts s USING (machine_id, date, shift)
LEFT JOIN (
  SELECT q.machine_id, q.shift_at, max(m.timestamp) AS last_at, count(*) FILTER (m.timestamp >= q.shift_at - INTERVAL 7 DAYS) AS recent
  FROM (SELECT DISTINCT machine_id, CAST(date AS TIMESTAMP) + to_hours(CASE shift WHEN 'Morning' THEN 6 WHEN 'Afternoon' THEN 14 ELSE 22 END) AS shift_at FROM production_clean) q
  JOIN maintenance_clean m ON m.machine_id = q.machine_id AND m.timestamp < q.shift_at GROUP BY q.machine_id, q.shift_at
) h ON h.machine_id = p.machine_id AND h.shift_at = p.shift_at""",
    ("production_clean", "sensor_shifts", "maintenance_clean"),
)

_history = ", ".join(
    f"lag({c}) OVER w AS {c}_lag1, "
    + ", ".join(f"avg({c}) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {c}_rollmean_{n}" for n in ROLLING_SHIFTS)
    for c in HISTORY_COLUMNS
)
HISTORY_NAMES = [n for c in HISTORY_COLUMNS for n in (f"{c}_lag1", *[f"{c}_rollmean_{r}" for r in ROLLING_SHIFTS])]
common(
    "features",
    f"""
SELECT * FROM (
  SELECT * EXCLUDE (shift_at),
    greatest(least(downtime_minutes / 480.0::DOUBLE, 1.0), 0.0)::DOUBLE AS downtime_ratio,
    CASE WHEN downtime_minutes / 480.0::DOUBLE < 1 THEN production_count / greatest(8.0::DOUBLE - downtime_minutes / 60.0::DOUBLE, 0.1::DOUBLE) ELSE 0.0 END AS production_efficiency,
    {_history},
    CASE WHEN maintenance_count_past_7d > 0 THEN 1 ELSE 0 END AS has_recent_maintenance,
    lead(failure_occurred_this_shift) OVER w AS failure_next_shift
  FROM integrated WINDOW w AS (PARTITION BY machine_id ORDER BY date NULLS LAST, {SHIFT_ORDER})
) WHERE failure_next_shift IS NOT NULL""",
    ("integrated",),
)
SPLIT = "CASE WHEN {d} BETWEEN 1 AND 17 THEN 'train' WHEN {d} BETWEEN 18 AND 22 THEN 'validation' WHEN {d} BETWEEN 23 AND 30 THEN 'test' END"
common(
    "split_features",
    f"""
SELECT *, {SPLIT.format(d='sim_day')} AS split FROM (
  SELECT *, CAST(date_diff('day', DATE '2024-01-01', date) + 1 AS INTEGER) AS sim_day FROM features
) WHERE split IS NOT NULL""",
    ("features",),
)
common(
    "scored",
    f"""
SELECT model, split, id, label, prob FROM (
  SELECT {SPLIT.format(d="date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1")} AS split, event_id AS id,
    CASE WHEN event_type = 'error' OR k > 90 THEN 1 ELSE 0 END AS label,
    unnest(['ratio', 'counter']) AS model, unnest([value / (value + 50.0::DOUBLE), k / 100.0::DOUBLE]) AS prob
  FROM ev) WHERE split IS NOT NULL""",
    ("ev",),
)
common(
    "page_text",
    """
SELECT source AS document, doc_id AS page,
  CASE WHEN doc_id % 71 = 0 THEN ' ' || chr(10) || ' '
       WHEN doc_id % 3 = 0 THEN 'Section ' || (doc_id % 9 + 1) || ': ' || source || chr(10) || replace(text, chr(10) || 'E', chr(10) || 'Section 5: E')
       ELSE replace(text, chr(10) || 'E', chr(10) || 'Section 5: E') END AS text
FROM documents""",
)
