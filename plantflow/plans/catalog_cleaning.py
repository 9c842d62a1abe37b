"""Queries: validation, repair of the raw tables, cleaning ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow.config import CHANNELS, OUTLIER_CHANNELS, PHYSICAL_BOUNDS
from plantflow.functions import columns as fn
from plantflow.operators import quality
from plantflow.plans import sql_tables
from plantflow.plans.registry import query, round_sql, rounded
from plantflow.session import durable, new_folder
from plantflow.sources import schema, star_inputs as inputs

_NUMERIC = [c for c, kind in schema.SENSOR_SCHEMA.items() if kind != "text"]
_CHANNEL_SQL = round_sql(CHANNELS)


@query(
    "schema_gate",
    """
SELECT 'sensor' AS "table", rule, "column", n FROM (
  SELECT unnest(['mostly_unparseable', 'mostly_unparseable', 'no_machine_id']) AS rule,
         unnest(['load_pct', 'failure_flag', 'machine_id']) AS "column",
         unnest([l, f, ids]) AS n, unnest([l > rows * 0.5, f > rows * 0.5, ids = 0]) AS failed
  FROM (SELECT count(*) AS rows, 0::BIGINT AS ids,
      count(*) FILTER (TRY_CAST(lp AS DOUBLE) IS NULL) AS l, count(*) FILTER (TRY_CAST(ff AS DOUBLE) IS NULL) AS f
    FROM (SELECT CASE WHEN load_pct < 70 THEN 'n/a' ELSE CAST(load_pct AS VARCHAR) END AS lp,
        CASE WHEN failure_flag = 1 THEN 'yes' ELSE '0' END AS ff FROM sensor_raw))
) WHERE failed""",
    ("sensor_raw",),
)
def schema_gate(spark, sf_dir):
    """Rule failures of a spoilt sensor table: one unparseable column, one fair one, no ids."""
    spoilt = inputs.sensor_raw(spark, sf_dir).withColumns(
        {
            "machine_id": F.lit(None).cast("string"),
            "load_pct": F.when(F.col("load_pct") < 70, "n/a").otherwise(F.col("load_pct").cast("string")),
            "failure_flag": F.when(F.col("failure_flag") == 1, "yes").otherwise("0"),
        }
    )
    return schema.quality_report(spoilt, schema.SENSOR_SCHEMA, "sensor")


@query(
    "label_normalise",
    f"SELECT machine_type, operating_status, count(*) AS n FROM (SELECT {sql_tables.normal('machine_type')} AS machine_type, {sql_tables.normal('operating_status')} AS operating_status FROM sensor_raw) GROUP BY ALL",
    ("sensor_raw",),
)
def label_normalise(spark, sf_dir):
    raw = inputs.sensor_raw(spark, sf_dir)
    tidy = raw.select(
        fn.normalise_label("machine_type").alias("machine_type"), fn.normalise_label("operating_status").alias("operating_status")
    )
    return tidy.groupBy("machine_type", "operating_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "timestamp_parse",
    "SELECT machine_id, count(*) AS readings, count(*) FILTER (TRY_CAST(timestamp AS TIMESTAMP) IS NULL) AS malformed, strftime(max(TRY_CAST(timestamp AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S.%f') AS latest FROM sensor_raw GROUP BY machine_id",
    ("sensor_raw",),
)
def timestamp_parse(spark, sf_dir):
    parsed = inputs.sensor_raw(spark, sf_dir).select("machine_id", fn.lenient_timestamp("timestamp").alias("at"))
    return parsed.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("at").isNull()).alias("malformed"),
        F.date_format(F.max("at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"),
    )


@query(
    "date_parse",
    "SELECT shift, count(*) AS rows, count(TRY_CAST(date AS DATE)) AS dated, count(*) FILTER (TRY_CAST(date AS DATE) IS NULL) AS kept_without_date FROM production_raw GROUP BY shift",
    ("production_raw",),
)
def date_parse(spark, sf_dir):
    parsed = inputs.production_raw(spark, sf_dir).select("shift", fn.lenient_date("date").alias("date"))
    return parsed.groupBy("shift").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("date").alias("dated"),
        F.count_if(F.col("date").isNull()).alias("kept_without_date"),
    )


@query(
    "duplicate_removal",
    "SELECT machine_id, count(*) AS distinct_rows, CAST(sum(copies - 1) AS BIGINT) AS dropped FROM (SELECT *, count(*) AS copies FROM sensor_valid GROUP BY ALL) GROUP BY machine_id",
    ("sensor_valid",),
)
def duplicate_removal(spark, sf_dir):
    raw = inputs.sensor_raw(spark, sf_dir)
    valid = raw.withColumns(
        {
            "timestamp": fn.lenient_timestamp("timestamp"),
            "machine_type": fn.normalise_label("machine_type"),
            "operating_status": fn.normalise_label("operating_status"),
        }
    ).filter(F.col("timestamp").isNotNull())
    return (
        quality.drop_exact_duplicates(valid)
        .groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("distinct_rows"), F.sum(F.col("_copies") - 1).alias("dropped"))
    )


@query(
    "bounds_nulling",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS glitches_{c}, count(*) FILTER ({c} BETWEEN {lo} AND {hi}) AS valid_{c}"
        for c, (lo, hi) in PHYSICAL_BOUNDS.items()
    )
    + " FROM sensor_distinct",
    ("sensor_distinct",),
)
def bounds_nulling(spark, sf_dir):
    flagged = quality.null_outside_bounds(inputs.sensor_raw(spark, sf_dir).filter("timestamp <> 'unknown'").distinct())
    return flagged.agg(
        *[F.count_if(f"_glitch_{c}").alias(f"glitches_{c}") for c in CHANNELS],
        *[F.count(c).alias(f"valid_{c}") for c in CHANNELS],
    )


@query(
    "gap_fill",
    f"SELECT machine_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS at, {_CHANNEL_SQL} FROM sensor_filled",
    ("sensor_filled",),
)
def gap_fill(spark, sf_dir):
    """Forward then backward fill over at most four readings per machine."""
    raw = inputs.sensor_raw(spark, sf_dir).withColumn("timestamp", fn.lenient_timestamp("timestamp"))
    distinct = raw.filter(F.col("timestamp").isNotNull()).select("machine_id", "timestamp", *CHANNELS).distinct()
    filled = quality.fill_short_gaps(quality.null_outside_bounds(distinct))
    return rounded(
        filled.select("machine_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), *CHANNELS)
    )


@query(
    "sensor_clean",
    f"SELECT machine_id, machine_type, operating_status, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS at, tool_wear_min, failure_flag, {_CHANNEL_SQL} FROM sensor_clean",
    ("sensor_clean",),
)
def sensor_clean(spark, sf_dir):
    """Fully cleaned sensor readings, with the per-machine median behind the gap fill."""
    clean = quality.clean_sensor(inputs.sensor_raw(spark, sf_dir))
    return rounded(
        clean.withColumn("at", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop("timestamp")
    )


@query(
    "production_clean",
    "SELECT * REPLACE (CAST(date AS VARCHAR) AS date, round(production_rate, 6) AS production_rate, round(quality_score, 6) AS quality_score, round(downtime_minutes, 6) AS downtime_minutes) FROM production_clean",
    ("production_clean",),
)
def production_clean(spark, sf_dir):
    clean = quality.clean_production(inputs.production_raw(spark, sf_dir))
    return rounded(clean.withColumn("date", F.col("date").cast("string")))


@query(
    "maintenance_clean",
    "SELECT * REPLACE (strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp) FROM maintenance_clean",
    ("maintenance_clean",),
)
def maintenance_clean(spark, sf_dir):
    clean = quality.clean_maintenance(inputs.maintenance_raw(spark, sf_dir))
    return clean.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "iqr_outliers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(any_value(lo), 6) AS lower, round(any_value(hi), 6) AS upper, count(*) FILTER ({c} < lo OR {c} > hi) AS outliers
FROM sensor_clean, (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi FROM (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM sensor_clean))"""
        for c in OUTLIER_CHANNELS
    ),
    ("sensor_clean",),
)
def iqr_outliers(spark, sf_dir):
    return rounded(quality.iqr_outliers(durable(quality.clean_sensor(inputs.sensor_raw(spark, sf_dir)))))


_LEDGER_SQL = (
    """SELECT 'sensor' AS "table", 'rows_before' AS rule, NULL AS "column", count(*) AS n FROM sensor_raw
UNION ALL SELECT 'sensor', 'rows_dropped_malformed_timestamp', NULL, count(*) FILTER (TRY_CAST(timestamp AS TIMESTAMP) IS NULL) FROM sensor_raw
UNION ALL SELECT 'sensor', 'rows_dropped_exact_duplicate', NULL, (SELECT count(*) FROM sensor_valid) - (SELECT count(*) FROM sensor_distinct)
UNION ALL SELECT 'sensor', 'rows_after', NULL, count(*) FROM sensor_clean
UNION ALL SELECT 'sensor', 'down_state_missing_preserved', NULL, CAST(sum("""
    + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in CHANNELS)
    + ") AS BIGINT) FROM sensor_clean WHERE operating_status <> 'RUNNING'"
    + "".join(
        f"""
UNION ALL SELECT 'sensor', 'physically_invalid_values_nulled', '{c}', count(*) FROM sensor_distinct WHERE {c} < {lo} OR {c} > {hi}
UNION ALL SELECT 'sensor', 'running_state_values_imputed', '{c}',
  (SELECT count(*) FROM sensor_bounded WHERE operating_status = 'RUNNING' AND {c} IS NULL) - (SELECT count(*) FROM sensor_clean WHERE operating_status = 'RUNNING' AND {c} IS NULL)"""
        for c, (lo, hi) in PHYSICAL_BOUNDS.items()
    )
    + "".join(
        f"""
UNION ALL SELECT 'sensor', 'iqr_outliers_detected_and_kept', '{c}', count(*) FILTER ({c} < lo OR {c} > hi)
FROM sensor_clean, (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi FROM (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM sensor_clean))"""
        for c in OUTLIER_CHANNELS
    )
)


@query("sensor_ledger", _LEDGER_SQL, ("sensor_clean",))
def sensor_ledger(spark, sf_dir):
    """Counted while the cleaned table is written."""
    return quality.clean_and_record("sensor", inputs.sensor_raw(spark, sf_dir), new_folder(spark, "cleaned"))[1]


@query(
    "production_ledger",
    """
SELECT 'production' AS "table", 'rows_before' AS rule, NULL AS "column", count(*) AS n FROM production_raw
UNION ALL SELECT 'production', 'rows_dropped_exact_duplicate', NULL, (SELECT count(*) FROM production_raw) - (SELECT count(*) FROM production_distinct)
UNION ALL SELECT 'production', 'rows_after', NULL, count(*) FROM production_distinct
UNION ALL SELECT 'production', 'invalid_production_count_fixed', 'production_count', count(*) FILTER (production_count < 0) FROM production_distinct
UNION ALL SELECT 'production', 'quality_score_imputed', 'quality_score', count(*) FILTER (quality_score IS NULL) FROM production_distinct""",
    ("production_distinct",),
)
def production_ledger(spark, sf_dir):
    return quality.clean_and_record("production", inputs.production_raw(spark, sf_dir), new_folder(spark, "cleaned"))[1]


@query(
    "maintenance_ledger",
    """
SELECT 'maintenance' AS "table", 'rows_before' AS rule, NULL AS "column", count(*) AS n FROM maintenance_raw
UNION ALL SELECT 'maintenance', 'rows_dropped_exact_duplicate', NULL, (SELECT count(*) FROM maintenance_raw WHERE timestamp <> 'unknown') - (SELECT count(*) FROM maintenance_distinct)
UNION ALL SELECT 'maintenance', 'rows_after', NULL, count(*) FROM maintenance_distinct
UNION ALL SELECT 'maintenance', 'urgency_marked_unknown', 'urgency', count(*) FILTER (urgency IS NULL) FROM maintenance_distinct""",
    ("maintenance_distinct",),
)
def maintenance_ledger(spark, sf_dir):
    return quality.clean_and_record("maintenance", inputs.maintenance_raw(spark, sf_dir), new_folder(spark, "cleaned"))[1]


@query(
    "urgency_category",
    "SELECT urgency, count(*) AS n FROM maintenance_clean GROUP BY urgency",
    ("maintenance_clean",),
)
def urgency_category(spark, sf_dir):
    clean = quality.clean_maintenance(inputs.maintenance_raw(spark, sf_dir))
    return clean.groupBy("urgency").agg(F.count(F.lit(1)).alias("n"))
