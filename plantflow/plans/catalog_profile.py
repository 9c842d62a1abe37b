"""Queries: descriptive aggregates, train-only statistics, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow.config import CHANNELS, SEQUENCE_COLUMNS, TARGET
from plantflow.operators import encode, evaluate, profile, quality, sampling
from plantflow.plans import inputs as tables
from plantflow.plans import sql_tables
from plantflow.plans.registry import query, rounded
from plantflow.session import durable
from plantflow.sources import readers, star_inputs as inputs

_KEY_COLUMNS = ["production_rate", "production_count", "quality_score", "downtime_minutes"]


@query(
    "rate_by_machine",
    "SELECT machine_id, round(avg(failure_flag), 4) AS rate FROM sensor_distinct GROUP BY machine_id",
    ("sensor_distinct",),
)
def rate_by_machine(spark, sf_dir):
    return profile.rate_by_key(quality.clean_sensor(inputs.sensor_raw(spark, sf_dir)), "failure_flag")


@query(
    "dataset_overview",
    "SELECT count(*) AS rows, 9 AS columns, CAST(sum(CASE WHEN quality_score IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values_total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM production_raw)) AS duplicate_rows FROM production_raw",
    ("production_raw",),
)
def dataset_overview(spark, sf_dir):
    return profile.dataset_overview(inputs.production_raw(spark, sf_dir))


def _summary_sql(table: str, columns: list[str], digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), {digits}) AS mean, round(stddev_samp({c}), {digits}) AS std, round(min({c})::DOUBLE, {digits}) AS "min",
round(quantile_cont({c}::DOUBLE, 0.25), {digits}) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), {digits}) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), {digits}) AS q75, round(max({c})::DOUBLE, {digits}) AS "max" FROM {table}"""
        for c in columns
    )


@query("numeric_summary", _summary_sql("production_clean", _KEY_COLUMNS), ("production_clean",))
def numeric_summary(spark, sf_dir):
    clean = durable(quality.clean_production(inputs.production_raw(spark, sf_dir)).select(*_KEY_COLUMNS))
    return profile.numeric_summary(clean, _KEY_COLUMNS, digits=6)


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("lineitem_summary", _summary_sql("lineitem", _LINE, 4))
def lineitem_summary(spark, sf_dir):
    """Exact quartiles over the largest table."""
    return profile.numeric_summary(inputs.table(spark, sf_dir, "lineitem"), _LINE, digits=4)


@query(
    "correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM sensor_clean" for a in CHANNELS for b in CHANNELS),
    ("sensor_clean",),
)
def correlation_matrix(spark, sf_dir):
    """Pairwise-complete correlation of the seven channels."""
    return profile.correlation_matrix(quality.clean_sensor(inputs.sensor_raw(spark, sf_dir)), CHANNELS, digits=6)


@query(
    "scaler_statistics",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(CASE WHEN stddev_samp({c}) = 0 THEN 1.0 ELSE stddev_samp({c}) END, 6) AS std FROM split_features WHERE split = 'train'"""
        for c in SEQUENCE_COLUMNS
    ),
    ("split_features",),
)
def scaler_statistics(spark, sf_dir):
    return rounded(profile.scaler_statistics(tables.feature_table(spark, sf_dir), SEQUENCE_COLUMNS))


@query(
    "scaled_features",
    "SELECT machine_id, sim_day, shift, "
    + ", ".join(
        f"round(({c} - avg({c}) FILTER (split = 'train') OVER ()) / stddev_samp({c}) FILTER (split = 'train') OVER (), 6) AS {c}"
        for c in ("production_rate", "quality_score", "vibration_mm_s_mean")
    )
    + " FROM split_features",
    ("split_features",),
)
def scaled_features(spark, sf_dir):
    """Training statistics applied to every split."""
    names = ["production_rate", "quality_score", "vibration_mm_s_mean"]
    features = durable(tables.feature_table(spark, sf_dir).select("machine_id", "sim_day", "shift", "split", *names))
    scaled = profile.standardise(features, profile.scaler_statistics(features, names), names)
    return rounded(scaled.select("machine_id", "sim_day", "shift", *names))


_MEDIANS = ["quality_score", "vibration_mm_s_mean", "days_since_last_maintenance"]


@query(
    "train_medians",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(median({c}), 6) AS median FROM split_features WHERE split = 'train'""" for c in _MEDIANS),
    ("split_features",),
)
def train_medians(spark, sf_dir):
    features = durable(tables.feature_table(spark, sf_dir).select("split", *_MEDIANS))
    return rounded(profile.train_medians(features, _MEDIANS))


@query(
    "split_summary",
    f"SELECT split, count(*) AS rows, round(avg({TARGET}), 6) AS failure_rate FROM split_features GROUP BY split",
    ("split_features",),
)
def split_summary(spark, sf_dir):
    from plantflow.operators import features

    return rounded(features.split_summary(tables.feature_table(spark, sf_dir)))


@query("label_counts", "SELECT incident_type, count(*) AS n FROM maintenance_clean GROUP BY incident_type", ("maintenance_clean",))
def label_counts(spark, sf_dir):
    return profile.value_counts(quality.clean_maintenance(inputs.maintenance_raw(spark, sf_dir)), "incident_type")


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "label_counts_by_split",
    "SELECT split, "
    + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in _KINDS)
    + f" FROM (SELECT *, {sql_tables.SPLIT.format(d='day(ts)')} AS split FROM events) WHERE split IS NOT NULL GROUP BY split",
)
def label_counts_by_split(spark, sf_dir):
    from plantflow.operators import features

    split = features.time_split(inputs.events(spark, sf_dir), inputs.EVENT_DAYS, date="ts")
    return profile.counts_by_split(split, "event_type", _KINDS)


_BASE = ["production_rate", "quality_score", "downtime_minutes", "vibration_mm_s_mean", "production_efficiency"]


@query(
    "healthy_baseline",
    "SELECT " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _BASE) + " FROM split_features WHERE split = 'train' AND operating_status = 'RUNNING'",
    ("split_features",),
)
def healthy_baseline(spark, sf_dir):
    return rounded(profile.healthy_baseline(tables.feature_table(spark, sf_dir), _BASE))


@query(
    "downtime_by_status",
    "SELECT operating_status, round(avg(downtime_minutes) / 60.0, 6) AS downtime_hours FROM production_clean GROUP BY operating_status",
    ("production_clean",),
)
def downtime_by_status(spark, sf_dir):
    return rounded(profile.downtime_by_status(quality.clean_production(inputs.production_raw(spark, sf_dir))))


_SIGMA = ["temperature_k", "vibration_mm_s", "pressure_bar", "torque_nm"]


@query(
    "sigma_thresholds",
    " UNION ALL ".join(
        f"SELECT machine_type, '{c}' AS channel, round(avg({c}), 6) AS mean, round(avg({c}) + 2.0 * stddev_samp({c}), 6) AS warning, round(avg({c}) + 3.5 * stddev_samp({c}), 6) AS danger FROM sensor_clean GROUP BY machine_type"
        for c in _SIGMA
    ),
    ("sensor_clean",),
)
def sigma_thresholds(spark, sf_dir):
    return rounded(profile.sigma_thresholds(quality.clean_sensor(inputs.sensor_raw(spark, sf_dir)), _SIGMA))


@query(
    "sigma_bands",
    """
SELECT s.machine_type, CASE WHEN vibration_mm_s >= m + 3.5 * d THEN 'DANGER' WHEN vibration_mm_s >= m + 2.0 * d THEN 'WARNING' WHEN vibration_mm_s IS NOT NULL THEN 'NORMAL' END AS band, count(*) AS n
FROM sensor_clean s JOIN (SELECT machine_type, avg(vibration_mm_s) AS m, stddev_samp(vibration_mm_s) AS d FROM sensor_clean GROUP BY machine_type) t USING (machine_type) GROUP BY ALL""",
    ("sensor_clean",),
)
def sigma_bands(spark, sf_dir):
    clean = quality.clean_sensor(inputs.sensor_raw(spark, sf_dir))
    levels = profile.sigma_thresholds(clean, ["vibration_mm_s"])
    banded = profile.sigma_bands(clean, levels, "vibration_mm_s")
    return banded.groupBy("machine_type", "band").agg(F.count(F.lit(1)).alias("n"))


# --- encoding -------------------------------------------------------------

_STATUS = ["DOWN", "MAINTENANCE", "RUNNING"]
_TYPES = ["CNC", "INJECTION_MOLDER", "PRESS"]


@query(
    "one_hot_frozen",
    "SELECT machine_id, sim_day, shift, "
    + ", ".join(f"CASE WHEN machine_type = '{t}' THEN 1 ELSE 0 END AS machine_type_{t}" for t in _TYPES)
    + ", "
    + ", ".join(f"CASE WHEN operating_status = '{t}' THEN 1 ELSE 0 END AS operating_status_{t}" for t in _STATUS)
    + " FROM split_features",
    ("split_features",),
)
def one_hot_frozen(spark, sf_dir):
    """0/1 columns for the categories seen in training, applied to all splits."""
    columns = ["machine_id", "sim_day", "shift", "split", "machine_type", "operating_status"]
    features = durable(tables.feature_table(spark, sf_dir).select(*columns))
    frozen = encode.train_categories(features, ["machine_type", "operating_status"])
    return encode.one_hot(features, frozen).drop("split")


@query(
    "missing_flags",
    "SELECT machine_id, sim_day, shift, "
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing, round(coalesce({c}, (SELECT median({c}) FROM split_features WHERE split = 'train')), 6) AS {c}"
        for c in ("temperature_k_std", "days_since_last_maintenance", "quality_score_lag1")
    )
    + " FROM split_features",
    ("split_features",),
)
def missing_flags(spark, sf_dir):
    """Missing flags and training medians for the columns that are NULL in any split."""
    names = ["temperature_k_std", "days_since_last_maintenance", "quality_score_lag1", "production_rate"]
    features = durable(tables.feature_table(spark, sf_dir).select("machine_id", "sim_day", "shift", "split", *names))
    contract = encode.fit_contract(features, names)
    filled = encode.flag_and_impute(features, contract.medians, contract.flagged)
    flagged = [c for c in names if c != "production_rate"]
    return rounded(filled.select("machine_id", "sim_day", "shift", *flagged, *[f"{c}_missing" for c in flagged]))


@query(
    "contract_conform",
    """
SELECT machine_id, sim_day, shift, production_rate, round(coalesce(quality_score_lag1, (SELECT median(quality_score_lag1) FROM split_features WHERE split = 'train')), 6) AS quality_score_lag1,
  """
    + ", ".join(f"CASE WHEN operating_status = '{t}' THEN 1.0 ELSE 0.0 END::DOUBLE AS operating_status_{t}" for t in _STATUS)
    + """, CASE WHEN quality_score_lag1 IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS quality_score_lag1_missing FROM split_features WHERE split = 'test'""",
    ("split_features",),
)
def contract_conform(spark, sf_dir):
    """Test rows rebuilt to the exact training columns and order."""
    columns = ["machine_id", "sim_day", "shift", "split", "production_rate", "quality_score_lag1", "operating_status"]
    features = durable(tables.feature_table(spark, sf_dir).select(*columns))
    contract = encode.fit_contract(features, ["production_rate", "quality_score_lag1"], ["operating_status"])
    test = features.filter(F.col("split") == "test")
    return rounded(encode.apply_contract(test, contract, keep=["machine_id", "sim_day", "shift"]))


@query(
    "column_pruning",
    "SELECT 'production_count' AS \"column\", count(*) AS rows FROM production_clean UNION ALL SELECT 'production_rate', count(*) FROM production_clean UNION ALL SELECT 'quality_score', count(*) FROM production_clean UNION ALL SELECT 'downtime_minutes', count(*) FROM production_clean",
    ("production_clean",),
)
def column_pruning(spark, sf_dir):
    """Numeric columns chosen from the schema; ids, dates and text are dropped."""
    clean = quality.clean_production(inputs.production_raw(spark, sf_dir))
    numeric = clean.select(*profile.numeric_columns(clean))
    counts = numeric.agg(*[F.count(F.lit(1)).alias(c) for c in numeric.columns])
    return counts.unpivot([], numeric.columns, "column", "rows")


# --- sampling and assets --------------------------------------------------


@query(
    "stratified_split",
    """
SELECT vec_id, label, CASE WHEN place <= floor(n * 0.6) THEN 'train' WHEN place <= floor(n * 0.6) + floor(n * 0.2) THEN 'validation' ELSE 'test' END AS split FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || vec_id), vec_id) AS place, count(*) OVER (PARTITION BY label) AS n FROM embeddings)""",
)
def stratified_split(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return sampling.stratified_split(vectors, "label", "vec_id")


@query(
    "event_stratified_split",
    """
SELECT event_type, split, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM (
  SELECT event_id, event_type, CASE WHEN place <= floor(n * 0.6) THEN 'train' WHEN place <= floor(n * 0.6) + floor(n * 0.2) THEN 'validation' ELSE 'test' END AS split FROM (
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id) AS place, count(*) OVER (PARTITION BY event_type) AS n FROM events)) GROUP BY ALL""",
)
def event_stratified_split(spark, sf_dir):
    """The same split with labels that each hold a fifth of all rows."""
    events = inputs.events(spark, sf_dir).select("event_id", "event_type")
    split = sampling.stratified_split(events, "event_type", "event_id")
    return split.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query(
    "labelled_assets",
    """
SELECT page_id AS asset, label, CASE label WHEN 'normal' THEN 0 ELSE 1 END AS label_code FROM (
  SELECT page_id, CASE WHEN contains(url, 'https') THEN 'normal' ELSE 'defect' END AS label, CASE WHEN contains(url, '.com') THEN 'train' ELSE 'test' END AS split FROM pages) WHERE split = 'train'""",
)
def labelled_assets(spark, sf_dir):
    """Asset metadata of one split with its numeric class."""
    pages = inputs.table(spark, sf_dir, "pages")
    metadata = pages.select(
        F.col("page_id").alias("asset"),
        F.when(F.contains("url", F.lit("https")), "normal").otherwise("defect").alias("label"),
        F.when(F.contains("url", F.lit(".com")), "train").otherwise("test").alias("split"),
    )
    return readers.labelled_assets(metadata, "train").drop("split")


@query(
    "union_of_splits",
    "SELECT split, count(*) AS n, round(sum(prob), 6) AS prob_sum FROM scored GROUP BY split",
    ("scored",),
)
def union_of_splits(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    parts = [scored.filter(F.col("split") == s) for s in ("train", "validation", "test")]
    whole = readers.union_splits(*parts)
    return rounded(whole.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("prob").alias("prob_sum")))


@query(
    "key_union",
    "SELECT key, count(*) AS sides FROM (SELECT DISTINCT o_custkey AS key, 1 AS side FROM orders UNION ALL SELECT DISTINCT c_custkey, 2 FROM customer) GROUP BY key",
)
def key_union(spark, sf_dir):
    """Distinct keys of two tables and in how many of them each occurs."""
    ordered = inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")).distinct()
    known = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return ordered.unionAll(known.distinct()).groupBy("key").agg(F.count(F.lit(1)).alias("sides"))


@query(
    "distinct_list",
    "SELECT o_orderpriority, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM orders GROUP BY o_orderpriority",
)
def distinct_list(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderpriority").agg(F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@query(
    "machine_filter",
    "SELECT machine_type, operating_status, count(*) AS n FROM sensor_distinct WHERE operating_status IN ('DOWN', 'RUNNING') AND machine_type = 'PRESS' GROUP BY ALL",
    ("sensor_distinct",),
)
def machine_filter(spark, sf_dir):
    """Equality and membership filters on normalised labels."""
    clean = quality.clean_sensor(inputs.sensor_raw(spark, sf_dir))
    chosen = clean.filter(F.col("operating_status").isin("DOWN", "RUNNING") & (F.col("machine_type") == "PRESS"))
    return chosen.groupBy("machine_type", "operating_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    "SELECT event_type AS label, count(*) AS n, round((SELECT count(*) FROM events) / (5.0 * count(*)), 6) AS weight FROM events GROUP BY event_type",
)
def class_weights(spark, sf_dir):
    events = inputs.events(spark, sf_dir).select(F.col("event_type").alias("label"))
    return rounded(evaluate.balanced_weights(events))


@query(
    "positive_class_weight",
    "SELECT label, count(*) AS n, round(sum(CASE WHEN label = 1 THEN neg / greatest(pos, 1) ELSE 1.0 END), 6) AS weight_sum FROM scored, (SELECT count(*) FILTER (label = 1)::DOUBLE AS pos, count(*) FILTER (label = 0)::DOUBLE AS neg FROM scored) GROUP BY label",
    ("scored",),
)
def positive_class_weight(spark, sf_dir):
    weighted = evaluate.positive_weight(inputs.scored(spark, sf_dir))
    return rounded(weighted.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight_sum")))
