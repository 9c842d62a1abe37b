"""Queries: readers and writers, streaming, model training, scoring of counterfactual states."""

from __future__ import annotations

import logging
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plantflow.config import CHANNELS, Economics, SEQUENCE_SHIFTS, TARGET
from plantflow.operators import decide, encode, evaluate, models, profile, retrieve, score, skew, whatif
from plantflow.plans import catalog_decisions, catalog_text, catalog_windows as windows, jobs
from plantflow.plans import inputs as tables
from plantflow.plans.registry import query, rounded
from plantflow.session import durable, new_folder, spread
from plantflow.sources import readers, sinks, star_inputs as inputs
from plantflow.streaming import shifts as streaming


# --- readers and writers --------------------------------------------------


@query(
    "csv_scan",
    "SELECT machine_id, count(*) AS readings, count(temperature_k) AS temperatures, round(avg(vibration_mm_s), 6) AS vibration, CAST(sum(failure_flag) AS BIGINT) AS failures FROM sensor_raw GROUP BY machine_id",
    ("sensor_raw",),
)
def csv_scan(spark, sf_dir):
    """The raw sensor table written as CSV and read back through the typed, validated reader."""
    folder = new_folder(spark, "raw")
    sinks.write_table(inputs.sensor_raw(spark, sf_dir), f"{folder}/raw_sensor_data.csv", format="csv")
    raw = readers.read_raw_sensor(spark, folder)
    return rounded(
        raw.groupBy("machine_id").agg(
            F.count(F.lit(1)).alias("readings"),
            F.count("temperature_k").alias("temperatures"),
            F.avg("vibration_mm_s").alias("vibration"),
            F.sum("failure_flag").alias("failures"),
        )
    )


@query(
    "split_table",
    f"SELECT split, count(*) AS n, CAST(sum({TARGET}) AS BIGINT) AS positives FROM split_features WHERE split IN ('train', 'test') GROUP BY split",
    ("split_features",),
)
def split_table(spark, sf_dir):
    """The feature table written by split and read back; the filter reads two folders only."""
    folder = new_folder(spark, "splits")
    sinks.write_splits(tables.feature_table(spark, sf_dir), folder)
    chosen = readers.read_splits(spark, folder).filter(F.col("split").isin("train", "test"))
    return chosen.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("positives"))


@query(
    "json_records",
    "SELECT machine_id, cv_prediction, cv_confidence, nlp_prediction FROM findings",
    ("findings",),
)
def json_records(spark, sf_dir):
    """Records written as JSON and read back with their schema."""
    folder = new_folder(spark, "records")
    found = catalog_decisions.latest_findings(spark, sf_dir).select("machine_id", "cv_prediction", "cv_confidence", "nlp_prediction")
    sinks.write_report(found, folder)
    return spark.read.schema(found.schema).json(folder)


@query(
    "audit_log",
    "SELECT upper(human_decision) AS human_decision, 2 * count(*) AS n FROM checked WHERE error IS NULL GROUP BY 1",
    ("checked",),
)
def audit_log(spark, sf_dir):
    """Decision records appended twice to the log and read back."""
    folder = new_folder(spark, "audit")
    checked = catalog_decisions._checked(spark, sf_dir)
    for _ in range(2):  # every submission gets its own ids
        records = decide.audit_records(checked)
        sinks.append_audit(records, folder)
    log = sinks.read_audit(spark, folder, records.schema)
    return log.groupBy("human_decision").agg(F.count_distinct("decision_id").alias("n"))


@query(
    "stored_index",
    "SELECT query_id, rank, document, page, round(score, 6) AS score FROM evidence",
    ("evidence",),
)
def stored_index(spark, sf_dir):
    """The text index written, loaded and asked."""
    folder = new_folder(spark, "index")
    catalog_text._index(spark, sf_dir).save(folder)
    loaded = retrieve.Index.load(spark, folder)
    found = retrieve.retrieve(catalog_text._questions(spark, sf_dir), loaded, min_score=catalog_text.CUT)
    return rounded(found.select("query_id", "rank", "document", "page", "score"))


@query(
    "model_registry",
    "SELECT 'failure_predictor' AS registered_model_name, model AS selected_model, 'validation F1' AS selection_basis, v AS version, 'run-1' AS source_run_id FROM (SELECT model FROM tuned_metrics WHERE split = 'validation' ORDER BY f1 DESC, CASE model WHEN 'ratio' THEN 1 ELSE 2 END LIMIT 1), (VALUES (1), (2)) t(v)",
    ("tuned_metrics",),
)
def model_registry(spark, sf_dir):
    """The best model registered twice: versions 1 and 2."""
    folder = new_folder(spark, "registry")
    metrics = durable(evaluate.tuned_evaluation(inputs.scored(spark, sf_dir)))
    best = evaluate.best_model(metrics, ["ratio", "counter"])
    sinks.register_model(best, folder, "failure_predictor", "run-1", "validation F1")
    sinks.register_model(best, folder, "failure_predictor", "run-1", "validation F1")
    return spark.read.parquet(folder)


# --- streaming ------------------------------------------------------------


@query(
    "stream_shift_aggregate",
    f"""
SELECT machine_id, CAST(b AS VARCHAR) AS shift_start, CASE hour(b) WHEN 6 THEN 'Morning' WHEN 14 THEN 'Afternoon' ELSE 'Night' END AS shift, max(failure_flag) AS failure_occurred_this_shift,
  {", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, round(max({c}), 6) AS {c}_max" for c in CHANNELS)}
FROM (SELECT *, time_bucket(INTERVAL 8 HOURS, timestamp, INTERVAL 6 HOURS) AS b FROM sensor_bounded)
WHERE b + INTERVAL 8 HOURS <= (SELECT max(timestamp) - INTERVAL 1 HOUR FROM sensor_bounded) GROUP BY machine_id, b""",
    ("sensor_bounded",),
)
def stream_shift_aggregate(spark, sf_dir):
    """Closed shifts of a sensor stream over everything available."""
    folder = new_folder(spark, "stream")
    readings = inputs.sensor_from_events(inputs.event_stream(spark, sf_dir))
    aggregated = streaming.stream_shift_aggregate(readings)
    run = streaming.write_stream(aggregated, f"{folder}/table", f"{folder}/checkpoint")
    run.awaitTermination()
    logging.getLogger(__name__).info("late readings left out: %d", streaming.late_rows(run))
    closed = spark.read.schema(aggregated.schema).parquet(f"{folder}/table")
    return rounded(
        closed.drop("date").withColumn("shift_start", F.date_format("shift_start", "yyyy-MM-dd HH:mm:ss"))
    )


# --- models ---------------------------------------------------------------

NUMERIC = [
    "production_rate", "quality_score", "downtime_minutes", "downtime_ratio", "production_efficiency",
    *[f"{c}_mean" for c in CHANNELS], "days_since_last_maintenance", "maintenance_count_past_7d",
    "quality_score_lag1", "quality_score_rollmean_3", "downtime_minutes_rollmean_9", "vibration_mm_s_mean_rollmean_9",
]
CATEGORICAL = ["machine_type", "operating_status"]


def _trained(spark, sf_dir, *names, **settings):
    _, scored, _ = models.train_and_score(tables.feature_table(spark, sf_dir), NUMERIC, CATEGORICAL, names=names, **settings)
    return rounded(evaluate.tuned_evaluation(scored))


@query(
    "stored_contract",
    "SELECT split, count(*) AS rows, CAST(0 AS BIGINT) AS different, CAST(0 AS BIGINT) AS decided_otherwise FROM split_features GROUP BY split",
    ("split_features",),
)
def stored_contract(spark, sf_dir):
    """Encoding, model and threshold saved as one pipeline: reloaded, it scores raw rows as the fitted model scored encoded ones."""
    keys, threshold = ["machine_id", "date", "shift"], 0.4
    table = durable(tables.feature_table(spark, sf_dir))
    fitted, scored, contract = models.train_and_score(table, NUMERIC, CATEGORICAL, [*keys, "split"], ["logistic_regression"])
    path = new_folder(spark, "pipeline")
    models.fitted_pipeline(fitted["logistic_regression"], replace(contract, threshold=threshold)).write().save(path)
    again = models.predict(PipelineModel.load(path), table.select(*keys, *NUMERIC, *CATEGORICAL))
    met = skew.join_groups(scored.select(*keys, "split", F.col("prob").alias("direct")), again.select(*keys, "prob", "predicted"), keys, "inner")
    return met.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("direct") - F.col("prob")) > 1e-12).alias("different"),
        F.count_if((F.col("direct") >= threshold) != (F.col("predicted") == 1)).alias("decided_otherwise"),
    )


@query("logistic_regression")
def logistic_regression(spark, sf_dir):
    """Balanced logistic regression: metrics of every split at the tuned threshold."""
    return _trained(spark, sf_dir, "logistic_regression")


@query("random_forest")
def random_forest(spark, sf_dir):
    return _trained(spark, sf_dir, "random_forest")


@query("gradient_boosting")
def gradient_boosting(spark, sf_dir):
    """Boosted trees with the full number of rounds."""
    return _trained(spark, sf_dir, "gradient_boosting")


@query("text_classifier")
def text_classifier(spark, sf_dir):
    """Multinomial classifier of document language on TF-IDF, with macro metrics per split."""
    documents = spread(inputs.table(spark, sf_dir, "documents"))
    part = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % 10
    split = F.when(part < 6, "train").when(part < 8, "validation").otherwise("test")
    said = models.classify_text(documents.withColumn("split", split), "doc_id", "text", "lang", pattern=catalog_text.TOKEN)
    return rounded(evaluate.multiclass_report(said))


@query("counterfactual_scenarios")
def counterfactual_scenarios(spark, sf_dir):
    """What-if scenarios whose risks come from scoring each machine's real and changed states."""
    names = [*windows.SIGNALS, "torque_nm_mean", "rotational_speed_rpm_mean", "load_pct_mean", "maintenance_count_past_7d", "days_since_last_maintenance"]
    features = durable(
        tables.feature_table(spark, sf_dir).select("machine_id", "machine_type", "operating_status", "split", "sim_day", "shift", *names)
    )
    contract = encode.fit_contract(features, names, flags=False, standardise=True, window=SEQUENCE_SHIFTS)
    recent = encode.flag_and_impute(score.latest_window(features), contract.medians, [])
    standard = encode.apply_contract(recent, contract, keep=["machine_id", "position"])
    current = score.window_arrays(standard, names)
    state = recent.filter(F.col("position") == SEQUENCE_SHIFTS)
    baseline = profile.healthy_baseline(features, names)
    scorer = score.recurrent_scorer(windows.fixed_weights(len(names)))
    chances = whatif.scenario_probabilities(state, current, baseline, names, contract.means, contract.stds, scorer)
    return whatif.scenario_table(chances, Economics())



@query("machine_workflow")
def machine_workflow(spark, sf_dir):
    """The whole decision path for every machine: score, attribution, what-if, retrieval, rules, reasoning."""
    columns = [*windows.SIGNALS, "torque_nm_mean", "rotational_speed_rpm_mean", "load_pct_mean", "maintenance_count_past_7d"]
    events = inputs.events(spark, sf_dir).withColumn("machine_id", F.concat(F.lit("M-"), F.col("user_id").cast("string")))
    images = events.filter(F.col("event_type") == "view").select(
        "machine_id", F.when(F.col("k") > 93, "defect").otherwise("normal").alias("cv_prediction"),
        (F.col("k") / 100.0).alias("cv_confidence"), F.col("event_id").cast("string").alias("image_path"), F.col("ts").alias("at"),
    )
    notes = events.filter(F.col("event_type") == "signup").select(
        "machine_id", F.when(F.col("k") > 90, "Safety").otherwise("Quality").alias("nlp_prediction"),
        (F.col("k") / 100.0).alias("nlp_confidence"), F.col("ts").cast("string").alias("timestamp"), F.col("ts").alias("at"),
    )
    scorer = score.recurrent_scorer(windows.fixed_weights(len(columns) + 3))
    decided = jobs.decide_all(
        tables.feature_table(spark, sf_dir), scorer, 0.5, images, notes, catalog_text._chunked(spark, sf_dir), columns
    )
    return decided.select(
        "machine_id", "priority", "recommendation", F.array_join("reasoning", " | ").alias("reasoning"),
        F.col("xai.human_summary").alias("summary"), "question", "grounded", "recommended_scenario", F.size("trace").alias("steps"),
    )
