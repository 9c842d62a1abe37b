"""The whole work as jobs: prepare tables, train models, decide for every machine, record reviews.

`python -m plantflow.plans.jobs prepare RAW OUT` and `... train OUT` run the first two.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantflow import config
from plantflow.config import CATEGORICAL_COLUMNS, ID_COLUMNS, SEQUENCE_COLUMNS, TARGET, Economics, SplitDays
from plantflow.operators import decide, encode, evaluate, explain, features, integrate, models, profile, quality, retrieve, score, whatif
from plantflow.session import build_session, durable
from plantflow.sources import readers, sinks


def prepare(spark: SparkSession, raw_dir: str, out_dir: str, days: SplitDays = SplitDays()) -> DataFrame:
    """Raw CSV folder to cleaned, integrated and split tables plus their reports; returns the split table.

    Every table is written once, and the next step reads what was written.
    """
    raw = {
        "sensor": readers.read_raw_sensor(spark, raw_dir),
        "production": readers.read_raw_production(spark, raw_dir),
        "maintenance": readers.read_raw_maintenance(spark, raw_dir),
    }
    clean, report = {}, None
    for name, table in raw.items():
        clean[name], entries = quality.clean_and_record(name, table, f"{out_dir}/cleaned_{name}")
        report = entries if report is None else report.unionByName(entries)
        sinks.write_report(profile.dataset_overview(clean[name]), f"{out_dir}/reports/overview_{name}")
    sinks.write_report(report, f"{out_dir}/reports/cleaning")

    sinks.write_table(integrate.integrate(clean["production"], clean["sensor"], clean["maintenance"]), f"{out_dir}/integrated")
    integrated = spark.read.parquet(f"{out_dir}/integrated")
    sinks.write_report(integrate.integration_summary(clean["production"], integrated), f"{out_dir}/reports/integration")
    sinks.write_splits(features.time_split(features.build_features(integrated), days), f"{out_dir}/splits")

    table = readers.read_splits(spark, f"{out_dir}/splits")
    numeric = profile.numeric_columns(table)
    means = [c for c in integrated.columns if c.endswith("_mean")]
    key = ["production_rate", "production_count", "quality_score", "downtime_minutes", "vibration_mm_s_mean", "temperature_k_mean", "pressure_bar_mean"]
    reports = {
        "features": features.feature_summary(integrated, table),
        "split": features.split_summary(table),
        "day_overlap": features.overlapping_days(table),
        "scaler": profile.scaler_statistics(table, numeric),
        "numeric_summary": profile.numeric_summary(integrated, key),
        "failure_rate": profile.rate_by_key(table),
        "correlation": profile.correlation_matrix(integrated, means),
    }
    for name, frame in reports.items():
        sinks.write_report(frame, f"{out_dir}/reports/{name}")
    return table


def train(spark: SparkSession, out_dir: str, names: Sequence[str] = tuple(models.MODELS), **settings) -> DataFrame:
    """Fit, tune and compare the classifiers on a prepared folder; returns all metrics.

    Saves each model as one pipeline with its encoding and its threshold (read by `load_model`), the contract of the
    best one, the metrics (wide and long) and the registry entry of the best model.
    """
    table = readers.read_splits(spark, f"{out_dir}/splits")
    numeric = [c for c in profile.numeric_columns(table) if c not in ID_COLUMNS]
    fitted, scored, contract = models.train_and_score(table, numeric, CATEGORICAL_COLUMNS, names=names, **settings)
    metrics = durable(evaluate.tuned_evaluation(scored))
    tuned = {r["model"]: r["threshold"] for r in metrics.filter(F.col("split") == "validation").select("model", "threshold").collect()}
    for name, model in fitted.items():
        own = contract if tuned.get(name) is None else replace(contract, threshold=float(tuned[name]))
        models.fitted_pipeline(model, own).write().overwrite().save(f"{out_dir}/models/{name}")
    sinks.write_report(metrics, f"{out_dir}/reports/metrics")
    sinks.write_report(evaluate.long_metrics(metrics), f"{out_dir}/reports/metrics_long")
    sinks.write_report(evaluate.compare_models(metrics), f"{out_dir}/reports/comparison")
    best = durable(evaluate.best_model(metrics, names))
    chosen = best.first()
    if chosen is not None and tuned.get(chosen["model"]) is not None:
        contract = replace(contract, threshold=float(tuned[chosen["model"]]))
    contract.save(spark, f"{out_dir}/models/contract")
    sinks.register_model(best, f"{out_dir}/registry", "failure_predictor", "train", "highest validation F1")
    return metrics


def load_model(out_dir: str, name: str) -> PipelineModel:
    """A saved pipeline, for `models.predict`."""
    return PipelineModel.load(f"{out_dir}/models/{name}")


def _anchored(table: DataFrame, anchors: DataFrame, columns: Sequence[str], window: int):
    """Contract, anchored rows (gaps filled), standardised windows by anchor, and the last row of each with its raw values."""
    wanted = dict.fromkeys(["machine_id", "machine_type", "operating_status", "split", "sim_day", "shift", *columns])
    table = durable(table.select(*wanted))
    contract = encode.fit_contract(table, list(columns), flags=False, standardise=True, window=window)
    rows = durable(score.anchored_rows(table, anchors, window))
    raw = encode.flag_and_impute(rows, contract.medians, [])
    standard = encode.apply_contract(rows, contract, keep=[score.ANCHOR, "position"])
    windows = score.window_arrays(standard, contract.features, score.ANCHOR)
    return table, contract, windows, raw.filter(F.col("position") == window)


def explain_at(
    table: DataFrame, anchors: DataFrame, scorer: score.Scorer, columns: Sequence[str], threshold: float = 0.5, window: int = config.SEQUENCE_SHIFTS
) -> DataFrame:
    """Score and attribution of the windows that end at each anchor `(machine_id, sim_day, shift)`: one row an anchor.

    `(anchor, machine_id, sim_day, shift, prob, predicted_failure, risk_level, feature_explanations)`; any number of
    anchors, a machine may have many. An anchor without a full window has no row.
    """
    _, contract, windows, state = _anchored(table, anchors, columns, window)
    names = contract.features
    actual = state.select(score.ANCHOR, "machine_id", "sim_day", "shift", F.array(*[F.col(c).cast("double") for c in names]).alias("actual"))
    found = durable(explain.neutralisation_importance(windows.join(actual, score.ANCHOR), names, scorer, [score.ANCHOR]))
    chances = score.risk(found.groupBy(score.ANCHOR).agg(F.max("base_prob").alias("prob")), threshold)
    lists = explain.explanation_lists(explain.top_contributions(found, [score.ANCHOR]), [score.ANCHOR])
    return actual.drop("actual").join(chances, score.ANCHOR).join(lists, score.ANCHOR)


def simulate_at(
    table: DataFrame,
    anchors: DataFrame,
    scorer: score.Scorer,
    columns: Sequence[str],
    economics: Economics = Economics(),
    horizon_shifts: int | None = None,
    window: int = config.SEQUENCE_SHIFTS,
) -> DataFrame:
    """What-if records (see `whatif.scenario_records`) of the states at each anchor, one row an anchor."""
    table, contract, windows, state = _anchored(table, anchors, columns, window)
    baseline = profile.healthy_baseline(table, columns)
    cases = whatif.scenario_probabilities(
        state, windows, baseline, contract.features, contract.means, contract.stds, scorer, economics, window, score.ANCHOR
    )
    return whatif.scenario_records(cases, economics, horizon_shifts, [score.ANCHOR])


def decide_all(
    table: DataFrame,
    scorer: score.Scorer,
    threshold: float = 0.5,
    images: DataFrame | None = None,
    notes: DataFrame | None = None,
    index: retrieve.Index | retrieve.Chunked | None = None,
    columns: Sequence[str] = tuple(SEQUENCE_COLUMNS),
    economics: Economics = Economics(),
    window: int = config.SEQUENCE_SHIFTS,
    at: tuple[int, str] | None = None,
) -> DataFrame:
    """Findings, decision, explanation and trace of every machine in a split feature table, one row each.

    With `at`, a (day, shift), machines are judged by their window that ends there instead of by their last one.

    The findings raise few different questions (one of each signal and two more), so pages that only they are asked of
    need no index: `retrieve.chunked` is enough.

    `images` and `notes` are latest-result inputs of `decide.latest_findings` with an `at` column for
    their order. A part that is not given counts as unavailable.
    """
    columns = list(columns)
    wanted = dict.fromkeys(["machine_id", "machine_type", "operating_status", "split", "sim_day", "shift", *columns])
    table = durable(table.select(*wanted))
    contract = encode.fit_contract(table, columns, ["operating_status"], flags=False, standardise=True, window=window)
    names = contract.features

    # Each machine's last full window, raw (with one-hot status) and standardised.
    if at is None:
        latest = score.latest_window(table, window)
    else:
        day, shift = at
        anchors = table.filter((F.col("sim_day") == day) & (F.col("shift") == shift)).select("machine_id", "sim_day", "shift")
        latest = score.anchored_rows(table, anchors, window).drop(score.ANCHOR)
    recent = encode.flag_and_impute(latest, contract.medians, [])
    raw = encode.one_hot(recent.withColumn("_status", F.col("operating_status")), contract.categories)
    state = raw.filter(F.col("position") == window)
    state = durable(state)
    actual = state.select("machine_id", F.array(*[F.col(c).cast("double") for c in names]).alias("actual"))
    standardised = score.window_arrays(encode.apply_contract(recent, contract, keep=["machine_id", "position"]), names)
    windows = durable(standardised.join(actual, "machine_id"))

    contributions = durable(explain.neutralisation_importance(windows, names, scorer))
    chances = contributions.groupBy("machine_id").agg(F.max("base_prob").alias("prob"))
    signals = score.important_signals(state, columns, contract.means, contract.stds).select("machine_id", "important_signals")
    predictions = score.risk(chances, threshold).join(signals, "machine_id")
    lists = explain.explanation_lists(explain.top_contributions(contributions)).withColumns(
        {
            "top_features": F.transform("feature_explanations", lambda f: f["feature"]),
            "tabular_method": F.lit("permutation_importance"),
        }
    )

    baseline = profile.healthy_baseline(table, columns)
    cases = whatif.scenario_probabilities(state, windows, baseline, names, contract.means, contract.stds, scorer, economics, window)
    scenarios = whatif.scenario_table(cases, economics)
    listed = scenarios.groupBy("machine_id").agg(
        F.sort_array(F.collect_list(F.struct("scenario_order", "scenario", "cumulative_failure_risk", "expected_downtime_hours", "expected_production_units", "estimated_net_value_usd"))).alias("scenarios")
    )
    twin = whatif.recommend(scenarios).select(
        "machine_id", "recommended_scenario", "recommendation_basis", "horizon_shifts", F.lit("ok").alias("twin_status")
    )

    spark = table.sparkSession
    images = images if images is not None else spark.createDataFrame([], "machine_id string, cv_prediction string, cv_confidence double, image_path string, at timestamp")
    notes = notes if notes is not None else spark.createDataFrame([], "machine_id string, nlp_prediction string, nlp_confidence double, timestamp string, at timestamp")
    found = decide.latest_findings(images, notes, [F.col("at")], [F.col("at")])
    machines = table.select("machine_id").distinct()
    findings = decide.combine(
        decide.with_predictions(decide.with_findings(machines, found), predictions, window), lists, twin, listed
    ).withColumn("question", decide.knowledge_question())
    if index is not None:
        findings = durable(findings)
        asked = findings.select("question").distinct().withColumn("query_id", F.md5(F.col("question").cast("binary")))
        answered = retrieve.answers(asked, retrieve.retrieve(asked, index)).select(
            "question", "answer", "grounded", "sources",
            F.transform("sources", lambda s: s["document"]).alias("evidence_documents"),
            F.lit("ok").alias("rag_status"),
        )
        findings = findings.join(answered, "question", "left")
    decided = decide.with_trace(decide.decide(findings))
    return explain.explanation_record(decided).withColumn("machine_context", retrieve.machine_context(decided)).withColumn(
        "generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    )


EVIDENCE = ["xai", "scenarios", "recommended_scenario", "failure_probability", "risk_level", "vision_class", "incident_type"]


def record_reviews(decided: DataFrame, decisions: DataFrame, log_path: str) -> DataFrame:
    """Append the valid human decisions with their evidence to the log; returns the refused ones with the reason."""
    kept = ["machine_id", "generated_at", "recommendation", "priority", "reasoning", *EVIDENCE]
    checked = durable(decide.check_decisions(decisions, decided.select(*kept)))
    sinks.append_audit(decide.audit_records(checked, EVIDENCE), log_path)
    return decide.rejected_decisions(checked).select(*decisions.columns, "error")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(dest="job", required=True)
    preparing = sub.add_parser("prepare")
    preparing.add_argument("raw_dir")
    preparing.add_argument("out_dir")
    preparing.add_argument("--start", default=SplitDays.start)
    preparing.add_argument("--days", help='JSON such as {"train": [1, 50], "validation": [51, 65], "test": [66, 90]}')
    training = sub.add_parser("train")
    training.add_argument("out_dir")
    args = parser.parse_args()
    spark = build_session(f"plantflow-{args.job}")
    if args.job == "prepare":
        ranges = {k: tuple(v) for k, v in json.loads(args.days or "{}").items()}
        prepare(spark, args.raw_dir, args.out_dir, SplitDays(start=args.start, **ranges))
    else:
        train(spark, args.out_dir)


if __name__ == "__main__":
    main()
