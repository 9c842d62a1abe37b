import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantflow import wording
from plantflow.config import Economics
from plantflow.operators import decide, explain, score, whatif
from plantflow.plans.catalog_windows import fixed_weights
from plantflow.sources import sinks


def findings(spark, **values):
    base = {"machine_id": "M-1", **{c: None for c in decide.FINDING_COLUMNS}, **values}
    schema = "machine_id string, " + ", ".join(f"{c} {t}" for c, t in decide.FINDING_COLUMNS.items())
    return spark.createDataFrame([tuple(base[c] for c in ["machine_id", *decide.FINDING_COLUMNS])], schema)


def risk(level, p=0.5):
    return {"pm_status": "ok", "risk_level": level, "failure_probability": p, "important_signals": ["vibration_mm_s_mean", "load_pct_mean"], "model_name": "gru"}


DEFECT = {"vision_status": "ok", "defect_detected": True, "vision_confidence": 0.913}


@pytest.mark.parametrize(
    "values, priority, text",
    [
        (risk("HIGH"), "URGENT", wording.URGENT),
        ({**risk("HIGH"), **DEFECT}, "URGENT", wording.URGENT_DEFECT % "HIGH"),
        ({**DEFECT, "nlp_status": "ok", "incident_type": "Safety"}, "URGENT", wording.URGENT_DEFECT % "None"),
        (risk("MEDIUM"), "ELEVATED", wording.ELEVATED_RISK),
        ({**risk("MEDIUM"), **DEFECT}, "ELEVATED", wording.ELEVATED_BOTH),
        ({**risk("LOW"), **DEFECT}, "ELEVATED", wording.ELEVATED_DEFECT),
        (risk("LOW"), "ROUTINE", wording.ROUTINE),
        ({}, "ROUTINE", wording.ROUTINE),
        ({"rag_status": "ok", "grounded": True}, "ROUTINE", wording.ROUTINE + wording.SOP_SUFFIX),
        ({"pm_status": "unavailable", "risk_level": "HIGH"}, "ROUTINE", wording.ROUTINE),
    ],
)
def test_rules(spark, values, priority, text):
    row = decide.decide(findings(spark, **values)).first()
    assert (row.priority, row.recommendation) == (priority, text)


def test_questions(spark):
    ask = lambda **v: findings(spark, **v).select(decide.knowledge_question().alias("q")).first().q
    assert "vibration mm s mean" in ask(**risk("HIGH"), **DEFECT)
    assert "preventive maintenance" in ask(**risk("LOW"))
    assert ask(**DEFECT) == wording.QUESTION_DEFECT


def test_reasoning_lines(spark):
    row = decide.decide(
        findings(
            spark, **risk("HIGH", 0.1234), **DEFECT, nlp_reason="no note", rag_status="ok", grounded=True, evidence_documents=["b", "a", "b"],
            top_features=["x_y", "z"], tabular_method="m", twin_status="ok", horizon_shifts=6, recommended_scenario="reduce_load", recommendation_basis="best",
        )
    ).first()
    assert row.reasoning == [
        "Predictive maintenance model (gru) estimates a 12.3% failure probability for the next shift (risk level: HIGH), driven most by: vibration_mm_s_mean, load_pct_mean.",
        wording.REASON_DEFECT % "91.3%",
        "NLP result unavailable: no note.",
        "Relevant SOP evidence retrieved from: a, b.",
        "Explainability analysis (m) attributes this prediction most to: x y, z.",
        "Digital twin what-if simulation over the next 6 shifts favors 'reduce load' (best).",
    ]


def test_trace_has_every_step(spark):
    trace = decide.with_trace(decide.decide(findings(spark, **risk("LOW")))).first().trace
    assert [t.agent for t in trace] == [
        "vision_agent", "predictive_maintenance_agent", "nlp_info", "xai_layer", "digital_twin", "knowledge_rag_agent", "planning_decision_agent",
    ]
    assert [t.status for t in trace] == ["unavailable", "ok", "unavailable", "unavailable", "unavailable", "unavailable", "ok"]
    assert trace[1].output_summary == "machine_id=M-1, failure_probability=0.5, predicted_failure=None, risk_level=LOW"
    assert trace[0].output_summary == "status=unavailable"
    assert trace[3].output_summary == "top_features=[], vision_available=False"
    assert trace[4].output_summary == "recommended_scenario=None"
    assert trace[5].input_summary == f"question='{wording.QUESTION_ROUTINE}'"


def test_trace_names_features_and_vision(spark):
    given = findings(spark, **risk("LOW")).withColumns(
        {
            "top_features": F.array(F.lit("a"), F.lit("b")),
            "vision_status": F.lit("ok"),
            "defect_detected": F.lit(True),
        }
    )
    trace = decide.with_trace(decide.decide(given)).first().trace
    assert trace[0].output_summary == "machine_id=M-1, defect_detected=True, defect_type=None, severity=None"
    assert (trace[3].status, trace[3].output_summary) == ("ok", "top_features=['a', 'b'], vision_available=True")


def test_latest_findings_keep_one_sided_machines(spark):
    images = spark.createDataFrame([("M-1", 1, "normal", 0.6, "a"), ("M-1", 2, "defect", 0.9, "b")], "machine_id string, n int, cv_prediction string, cv_confidence double, image_path string")
    notes = spark.createDataFrame([("M-2", "2024-01-02", "Quality", 0.7), ("M-2", "2024-01-01", "Safety", 0.8)], "machine_id string, timestamp string, nlp_prediction string, nlp_confidence double")
    rows = {r.machine_id: r for r in decide.latest_findings(images, notes, [F.col("n")], [F.col("timestamp")]).collect()}
    assert (rows["M-1"].cv_prediction, rows["M-1"].nlp_prediction) == ("defect", None)
    assert (rows["M-2"].cv_prediction, rows["M-2"].nlp_prediction) == (None, "Quality")


# --- what-if --------------------------------------------------------------


def states(spark, *rows):
    return spark.createDataFrame(list(rows), "machine_id string, production_rate double, p_continue double, p_maintenance double, p_reduced double")


def test_scenarios_by_hand(spark):
    rows = {r.scenario: r for r in whatif.scenario_table(states(spark, ("M-1", 40.0, 0.1, 0.02, 0.05))).collect()}
    go = rows["continue_operating"]
    chance = 1 - 0.9**6
    assert go.cumulative_failure_risk == round(chance, 4)
    units = 40.0 * (48 - chance * 8)
    assert go.expected_production_units == pytest.approx(units, abs=0.051)
    assert go.estimated_net_value_usd == pytest.approx(units * 12 - chance * 8 * 150 - chance * 2000, abs=0.011)
    stop = rows["stop_for_maintenance"]
    assert (stop.expected_downtime_hours, stop.production_loss_units, stop.expected_production_units) == (4.5, 180.0, 1740.0)
    assert stop.cumulative_failure_risk == pytest.approx(1 - 0.98 ** (43.5 / 8), abs=1e-4)
    slow = rows["reduce_load"]
    assert slow.production_loss_units == pytest.approx(40 * 48 - 32 * (48 - (1 - 0.95**6) * 8), abs=0.051)


def test_short_horizon_caps_the_maintenance_stop(spark):
    table = whatif.scenario_table(states(spark, ("M-1", 10.0, 0.0, 0.0, 0.0)), Economics(shift_hours=2.0), 1)
    stop = table.filter("scenario = 'stop_for_maintenance'").first()
    assert (stop.expected_downtime_hours, stop.expected_production_units) == (2.0, 0.0)


def test_recommendation_is_the_best_and_first_on_ties(spark):
    table = whatif.scenario_table(states(spark, ("M-1", 40.0, 0.0, 0.0, 0.0), ("M-2", 0.0, 0.0, 0.0, 0.0), ("M-3", 40.0, 0.9, 0.0, 0.9)))
    got = {r.machine_id: r.recommended_scenario for r in whatif.recommend(table).collect()}
    assert got == {"M-1": "continue_operating", "M-2": "continue_operating", "M-3": "stop_for_maintenance"}


def test_counterfactual_rows(spark):
    state = spark.createDataFrame([("M-1", 10.0, 50.0, 3.0)], "machine_id string, production_rate double, downtime_minutes double, maintenance_count_past_7d double")
    baseline = spark.createDataFrame([(8.0, 9.0)], "production_rate double, downtime_minutes double")
    after = whatif.after_maintenance(state, baseline, ["production_rate", "downtime_minutes", "maintenance_count_past_7d"]).first()
    assert (after.production_rate, after.downtime_minutes, after.maintenance_count_past_7d) == (8.0, 0.0, 4.0)
    assert whatif.reduced_load(state).first().production_rate == pytest.approx(8.0)
    flat = whatif.flat_window(state, ["production_rate"], {"production_rate": 4.0}, {"production_rate": 2.0}).first()
    assert flat.window == [[3.0]] * 5


# --- scoring and attribution ----------------------------------------------


def test_recurrent_scorer_matches_step_by_step(spark):
    weights = fixed_weights(3, 4)
    rng = np.random.default_rng(0)
    data = rng.normal(size=(6, 5, 3))
    df = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(data)], "id int, window array<array<double>>")
    got = [r.prob for r in score.recurrent_scorer(weights)(df, "window").orderBy("id").collect()]

    def one(sequence):
        h = np.zeros(4)
        for x in sequence:
            z = 1 / (1 + np.exp(-(np.concatenate([x, h]) @ weights.wz + weights.bz)))
            r = 1 / (1 + np.exp(-(np.concatenate([x, h]) @ weights.wr + weights.br)))
            n = np.tanh(np.concatenate([x, r * h]) @ weights.wn + weights.bn)
            h = (1 - z) * n + z * h
        return float(1 / (1 + np.exp(-(h @ weights.wo + weights.bo)))[0])

    assert got == pytest.approx([one(s) for s in data])
    again = score.RecurrentWeights.from_table(weights.to_table(spark))
    assert again.probabilities(data) == pytest.approx(got)


def test_neutralised_features(spark):
    windows = spark.createDataFrame([("M-1", [[1.0, 2.0], [3.0, -4.0]])], "machine_id string, window array<array<double>>")
    found = explain.neutralisation_importance(windows, ["a", "b"], score.linear_scorer([0.5, 0.25], 0.1))
    rows = {r.feature: r for r in found.collect()}
    squash = lambda x: 1 / (1 + np.exp(-x))
    base = squash(0.1 + (0.5 * 4 + 0.25 * -2) / 2)
    assert rows["a"].contribution == pytest.approx(base - squash(0.1 - 0.25))
    assert rows["b"].contribution == pytest.approx(base - squash(0.1 + 1.0))
    assert (rows["a"].value, rows["b"].value) == (3.0, -4.0)
    top = explain.top_contributions(found, k=1).first()
    assert (top.feature, top.direction, top["rank"]) == ("a", "increases_risk", 1)


def test_linear_contributions_sum_to_the_distance_from_the_mean(spark):
    df = spark.createDataFrame([("M-1", 1.0, 2.0), ("M-2", 3.0, 6.0)], "machine_id string, a double, b double")
    rows = explain.linear_contributions(df, df, {"a": 2.0, "b": -1.0}).collect()
    assert {(r.machine_id, r.feature): r.contribution for r in rows} == {("M-1", "a"): -2.0, ("M-1", "b"): 2.0, ("M-2", "a"): 2.0, ("M-2", "b"): -2.0}


def test_sample_is_seeded(spark):
    df = spark.range(500)
    one, two = (sorted(r.id for r in explain.background_sample(df, "id", 50, seed).collect()) for seed in (42, 42))
    assert one == two and len(one) == 50
    assert explain.background_sample(spark.range(7), "id").count() == 7


def test_explanation_record_states_what_is_missing(spark):
    record = "array<struct<rank:int,feature:string,value:double,contribution:double,direction:string>>"
    df = spark.createDataFrame(
        [
            ("M-1", "ok", None, 0.9, 1, "HIGH", [(1, "load_pct", 1.0, 0.2, "increases_risk"), (2, "torque", 1.0, -0.1, "decreases_risk")], "ok", None, "defect", 0.8),
            ("M-2", "unavailable", "too few", None, None, None, None, "unavailable", "no image", None, None),
        ],
        f"machine_id string, pm_status string, pm_reason string, failure_probability double, predicted_failure int, risk_level string, feature_explanations {record}, vision_status string, vision_reason string, vision_class string, vision_confidence double",
    )
    rows = {r.machine_id: r.xai for r in explain.explanation_record(df).collect()}
    assert rows["M-1"].human_summary == (
        "Predicted risk: HIGH (failure probability 90.0%). The prediction is pushed toward failure mainly by: load pct. "
        "Pushing toward normal operation: torque. " + wording.SUMMARY_DEFECT % "80.0%"
    )
    assert (rows["M-2"].prediction.status, rows["M-2"].prediction.reason) == ("unavailable", "too few")
    assert rows["M-2"].human_summary == wording.SUMMARY_NO_RISK
    assert (rows["M-2"].vision_explanation.available, rows["M-2"].vision_explanation.reason, rows["M-2"].top_features) == (False, "no image", [])


# --- review ---------------------------------------------------------------

DECISIONS = "machine_id string, human_decision string, comment string, modified_action string, supervisor string"


def checked(spark, *rows):
    known = spark.createDataFrame([("M-1", "Do it.", "URGENT", ["because"])], "machine_id string, recommendation string, priority string, reasoning array<string>")
    return decide.check_decisions(spark.createDataFrame(list(rows), DECISIONS), known)


@pytest.mark.parametrize(
    "row, error",
    [
        (("M-1", "approve", None, None, "s"), None),
        (("M-1", "REJECT", "", None, "s"), wording.ERROR_REJECT),
        (("M-1", "MODIFY", "c", None, "s"), wording.ERROR_ACTION),
        (("M-1", "MODIFY", None, "a", "s"), wording.ERROR_MODIFY),
        (("M-1", "MAYBE", "c", "a", "s"), wording.ERROR_DECISION % "'MAYBE'"),
        (("M-1", None, "c", "a", "s"), wording.ERROR_DECISION % "None"),
        (("M-2", "APPROVE", None, None, "s"), wording.ERROR_EMPTY),
    ],
)
def test_decision_checks(spark, row, error):
    assert checked(spark, row).first().error == error


def test_audit_log(spark, tmp_path):
    path = str(tmp_path / "audit")
    rows = [("M-1", "approve", None, "ignored", "s"), ("M-1", "Modify", "c", "Wait.", "s"), ("M-1", "REJECT", "no", None, "s"), ("M-1", "REJECT", None, None, "s")]
    records = decide.audit_records(checked(spark, *rows))
    assert sinks.read_audit(spark, path, records.schema).isEmpty()
    sinks.append_audit(records, path)
    log = sinks.read_audit(spark, path, records.schema).collect()
    assert {r.human_decision: r.final_action for r in log} == {"APPROVE": "Do it.", "MODIFY": "Wait.", "REJECT": None}
    assert all(r.original_ai_recommendation.recommendation == "Do it." for r in log)
    assert next(r for r in log if r.human_decision == "APPROVE").modified_action is None
    audit = sinks.read_audit(spark, path, records.schema)
    assert sinks.audit_record(audit, log[0].decision_id).count() == 1
    assert sinks.audit_for_machine(audit, "M-1").count() == 3 and sinks.audit_for_machine(audit, "M-9").isEmpty()
    sinks.append_audit(decide.audit_records(checked(spark, rows[0])), path)
    assert sinks.read_audit(spark, path, records.schema).count() == 4
    assert json.loads(audit.limit(1).toJSON().first())["supervisor"] == "s"
