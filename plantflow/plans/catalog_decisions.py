"""Queries: findings per machine, what-if scenarios, rules, reasoning, human review."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow import wording
from plantflow.config import Economics
from plantflow.functions import columns as fn
from plantflow.operators import decide, retrieve, score, whatif
from plantflow.plans import sql_tables  # noqa: F401  (defines the common tables)
from plantflow.plans.registry import common, query, rounded
from plantflow.sources import sinks, star_inputs as inputs


def q(text: str) -> str:
    """A Python string as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, *values: str) -> str:
    """A `%s` template as an SQL concatenation."""
    parts = template.replace("%d", "%s").split("%s")
    out = [q(parts[0])]
    for value, part in zip(values, parts[1:]):
        out += [value, q(part)]
    return "(" + " || ".join(out) + ")"


# --- derived findings -----------------------------------------------------

_KINDS = ["Scheduled", "Mechanical", "Electrical", "Quality", "Safety"]
MIN_EVENTS = 50
THRESHOLD = 0.25

common(
    "images",
    "SELECT 'M-' || user_id AS machine_id, ts, event_id, CASE WHEN k > 93 THEN 'defect' ELSE 'normal' END AS cv_prediction, k / 100.0::DOUBLE AS cv_confidence, 'img_' || event_id AS image_path FROM ev WHERE event_type = 'view' AND user_id % 4 <> 1",
    ("ev",),
)
common(
    "note_results",
    "SELECT 'M-' || user_id AS machine_id, ts, event_id, (" + str(_KINDS) + ")[event_id % 5 + 1] AS nlp_prediction, (100 - k) / 100.0::DOUBLE AS nlp_confidence, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM ev WHERE event_type = 'signup' AND user_id % 5 <> 2",
    ("ev",),
)
common(
    "findings",
    """
SELECT coalesce(i.machine_id, n.machine_id) AS machine_id, cv_prediction, cv_confidence, image_path AS cv_source_image, nlp_prediction, nlp_confidence, timestamp AS nlp_source_timestamp
FROM (SELECT * FROM images QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY ts DESC, event_id DESC) = 1) i
FULL OUTER JOIN (SELECT * FROM note_results QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY ts DESC, event_id DESC) = 1) n ON i.machine_id = n.machine_id""",
    ("images", "note_results"),
)
common(
    "states",
    """
SELECT 'M-' || user_id AS machine_id, count(*) AS n, avg(k) AS production_rate, count(*) FILTER (event_type = 'error') / count(*)::DOUBLE AS p_continue,
  count(*) FILTER (event_type = 'error') / count(*)::DOUBLE / 4 AS p_maintenance, count(*) FILTER (event_type = 'error') / count(*)::DOUBLE / 2 AS p_reduced,
  CASE WHEN sum(k) % 2 = 0 THEN ['vibration_mm_s_mean', 'load_pct_mean'] ELSE ['torque_nm_mean', 'quality_score'] END AS signals, count(*) FILTER (event_type = 'purchase') AS purchases
FROM ev GROUP BY user_id""",
    ("ev",),
)
common(
    "cases",
    f"""
SELECT machine_id, 1 AS o, 'continue_operating' AS scenario, p_continue AS p, production_rate AS rate, production_rate AS full_rate, 0.0 AS stop FROM states
UNION ALL SELECT machine_id, 2, 'stop_for_maintenance', p_maintenance, production_rate, production_rate, 4.5 FROM states
UNION ALL SELECT machine_id, 3, 'reduce_load', p_reduced, production_rate * (1.0::DOUBLE - 0.2::DOUBLE), production_rate, 0.0 FROM states""",
    ("states",),
)


def _scenario_sql(horizon: int) -> str:
    hours = horizon * 8.0
    return f"""
SELECT machine_id, o AS scenario_order, scenario, {horizon} AS horizon_shifts, round(p, 4) AS per_shift_failure_probability, round(risk, 4) AS cumulative_failure_risk, round(down, 2) AS expected_downtime_hours,
  round(units, 1) AS expected_production_units, round(CASE WHEN stop > 0 THEN rate * down ELSE full_rate * {hours}::DOUBLE - units END, 1) AS production_loss_units,
  round(units * 12.0::DOUBLE, 2) AS expected_revenue_usd, round(down * 150.0::DOUBLE, 2) AS downtime_cost_usd, round(risk * 2000.0::DOUBLE, 2) AS expected_failure_repair_cost_usd,
  round(units * 12.0::DOUBLE - down * 150.0::DOUBLE - risk * 2000.0::DOUBLE, 2) AS estimated_net_value_usd
FROM (SELECT *, rate * greatest(0.0::DOUBLE, {hours}::DOUBLE - down) AS units FROM (
  SELECT *, CASE WHEN stop > 0 THEN least(stop::DOUBLE, {hours}::DOUBLE) ELSE risk * 8.0::DOUBLE END AS down FROM (
    SELECT *, 1.0::DOUBLE - pow(1.0::DOUBLE - p, CASE WHEN stop > 0 THEN ({hours}::DOUBLE - least(stop::DOUBLE, {hours}::DOUBLE)) / 8.0::DOUBLE ELSE {horizon}::DOUBLE END) AS risk FROM cases)))"""


common("scenarios", _scenario_sql(6), ("cases",))
common(
    "recommended",
    "SELECT * FROM scenarios QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY estimated_net_value_usd DESC, scenario_order) = 1",
    ("scenarios",),
)
common(
    "decision_input",
    f"""
SELECT s.machine_id, s.signals, CASE WHEN s.n >= {MIN_EVENTS} THEN 'ok' ELSE 'unavailable' END AS pm_status, round(s.p_continue, 4) AS failure_probability,
  CASE WHEN s.n < {MIN_EVENTS} THEN NULL WHEN s.p_continue >= {THRESHOLD} THEN 'HIGH' WHEN s.p_continue < {THRESHOLD / 2} THEN 'LOW' ELSE 'MEDIUM' END AS risk_level,
  CASE WHEN f.cv_prediction IS NULL THEN 'unavailable' ELSE 'ok' END AS vision_status, f.cv_prediction = 'defect' AS defect, round(f.cv_confidence, 4) AS vision_confidence,
  CASE WHEN f.nlp_prediction IS NULL THEN 'unavailable' ELSE 'ok' END AS nlp_status, f.nlp_prediction AS incident_type, round(f.nlp_confidence, 4) AS note_confidence,
  CASE WHEN s.purchases > 12 THEN 'ok' END AS rag_status, s.purchases > 15 AS grounded, r.scenario AS recommended_scenario, r.horizon_shifts
FROM states s LEFT JOIN findings f USING (machine_id) LEFT JOIN recommended r USING (machine_id)""",
    ("states", "findings", "recommended"),
)
_URGENT = "coalesce(incident_type = 'Safety', false) OR coalesce(risk_level = 'HIGH', false)"
_DEFECT = "coalesce(defect, false)"
_MEDIUM = "coalesce(risk_level = 'MEDIUM', false)"
_GROUNDED = "coalesce(rag_status = 'ok' AND grounded, false)"
common(
    "decided",
    f"""
SELECT *, CASE WHEN {_URGENT} THEN 'URGENT' WHEN {_MEDIUM} OR {_DEFECT} THEN 'ELEVATED' ELSE 'ROUTINE' END AS priority,
  CASE WHEN ({_URGENT}) AND {_DEFECT} THEN {filled(wording.URGENT_DEFECT, "coalesce(risk_level, 'None')")} WHEN {_URGENT} THEN {q(wording.URGENT)}
       WHEN {_MEDIUM} AND {_DEFECT} THEN {q(wording.ELEVATED_BOTH)} WHEN {_DEFECT} THEN {q(wording.ELEVATED_DEFECT)} WHEN {_MEDIUM} THEN {q(wording.ELEVATED_RISK)}
       ELSE {q(wording.ROUTINE)} END || CASE WHEN {_GROUNDED} THEN {q(wording.SOP_SUFFIX)} ELSE '' END AS recommendation
FROM decision_input""",
    ("decision_input",),
)


def _findings(spark, sf_dir):
    events = inputs.events(spark, sf_dir).withColumn("machine_id", F.concat(F.lit("M-"), F.col("user_id").cast("string")))
    images = events.filter((F.col("event_type") == "view") & (F.col("user_id") % 4 != 1)).select(
        "machine_id", "ts", "event_id",
        F.when(F.col("k") > 93, "defect").otherwise("normal").alias("cv_prediction"),
        (F.col("k") / 100.0).alias("cv_confidence"),
        F.concat(F.lit("img_"), F.col("event_id").cast("string")).alias("image_path"),
    )
    notes = events.filter((F.col("event_type") == "signup") & (F.col("user_id") % 5 != 2)).select(
        "machine_id", "ts", "event_id",
        F.element_at(F.array(*[F.lit(v) for v in _KINDS]), (F.col("event_id") % 5 + 1).cast("int")).alias("nlp_prediction"),
        ((100 - F.col("k")) / 100.0).alias("nlp_confidence"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    return decide.latest_findings(images, notes, [F.col("ts"), F.col("event_id")], [F.col("ts"), F.col("event_id")])


def _states(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    share = F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))
    even = F.sum("k") % 2 == 0
    return (
        events.groupBy(F.concat(F.lit("M-"), F.col("user_id").cast("string")).alias("machine_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("k").alias("production_rate"),
            share.alias("p_continue"),
            F.when(even, F.array(F.lit("vibration_mm_s_mean"), F.lit("load_pct_mean")))
            .otherwise(F.array(F.lit("torque_nm_mean"), F.lit("quality_score")))
            .alias("important_signals"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
        .withColumns({"p_maintenance": F.col("p_continue") / 4, "p_reduced": F.col("p_continue") / 2})
    )


def _decision_input(spark, sf_dir):
    states = _states(spark, sf_dir)
    enough = states.filter(F.col("n") >= MIN_EVENTS).select("machine_id", F.col("p_continue").alias("prob"), "important_signals")
    predictions = score.risk(enough, THRESHOLD)
    rates = states.select("machine_id", "production_rate", "p_continue", "p_maintenance", "p_reduced")
    twin = whatif.recommend(whatif.scenario_table(rates)).select(
        "machine_id", "recommended_scenario", "recommendation_basis", "horizon_shifts", F.lit("ok").alias("twin_status")
    )
    evidence = states.select(
        "machine_id",
        F.when(F.col("purchases") > 12, "ok").alias("rag_status"),
        (F.col("purchases") > 15).alias("grounded"),
        F.array(F.lit("sop"), F.lit("manual"), F.lit("sop")).alias("evidence_documents"),
        F.reverse("important_signals").alias("top_features"),
        F.lit("permutation_importance").alias("tabular_method"),
    )
    machines = decide.with_findings(states.select("machine_id"), _findings(spark, sf_dir))
    return decide.combine(decide.with_predictions(machines, predictions, MIN_EVENTS), twin, evidence)


@query(
    "latest_findings",
    "SELECT machine_id, cv_prediction, cv_confidence, cv_source_image, nlp_prediction, nlp_confidence, nlp_source_timestamp FROM findings",
    ("findings",),
)
def latest_findings(spark, sf_dir):
    """Latest image and note result per machine, side by side."""
    return _findings(spark, sf_dir)


@query(
    "machine_context",
    """
SELECT machine_id, 'Machine ' || machine_id || ': ' || concat_ws(', ', 'vision inspection = ' || cv_prediction || ' (confidence ' || printf('%.2f', cv_confidence) || ')',
  'latest maintenance-note classification = ' || nlp_prediction || ' (confidence ' || printf('%.2f', nlp_confidence) || ')') AS context FROM findings""",
    ("findings",),
)
def machine_context(spark, sf_dir):
    found = _findings(spark, sf_dir)
    return found.select("machine_id", retrieve.machine_context(found).alias("context"))


@query(
    "finding_status",
    f"""
SELECT 'M-' || user_id AS machine_id, CASE WHEN cv_prediction IS NULL THEN 'unavailable' ELSE 'ok' END AS vision_status, CASE WHEN cv_prediction IS NULL THEN {filled(wording.UNAVAILABLE_VISION, "'M-' || user_id")} END AS vision_reason,
  CASE WHEN nlp_prediction IS NULL THEN 'unavailable' ELSE 'ok' END AS nlp_status, CASE WHEN nlp_prediction IS NULL THEN {filled(wording.UNAVAILABLE_NOTE, "'M-' || user_id")} END AS nlp_reason
FROM (SELECT DISTINCT user_id FROM ev) u LEFT JOIN findings f ON f.machine_id = 'M-' || u.user_id""",
    ("ev", "findings"),
)
def finding_status(spark, sf_dir):
    """Optional context per machine: ok, or unavailable with the reason."""
    machines = _states(spark, sf_dir).select("machine_id")
    joined = decide.with_findings(machines, _findings(spark, sf_dir))
    return joined.select("machine_id", "vision_status", "vision_reason", "nlp_status", "nlp_reason")


common(
    "questions",
    f"""
SELECT machine_id, CASE WHEN risk_level IN ('HIGH', 'MEDIUM') THEN {filled(wording.QUESTION_SIGNAL, "replace(signals[1], '_', ' ')")}
  WHEN {_DEFECT} THEN {q(wording.QUESTION_DEFECT)} ELSE {q(wording.QUESTION_ROUTINE)} END AS question FROM decision_input""",
    ("decision_input",),
)


@query("knowledge_question", "SELECT machine_id, question FROM questions", ("questions",))
def knowledge_question(spark, sf_dir):
    """The question each machine's findings raise."""
    return _decision_input(spark, sf_dir).select("machine_id", decide.knowledge_question().alias("question"))


@query(
    "compounded_risk",
    "SELECT model, id, round(1 - pow(1 - prob, greatest(0, id % 9 - 2)), 6) AS risk FROM scored",
    ("scored",),
)
def compounded_risk(spark, sf_dir):
    scored = inputs.scored(spark, sf_dir)
    return rounded(scored.select("model", "id", fn.compounded_risk("prob", (F.col("id") % 9 - 2).cast("double")).alias("risk")))


_STATE = ["machine_id", "production_rate", "p_continue", "p_maintenance", "p_reduced"]


@query("scenario_table", "SELECT * FROM scenarios", ("scenarios",))
def scenario_table(spark, sf_dir):
    """Continue, stop or reduce load for every machine over six shifts."""
    table = whatif.scenario_table(_states(spark, sf_dir).select(*_STATE))
    return table.drop(*[c for c in _STATE if c != "machine_id"])


@query("scenario_horizon", "SELECT * FROM (" + _scenario_sql(12) + ")", ("cases",))
def scenario_horizon(spark, sf_dir):
    """The same scenarios over twelve shifts."""
    table = whatif.scenario_table(_states(spark, sf_dir).select(*_STATE), Economics(), 12)
    return table.drop(*[c for c in _STATE if c != "machine_id"])


@query("best_scenario", "SELECT machine_id, scenario AS recommended_scenario, estimated_net_value_usd FROM recommended", ("recommended",))
def best_scenario(spark, sf_dir):
    table = whatif.scenario_table(_states(spark, sf_dir).select(*_STATE))
    return whatif.recommend(table).select("machine_id", "recommended_scenario", "estimated_net_value_usd")


@query("decision_rules", "SELECT machine_id, priority, recommendation FROM decided", ("decided",))
def decision_rules(spark, sf_dir):
    """Priority and recommendation of every machine from all its findings."""
    return decide.decide(_decision_input(spark, sf_dir)).select("machine_id", "priority", "recommendation")


_PCT = "printf('%.1f', {c} * 100) || '%'"


@query(
    "decision_reasoning",
    f"""
SELECT machine_id, concat_ws(' | ',
  CASE WHEN pm_status = 'ok' THEN {filled(wording.REASON_RISK, "'gru'", _PCT.format(c='failure_probability'), 'risk_level', "array_to_string(signals, ', ')")} ELSE {filled(wording.REASON_NO_RISK, filled(wording.UNAVAILABLE_WINDOW, str(MIN_EVENTS), 'machine_id'))} END,
  CASE WHEN vision_status <> 'ok' THEN {filled(wording.REASON_NO_VISION, filled(wording.UNAVAILABLE_VISION, 'machine_id'))} WHEN {_DEFECT} THEN {filled(wording.REASON_DEFECT, _PCT.format(c='vision_confidence'))} ELSE {filled(wording.REASON_NO_DEFECT, _PCT.format(c='vision_confidence'))} END,
  CASE WHEN nlp_status = 'ok' THEN {filled(wording.REASON_NOTE, 'incident_type', _PCT.format(c='note_confidence'))} ELSE {filled(wording.REASON_NO_NOTE, filled(wording.UNAVAILABLE_NOTE, 'machine_id'))} END,
  CASE WHEN {_GROUNDED} THEN {filled(wording.REASON_EVIDENCE, "'manual, sop'")} WHEN rag_status = 'ok' THEN {q(wording.REASON_THIN_EVIDENCE)} ELSE {filled(wording.REASON_NO_EVIDENCE, "'None'")} END,
  {filled(wording.REASON_FEATURES, "'permutation_importance'", "replace(signals[2] || ', ' || signals[1], '_', ' ')")},
  {filled(wording.REASON_SCENARIO, "6", "replace(recommended_scenario, '_', ' ')", q(wording.SCENARIO_BASIS))}) AS reasoning FROM decision_input""",
    ("decision_input",),
)
def decision_reasoning(spark, sf_dir):
    """The reasoning lines of every machine."""
    decided = decide.decide(_decision_input(spark, sf_dir))
    return decided.select("machine_id", F.array_join("reasoning", " | ").alias("reasoning"))


@query(
    "decision_trace",
    """
SELECT machine_id, unnest([1, 2, 3, 4, 5, 6, 7]) AS step,
  unnest(['vision_agent', 'predictive_maintenance_agent', 'nlp_info', 'xai_layer', 'digital_twin', 'knowledge_rag_agent', 'planning_decision_agent']) AS agent,
  unnest([vision_status, pm_status, nlp_status, CASE WHEN pm_status = 'ok' OR vision_status = 'ok' THEN 'ok' ELSE 'unavailable' END, 'ok', coalesce(rag_status, 'unavailable'), 'ok']) AS status,
  unnest([asked, asked, asked, asked, asked, 'question=''' || question || '''', 'vision+predictive_maintenance+nlp+rag results']) AS input_summary,
  unnest([
    CASE WHEN vision_status = 'ok' THEN asked || ', defect_detected=' || CASE WHEN defect THEN 'True' ELSE 'False' END || ', defect_type=None, severity=None' ELSE 'status=unavailable' END,
    CASE WHEN pm_status = 'ok' THEN asked || ', failure_probability=' || failure_probability || ', predicted_failure=' || CASE WHEN risk_level = 'HIGH' THEN 1 ELSE 0 END || ', risk_level=' || risk_level ELSE 'status=unavailable' END,
    CASE WHEN nlp_status = 'ok' THEN asked || ', incident_type=' || incident_type || ', confidence=' || note_confidence || ', source_timestamp=' || nlp_source_timestamp ELSE 'status=unavailable' END,
    'top_features=[' || CASE WHEN pm_status = 'ok' THEN '''' || signals[2] || ''', ''' || signals[1] || '''' ELSE '' END || '], vision_available=' || CASE WHEN vision_status = 'ok' THEN 'True' ELSE 'False' END,
    'recommended_scenario=' || recommended_scenario,
    CASE WHEN rag_status = 'ok' THEN 'question=' || question || ', answer=None, grounded=' || CASE WHEN grounded THEN 'True' ELSE 'False' END || ', used_live_llm=False' ELSE 'status=unavailable' END,
    'priority=' || priority || ', recommendation=' || substr(recommendation, 1, 80) || '...']) AS output_summary
FROM (SELECT *, 'machine_id=' || machine_id AS asked FROM decided JOIN questions USING (machine_id) LEFT JOIN (SELECT machine_id, nlp_source_timestamp FROM findings) USING (machine_id))""",
    ("decided", "questions", "findings"),
)
def decision_trace(spark, sf_dir):
    """The execution trace of every machine, step by step."""
    traced = decide.with_trace(decide.decide(_decision_input(spark, sf_dir)))
    return traced.select("machine_id", F.posexplode("trace").alias("p", "e")).select(
        "machine_id", (F.col("p") + 1).alias("step"), "e.agent", "e.status", "e.input_summary", "e.output_summary"
    )


# --- human review ---------------------------------------------------------

common(
    "human_decisions",
    """
SELECT 'M-' || user_id AS machine_id, event_id, ['approve', 'REJECT', 'Modify', 'MAYBE', 'APPROVE', NULL][k % 6 + 1] AS human_decision, CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'because ' || k END AS comment,
  CASE WHEN k % 2 = 0 THEN 'inspect line ' || k END AS modified_action, 'sup_' || (k % 4) AS supervisor FROM ev WHERE event_type = 'click'""",
    ("ev",),
)
_QUOTED = "coalesce('''' || human_decision || '''', 'None')"
common(
    "checked",
    f"""
SELECT h.*, d.recommendation, CASE WHEN coalesce(upper(human_decision), '') NOT IN ('APPROVE', 'REJECT', 'MODIFY') THEN {filled(wording.ERROR_DECISION, _QUOTED)}
  WHEN upper(human_decision) = 'REJECT' AND coalesce(comment, '') = '' THEN {q(wording.ERROR_REJECT)} WHEN upper(human_decision) = 'MODIFY' AND modified_action IS NULL THEN {q(wording.ERROR_ACTION)}
  WHEN upper(human_decision) = 'MODIFY' AND coalesce(comment, '') = '' THEN {q(wording.ERROR_MODIFY)} WHEN d.recommendation IS NULL THEN {q(wording.ERROR_EMPTY)} END AS error
FROM human_decisions h LEFT JOIN (SELECT machine_id, recommendation FROM decided WHERE pm_status = 'ok') d USING (machine_id)""",
    ("human_decisions", "decided"),
)


def _checked(spark, sf_dir):
    events = inputs.events(spark, sf_dir).filter(F.col("event_type") == "click")
    kinds = F.array(*[F.lit(v) for v in ("approve", "REJECT", "Modify", "MAYBE", "APPROVE", None)])
    k = F.col("k")
    decisions = events.select(
        F.concat(F.lit("M-"), F.col("user_id").cast("string")).alias("machine_id"),
        "event_id",
        F.element_at(kinds, (k % 6 + 1).cast("int")).alias("human_decision"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("because "), k.cast("string"))).alias("comment"),
        F.when(k % 2 == 0, F.concat(F.lit("inspect line "), k.cast("string"))).alias("modified_action"),
        F.concat(F.lit("sup_"), (k % 4).cast("string")).alias("supervisor"),
    )
    decided = decide.decide(_decision_input(spark, sf_dir)).filter(F.col("pm_status") == "ok")
    return decide.check_decisions(decisions, decided.select("machine_id", "recommendation", "priority", "reasoning"))


@query("decision_validation", "SELECT event_id, machine_id, human_decision, error FROM checked", ("checked",))
def decision_validation(spark, sf_dir):
    """Every human decision with the first rule it breaks, if any."""
    return _checked(spark, sf_dir).select("event_id", "machine_id", "human_decision", "error")


@query(
    "rejected_decisions",
    "SELECT error, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY error",
    ("checked",),
)
def rejected_decisions(spark, sf_dir):
    return decide.rejected_decisions(_checked(spark, sf_dir)).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


_FINAL = "CASE upper(human_decision) WHEN 'MODIFY' THEN modified_action WHEN 'APPROVE' THEN recommendation END"


@query(
    "audit_records",
    f"""
SELECT machine_id, upper(human_decision) AS human_decision, comment AS human_comment, supervisor, CASE WHEN upper(human_decision) = 'MODIFY' THEN modified_action END AS modified_action,
  {_FINAL} AS final_action, recommendation AS original FROM checked WHERE error IS NULL""",
    ("checked",),
)
def audit_records(spark, sf_dir):
    """The audit record of every valid decision, without its random id and time."""
    records = decide.audit_records(_checked(spark, sf_dir))
    return records.select(
        "original_ai_recommendation.machine_id", "human_decision", "human_comment", "supervisor", "modified_action", "final_action",
        F.col("original_ai_recommendation.recommendation").alias("original"),
    )


@query(
    "audit_for_machine",
    f"SELECT machine_id, upper(human_decision) AS human_decision, {_FINAL} AS final_action FROM checked WHERE error IS NULL AND machine_id = 'M-8'",
    ("checked",),
)
def audit_for_machine(spark, sf_dir):
    """The audit records of one machine, found in the nested recommendation."""
    records = sinks.audit_for_machine(decide.audit_records(_checked(spark, sf_dir)), "M-8")
    return records.select("original_ai_recommendation.machine_id", "human_decision", "final_action")
