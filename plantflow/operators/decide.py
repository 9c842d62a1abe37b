"""Decisions for all machines in one job: findings side by side, rules, reasoning, trace and review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plantflow import wording
from plantflow.functions import columns as fn
from plantflow.operators.score import latest_record


def latest_findings(images: DataFrame, notes: DataFrame, image_order: Sequence[Column], note_order: Sequence[Column]) -> DataFrame:
    """Latest image result and latest note result per machine; a side that is absent is NULL.

    `images(machine_id, cv_prediction, cv_confidence, image_path)`,
    `notes(machine_id, nlp_prediction, nlp_confidence, timestamp)`.
    """
    seen = latest_record(images, "machine_id", *image_order).select(
        "machine_id", "cv_prediction", "cv_confidence", F.col("image_path").alias("cv_source_image")
    )
    read = latest_record(notes, "machine_id", *note_order).select(
        "machine_id", "nlp_prediction", "nlp_confidence", F.col("timestamp").alias("nlp_source_timestamp")
    )
    return seen.join(read, "machine_id", "full_outer")


def _status(present: Column, template: str) -> tuple[Column, Column]:
    reason = F.when(~present, F.format_string(template, F.col("machine_id")))
    return F.when(present, "ok").otherwise("unavailable"), reason


def with_findings(machines: DataFrame, findings: DataFrame) -> DataFrame:
    """Attach the vision and note results of each machine, or the reason why there are none."""
    joined = machines.join(findings, "machine_id", "left")
    vision, vision_reason = _status(F.col("cv_prediction").isNotNull(), wording.UNAVAILABLE_VISION)
    note, note_reason = _status(F.col("nlp_prediction").isNotNull(), wording.UNAVAILABLE_NOTE)
    return joined.withColumns(
        {
            "vision_status": vision,
            "vision_reason": vision_reason,
            "vision_class": F.col("cv_prediction"),
            "defect_detected": F.col("cv_prediction") == "defect",
            "vision_confidence": F.round("cv_confidence", 4),
            "nlp_status": note,
            "nlp_reason": note_reason,
            "incident_type": F.col("nlp_prediction"),
            "note_confidence": F.round("nlp_confidence", 4),
        }
    )


def with_predictions(machines: DataFrame, predictions: DataFrame, window: int, model: str = "gru") -> DataFrame:
    """Attach `prob, predicted_failure, risk_level, important_signals`, or the reason why there are none."""
    joined = machines.join(predictions, "machine_id", "left")
    present = F.col("prob").isNotNull()
    return joined.withColumns(
        {
            "pm_status": F.when(present, "ok").otherwise("unavailable"),
            "pm_reason": F.when(~present, F.format_string(wording.UNAVAILABLE_WINDOW, F.lit(window), F.col("machine_id"))),
            "failure_probability": F.round("prob", 4),
            "model_name": F.lit(model),
        }
    ).drop("prob")


def knowledge_question() -> Column:
    """The question the findings raise: risk first, then a defect, else routine maintenance."""
    at_risk = (F.col("pm_status") == "ok") & F.col("risk_level").isin("HIGH", "MEDIUM")
    signal = F.coalesce(fn.readable(F.get(F.col("important_signals"), F.lit(0))), F.lit("sensor readings"))
    defect = (F.col("vision_status") == "ok") & F.col("defect_detected")
    return (
        F.when(at_risk, F.format_string(wording.QUESTION_SIGNAL, signal))
        .when(defect, F.lit(wording.QUESTION_DEFECT))
        .otherwise(F.lit(wording.QUESTION_ROUTINE))
    )


def _known(status: str, value: str) -> Column:
    return F.when(F.col(status) == "ok", F.col(value))


def priority() -> Column:
    """URGENT for a safety incident or high risk, ELEVATED for medium risk or a defect, else ROUTINE."""
    level, defect, incident = _known("pm_status", "risk_level"), _known("vision_status", "defect_detected"), _known("nlp_status", "incident_type")
    return (
        F.when((incident == "Safety") | (level == "HIGH"), "URGENT")
        .when((level == "MEDIUM") | defect, "ELEVATED")
        .otherwise("ROUTINE")
    )


def recommendation() -> Column:
    level, defect, incident = _known("pm_status", "risk_level"), _known("vision_status", "defect_detected"), _known("nlp_status", "incident_type")
    urgent = (incident == "Safety") | (level == "HIGH")
    rule = (
        F.when(urgent & defect, F.format_string(wording.URGENT_DEFECT, F.coalesce(level, F.lit("None"))))
        .when(urgent, F.lit(wording.URGENT))
        .when((level == "MEDIUM") & defect, F.lit(wording.ELEVATED_BOTH))
        .when(defect, F.lit(wording.ELEVATED_DEFECT))
        .when(level == "MEDIUM", F.lit(wording.ELEVATED_RISK))
        .otherwise(F.lit(wording.ROUTINE))
    )
    grounded = (F.col("rag_status") == "ok") & F.col("grounded")
    return F.concat(rule, F.when(grounded, F.lit(wording.SOP_SUFFIX)).otherwise(F.lit("")))


def reasoning() -> Column:
    """The ordered lines that state what each part contributed; missing parts say so or are left out."""

    def missing(template: str, part: str) -> Column:
        return F.format_string(template, F.coalesce(F.col(f"{part}_reason"), F.col(f"{part}_status"), F.lit("None")))

    def ok(part: str) -> Column:
        return F.col(f"{part}_status") == "ok"

    features = F.transform(F.slice("top_features", 1, 3), fn.readable)
    lines = [
        F.when(
            ok("pm"),
            F.format_string(
                wording.REASON_RISK, F.col("model_name"), fn.percent("failure_probability"), F.col("risk_level"), F.array_join("important_signals", ", ")
            ),
        ).otherwise(missing(wording.REASON_NO_RISK, "pm")),
        F.when(ok("vision") & F.col("defect_detected"), F.format_string(wording.REASON_DEFECT, fn.percent("vision_confidence")))
        .when(ok("vision"), F.format_string(wording.REASON_NO_DEFECT, fn.percent("vision_confidence")))
        .otherwise(missing(wording.REASON_NO_VISION, "vision")),
        F.when(ok("nlp"), F.format_string(wording.REASON_NOTE, F.col("incident_type"), fn.percent("note_confidence"))).otherwise(
            missing(wording.REASON_NO_NOTE, "nlp")
        ),
        F.when(ok("rag") & F.col("grounded"), F.format_string(wording.REASON_EVIDENCE, F.array_join(F.array_sort(F.array_distinct("evidence_documents")), ", ")))
        .when(ok("rag"), F.lit(wording.REASON_THIN_EVIDENCE))
        .otherwise(missing(wording.REASON_NO_EVIDENCE, "rag")),
        F.when(
            F.size("top_features") > 0,
            F.format_string(wording.REASON_FEATURES, F.coalesce(F.col("tabular_method"), F.lit("the XAI layer")), F.array_join(features, ", ")),
        ),
        F.when(
            ok("twin"),
            F.format_string(
                wording.REASON_SCENARIO, F.col("horizon_shifts"), fn.readable("recommended_scenario"), F.col("recommendation_basis")
            ),
        ),
    ]
    return F.array_compact(F.array(*lines))


# Columns the rules read; a part that was not run is added as NULL and counts as unavailable.
FINDING_COLUMNS = {
    "pm_status": "string", "pm_reason": "string", "failure_probability": "double", "predicted_failure": "int",
    "risk_level": "string", "important_signals": "array<string>", "model_name": "string",
    "vision_status": "string", "vision_reason": "string", "defect_detected": "boolean", "vision_class": "string", "vision_confidence": "double",
    "nlp_status": "string", "nlp_reason": "string", "incident_type": "string", "note_confidence": "double",
    "rag_status": "string", "rag_reason": "string", "grounded": "boolean", "evidence_documents": "array<string>",
    "top_features": "array<string>", "tabular_method": "string",
    "twin_status": "string", "twin_reason": "string", "horizon_shifts": "int", "recommended_scenario": "string", "recommendation_basis": "string",
}


def complete(findings: DataFrame) -> DataFrame:
    """Add the finding columns that are absent as NULL."""
    absent = {c: F.lit(None).cast(t) for c, t in FINDING_COLUMNS.items() if c not in findings.columns}
    return findings.withColumns(absent)


def decide(findings: DataFrame) -> DataFrame:
    """Add priority, recommendation and reasoning to every machine's findings."""
    return complete(findings).withColumns(
        {"priority": priority(), "recommendation": recommendation(), "reasoning": reasoning()}
    )


def combine(machines: DataFrame, *parts: DataFrame, key: str = "machine_id") -> DataFrame:
    """Fan-in: every machine with whatever each part found for it (all one row per machine)."""
    for part in parts:
        machines = machines.join(part, key, "left")
    return machines


def _shown(name: str, kind: str) -> Column:
    """A value as the trace writes it."""
    value = F.col(name)
    if kind == "boolean":
        text = F.when(value, "True").when(~value, "False")
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("None"))


def _name_list(names: Column) -> Column:
    quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
    return F.concat(F.lit("["), F.coalesce(F.array_join(quoted, ", "), F.lit("")), F.lit("]"))


def _summary(part: str, fields: Sequence[tuple[str, str]]) -> Column:
    """The first fields of a part's record, under their names there; its status if it has none."""
    named = [F.concat(F.lit(f"{shown}="), _shown(f, TRACE_COLUMNS[f])) for shown, f in fields]
    status = F.col(f"{part}_status")
    return F.when(status == "ok", F.concat_ws(", ", *named)).otherwise(
        F.concat(F.lit("status="), F.coalesce(status, F.lit("unavailable")))
    )


# Fields the trace shows beside the findings; a classifier of two classes knows no defect type or severity.
TRACE_COLUMNS = FINDING_COLUMNS | {
    "machine_id": "string", "defect_type": "string", "severity": "string", "nlp_source_timestamp": "string",
    "question": "string", "answer": "string", "used_live_llm": "boolean",
}


def with_trace(decided: DataFrame) -> DataFrame:
    """Add the execution trace: one entry per part with status, input, output and the reason."""
    decided = complete(decided)
    added = {c: F.lit(None).cast(t) for c, t in TRACE_COLUMNS.items() if c not in decided.columns}
    added |= {"used_live_llm": F.lit(False)} if "used_live_llm" in added else {}
    added |= {"question": knowledge_question()} if "question" in added else {}
    rows = decided.withColumns(added)
    machine = F.concat(F.lit("machine_id="), F.col("machine_id"))
    question = F.concat(F.lit("question='"), F.col("question"), F.lit("'"))
    seen = F.coalesce(F.col("vision_status") == "ok", F.lit(False))
    explained = F.coalesce(F.size("top_features") > 0, F.lit(False)) & F.coalesce(F.col("pm_status") == "ok", F.lit(False))
    features = F.when(explained, F.col("top_features"))
    state = {p: F.coalesce(F.col(f"{p}_status"), F.lit("unavailable")) for p in ("vision", "pm", "nlp", "twin", "rag")}
    steps = [
        ("vision_agent", state["vision"], machine, _summary("vision", [(f, f) for f in ("machine_id", "defect_detected", "defect_type", "severity")]), "vision_reason"),
        ("predictive_maintenance_agent", state["pm"], machine, _summary("pm", [(f, f) for f in ("machine_id", "failure_probability", "predicted_failure", "risk_level")]), "pm_reason"),
        ("nlp_info", state["nlp"], machine, _summary("nlp", [("machine_id", "machine_id"), ("incident_type", "incident_type"), ("confidence", "note_confidence"), ("source_timestamp", "nlp_source_timestamp")]), "nlp_reason"),
        ("xai_layer", F.when(explained | seen, "ok").otherwise("unavailable"), machine, F.concat(F.lit("top_features="), _name_list(features), F.lit(", vision_available="), F.when(seen, "True").otherwise("False")), None),
        ("digital_twin", state["twin"], machine, F.concat(F.lit("recommended_scenario="), _shown("recommended_scenario", "string")), "twin_reason"),
        ("knowledge_rag_agent", state["rag"], question, _summary("rag", [(f, f) for f in ("question", "answer", "grounded", "used_live_llm")]), "rag_reason"),
        ("planning_decision_agent", F.lit("ok"), F.lit("vision+predictive_maintenance+nlp+rag results"), F.concat(F.lit("priority="), F.col("priority"), F.lit(", recommendation="), F.substring("recommendation", 1, 80), F.lit("...")), None),
    ]
    entries = [
        F.struct(
            F.lit(agent).alias("agent"),
            status.alias("status"),
            asked.alias("input_summary"),
            said.alias("output_summary"),
            (F.col(reason) if reason else F.lit(None).cast("string")).alias("error"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        )
        for agent, status, asked, said, reason in steps
    ]
    return rows.withColumn("trace", F.array(*entries)).drop(*[c for c in added if c not in FINDING_COLUMNS])


# --- human review ---------------------------------------------------------


def _quoted(name: str) -> Column:
    """A string as it is shown in a message; nothing shows as None."""
    return F.coalesce(F.concat(F.lit("'"), F.col(name), F.lit("'")), F.lit("None"))


def check_decisions(decisions: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Join human decisions to their recommendation and name the first broken rule in `error`.

    `decisions(machine_id, human_decision, comment, modified_action, supervisor)`.
    """
    said = F.upper(F.coalesce("human_decision", F.lit("")))

    def blank(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) == ""

    error = (
        F.when(~said.isin(wording.DECISIONS), F.format_string(wording.ERROR_DECISION, _quoted("human_decision")))
        .when((said == "REJECT") & blank("comment"), wording.ERROR_REJECT)
        .when((said == "MODIFY") & blank("modified_action"), wording.ERROR_ACTION)
        .when((said == "MODIFY") & blank("comment"), wording.ERROR_MODIFY)
        .when(F.col("recommendation").isNull(), wording.ERROR_EMPTY)
    )
    return decisions.join(recommendations, "machine_id", "left").withColumn("error", error)


def audit_records(checked: DataFrame, evidence: Sequence[str] = ()) -> DataFrame:
    """Audit records of the valid decisions; the original recommendation is kept as it was."""
    said = F.upper("human_decision")
    original = F.struct(
        *[
            (F.col(c) if c in checked.columns else F.lit(None).cast("string")).alias(c)
            for c in ("machine_id", "generated_at", "recommendation", "priority")
        ],
        (F.col("reasoning") if "reasoning" in checked.columns else F.array().cast("array<string>")).alias("reasoning"),
        F.lit(None).cast("string").alias("narrative"),
    )
    support = F.struct(*[F.col(c) for c in evidence]) if evidence else F.struct(F.lit(None).cast("string").alias("none"))
    return checked.filter(F.col("error").isNull()).select(
        F.replace(F.uuid(), F.lit("-"), F.lit("")).alias("decision_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        original.alias("original_ai_recommendation"),
        support.alias("ai_evidence"),
        said.alias("human_decision"),
        F.when(said == "MODIFY", F.col("modified_action")).alias("modified_action"),
        F.col("comment").alias("human_comment"),
        "supervisor",
        F.when(said == "MODIFY", F.col("modified_action")).when(said == "APPROVE", F.col("recommendation")).alias("final_action"),
    )


def rejected_decisions(checked: DataFrame) -> DataFrame:
    """Decisions that were not recorded, with the reason."""
    return checked.filter(F.col("error").isNotNull())
