"""Result texts. These strings are part of the results and must not vary."""

NO_EVIDENCE = (
    "The factory knowledge base does not contain sufficient information to "
    "answer this question. No retrieved document met the similarity "
    "threshold for this query."
)
WITHOUT_EVIDENCE = (
    "In general, if a machine shows a concerning sensor reading, "
    "standard practice is to reduce load, monitor the situation, and "
    "consult the manufacturer's documentation or a qualified "
    "technician before deciding whether to continue operating the "
    "equipment. (This answer is generated without access to this "
    "factory's specific manuals or SOPs, so it cannot state exact "
    "thresholds, required response steps, or which document to follow.)"
)

QUESTION_SIGNAL = "What should the operator do if %s becomes abnormal or dangerously high?"
QUESTION_DEFECT = "What is the recommended procedure when a product defect is detected during inspection?"
QUESTION_ROUTINE = "What is the standard preventive maintenance procedure for this machine?"

SUMMARY_RISK = "Predicted risk: %s (failure probability %s)."
SUMMARY_NO_RISK = "No predictive-maintenance explanation is available for this machine."
SUMMARY_NONE = "No explanation could be generated - see the individual component statuses for reasons."
SUMMARY_UP = "The prediction is pushed toward failure mainly by: %s."
SUMMARY_DOWN = "Pushing toward normal operation: %s."
SUMMARY_DEFECT = (
    "The vision inspection also flagged a defect (confidence %s); "
    "see the Grad-CAM overlay for the image region that drove this."
)
SUMMARY_NO_DEFECT = "The vision inspection found no defect (confidence %s)."

URGENT_DEFECT = (
    "Stop the machine for immediate inspection. Both the predictive model's "
    "%s risk estimate and a vision-confirmed "
    "defect point to the same machine; correlate the sensor anomaly with the "
    "visual finding before restarting."
)
URGENT = (
    "Schedule preventive maintenance before the next shift begins; do not wait "
    "for a further sensor escalation."
)
ELEVATED_BOTH = (
    "Increase inspection frequency this shift and flag the current production "
    "batch for quality review; the predictive model shows elevated (not yet high) risk."
)
ELEVATED_DEFECT = "Flag the current production batch for quality review and inspect tooling."
ELEVATED_RISK = "Increase monitoring frequency for this machine over the next shift."
ROUTINE = "Continue normal operation; monitor on the standard schedule."
SOP_SUFFIX = " Follow the retrieved SOP guidance for the specific steps and thresholds."

REASON_RISK = (
    "Predictive maintenance model (%s) estimates a %s failure probability for the next shift "
    "(risk level: %s), driven most by: %s."
)
REASON_NO_RISK = "Predictive maintenance result unavailable: %s."
REASON_DEFECT = (
    "Vision inspection flagged a defect (confidence %s); "
    "defect type/severity were not classified by the Stage III model."
)
REASON_NO_DEFECT = "Vision inspection found no defect (confidence %s)."
REASON_NO_VISION = "Vision result unavailable: %s."
REASON_NOTE = "Most recent maintenance note classified as '%s' (confidence %s)."
REASON_NO_NOTE = "NLP result unavailable: %s."
REASON_EVIDENCE = "Relevant SOP evidence retrieved from: %s."
REASON_THIN_EVIDENCE = "Knowledge base returned no sufficiently relevant evidence for the formulated question."
REASON_NO_EVIDENCE = "Knowledge/RAG result unavailable: %s."
REASON_FEATURES = "Explainability analysis (%s) attributes this prediction most to: %s."
REASON_SCENARIO = "Digital twin what-if simulation over the next %d shifts favors '%s' (%s)."
SCENARIO_BASIS = "highest estimated_net_value_usd across the 3 simulated scenarios"

DECISIONS = ["APPROVE", "REJECT", "MODIFY"]
ERROR_DECISION = "human_decision must be one of ['APPROVE', 'MODIFY', 'REJECT'], got %s"
ERROR_REJECT = "REJECT requires a reason/comment"
ERROR_ACTION = "MODIFY requires a modified_action"
ERROR_MODIFY = "MODIFY requires a reason/comment"
ERROR_EMPTY = "ai_output has no decision.recommendation - is this a real orchestrator result?"

# --- own wording, free to change ---

UNAVAILABLE_WINDOW = "Fewer than %d recorded shifts available for machine %s"
UNAVAILABLE_VISION = "No vision result found for machine %s"
UNAVAILABLE_NOTE = "No maintenance-note result found for machine %s"
