"""Queries: windows, attribution and what-if at many anchors, full scenario records, record and page files."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow import wording
from plantflow.config import Economics
from plantflow.functions import columns as fn
from plantflow.operators import explain, score, whatif
from plantflow.plans import catalog_decisions as decisions, catalog_windows as windows, inputs as tables, jobs
from plantflow.plans.registry import common, query, rounded
from plantflow.session import new_folder
from plantflow.sources import readers, sinks, star_inputs as inputs

SIGNALS = windows.SIGNALS

# Hundreds of anchors: an afternoon now and then of every machine.
_CHOSEN = "(sim_day * 7 + CAST(substr(machine_id, 3) AS INT)) % 11 = 0 AND shift = 'Afternoon'"

common(
    "anchored",
    f"""
SELECT a.machine_id || '|' || a.sim_day || '|' || a.shift AS anchor, r.*, 5 - (a.pos - r.pos) AS position FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY sim_day, {windows.ORDER}) AS pos FROM split_features) WHERE {_CHOSEN} AND pos >= 5) a
JOIN (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY sim_day, {windows.ORDER}) AS pos FROM split_features) r
  ON r.machine_id = a.machine_id AND r.pos BETWEEN a.pos - 4 AND a.pos""",
    ("split_features",),
)
common(
    "anchored_z",
    "SELECT l.anchor, l.position, st.i, st.name, st.w, coalesce(l.v, st.med) AS actual, (coalesce(l.v, st.med) - st.m) / st.s AS z FROM ("
    + " UNION ALL ".join(f"SELECT anchor, position, {i} AS i, {c} AS v FROM anchored" for i, c in enumerate(SIGNALS))
    + ") l JOIN signal_stats st USING (i)",
    ("anchored", "signal_stats"),
)
common(
    "anchored_parts",
    f"""
SELECT *, sum(part) OVER (PARTITION BY anchor) + ({windows.INTERCEPT}) AS total FROM (
  SELECT anchor, name, i, w, w * avg(z) AS part, max(actual) FILTER (position = 5) AS value, max(z) FILTER (position = 5) AS last_z FROM anchored_z GROUP BY anchor, name, i, w)""",
    ("anchored_z",),
)
common(
    "anchored_chances",
    f"""
SELECT anchor, 1 / (1 + exp(-any_value(total))) AS p_continue, max(value) FILTER (name = 'production_rate') AS production_rate,
  1 / (1 + exp(-({windows.INTERCEPT} + sum(w * (CASE name {" ".join(f"WHEN '{c}' THEN " + ("0.0" if c == "downtime_minutes" else f"(SELECT avg({c}) FROM split_features WHERE split = 'train' AND operating_status = 'RUNNING')") for c in SIGNALS)} END - m) / s)))) AS p_maintenance,
  1 / (1 + exp(-({windows.INTERCEPT} + sum(w * (CASE WHEN name = 'production_rate' THEN value * (1.0::DOUBLE - 0.2::DOUBLE) ELSE value END - m) / s)))) AS p_reduced
FROM anchored_parts JOIN (SELECT name, m, s FROM signal_stats) USING (name) GROUP BY anchor""",
    ("anchored_parts", "signal_stats"),
)
common(
    "anchored_cases",
    """
SELECT anchor AS machine_id, 1 AS o, 'continue_operating' AS scenario, p_continue AS p, production_rate AS rate, production_rate AS full_rate, 0.0 AS stop, p_continue, production_rate FROM anchored_chances
UNION ALL SELECT anchor, 2, 'stop_for_maintenance', p_maintenance, production_rate, production_rate, 4.5, p_continue, production_rate FROM anchored_chances
UNION ALL SELECT anchor, 3, 'reduce_load', p_reduced, production_rate * (1.0::DOUBLE - 0.2::DOUBLE), production_rate, 0.0, p_continue, production_rate FROM anchored_chances""",
    ("anchored_chances",),
)


def _features(spark, sf_dir):
    return tables.feature_table(spark, sf_dir)


def _anchors(features):
    number = F.substring("machine_id", 3, 20).cast("int")
    chosen = features.filter(((F.col("sim_day") * 7 + number) % 11 == 0) & (F.col("shift") == "Afternoon"))
    return chosen.select("machine_id", "sim_day", "shift")


def _scorer():
    return score.linear_scorer(windows.COEFFICIENTS, windows.INTERCEPT)


@query(
    "anchored_windows",
    "SELECT anchor, position, sim_day, shift, split, round(production_rate, 6) AS production_rate FROM anchored",
    ("anchored",),
)
def anchored_windows(spark, sf_dir):
    """The five shifts up to each of many (machine, day, shift), across splits."""
    features = _features(spark, sf_dir)
    rows = score.anchored_rows(features, _anchors(features))
    return rounded(rows.select("anchor", "position", "sim_day", "shift", "split", "production_rate"))


@query(
    "anchored_attributions",
    f"""
SELECT anchor, round(1 / (1 + exp(-total)), 6) AS prob, CASE WHEN 1 / (1 + exp(-total)) >= 0.4 THEN 'HIGH' WHEN 1 / (1 + exp(-total)) < 0.2 THEN 'LOW' ELSE 'MEDIUM' END AS risk_level,
  row_number() OVER (PARTITION BY anchor ORDER BY abs(1 / (1 + exp(-total)) - 1 / (1 + exp(-(total - part)))) DESC, i) AS rank,
  name AS feature, round(value, 6) AS value, round(1 / (1 + exp(-total)) - 1 / (1 + exp(-(total - part))), 6) AS contribution
FROM anchored_parts""",
    ("anchored_parts",),
)
def anchored_attributions(spark, sf_dir):
    """Score and strongest features of the window at each anchor."""
    features = _features(spark, sf_dir)
    found = jobs.explain_at(features, _anchors(features), _scorer(), SIGNALS, threshold=0.4)
    listed = found.select("anchor", "prob", "risk_level", F.inline("feature_explanations"))
    return rounded(listed.select("anchor", "prob", "risk_level", "rank", "feature", "value", "contribution"))


_SOURCES, _TEXTS = whatif.PROBABILITY_SOURCES, whatif.DESCRIPTIONS


def _said(texts: dict[str, str]) -> str:
    """The texts of the three scenarios, chosen in SQL; 4.5 hours and 20 % are the settings."""
    filled = {n: t.replace("%s", "4.5" if n == "stop_for_maintenance" else "20%") for n, t in texts.items()}
    return "CASE scenario " + " ".join(f"WHEN '{n}' THEN {decisions.q(t)}" for n, t in filled.items()) + " END"


def _record_sql(source: str, horizon: int) -> str:
    return f"""
SELECT s.machine_id AS id, s.scenario_order, s.scenario, {_said(_TEXTS)} AS description, {_said(_SOURCES)} AS failure_probability_source, {horizon * 8.0}::DOUBLE AS horizon_hours,
  round(c.production_rate, 2) AS current_production_rate, round(c.p_continue, 4) AS current_failure_probability, s.per_shift_failure_probability, s.estimated_net_value_usd,
  first_value(s.scenario) OVER (PARTITION BY s.machine_id ORDER BY s.estimated_net_value_usd DESC, s.scenario_order) AS recommended_scenario
FROM ({decisions._scenario_sql(horizon).replace("FROM cases", "FROM " + source)}) s JOIN (SELECT machine_id, any_value(p_continue) AS p_continue, any_value(production_rate) AS production_rate FROM {source} GROUP BY machine_id) c ON c.machine_id = s.machine_id"""


def _spelt(records, key):
    whole = ["horizon_hours", "current_production_rate", "current_failure_probability", "recommended_scenario"]
    wanted = ["scenario_order", "scenario", "description", "failure_probability_source", "per_shift_failure_probability", "estimated_net_value_usd"]
    return records.select(F.col(key).alias("id"), *whole, F.inline("scenarios")).select("id", *whole, *wanted)


@query("anchored_scenarios", _record_sql("anchored_cases", 6), ("anchored_cases",))
def anchored_scenarios(spark, sf_dir):
    """What-if records of the states at each anchor; the risks of changed states come from scoring them."""
    features = _features(spark, sf_dir)
    return _spelt(jobs.simulate_at(features, _anchors(features), _scorer(), SIGNALS, Economics()), "anchor")


common("state_cases", "SELECT c.*, s.p_continue, s.production_rate FROM cases c JOIN states s USING (machine_id)", ("cases", "states"))


@query("scenario_record", _record_sql("state_cases", 12), ("state_cases",))
def scenario_record(spark, sf_dir):
    """The full record of every machine over twelve shifts."""
    states = decisions._states(spark, sf_dir).select(*decisions._STATE).withColumn("machine_type", F.lit(None).cast("string"))
    return _spelt(whatif.scenario_records(states, Economics(), 12), "machine_id")


# --- explanations ---------------------------------------------------------


_RISK_LEVEL = f"CASE WHEN p_continue >= {decisions.THRESHOLD} THEN 'HIGH' WHEN p_continue < {decisions.THRESHOLD / 2} THEN 'LOW' ELSE 'MEDIUM' END"


def _percent(x: str) -> str:
    return f"printf('%.1f', {x} * 100) || '%'"


@query(
    "explanation_branches",
    f"""
SELECT machine_id, coalesce(nullif(concat_ws(' ',
  CASE WHEN n >= {decisions.MIN_EVENTS} THEN {decisions.filled(wording.SUMMARY_RISK, _RISK_LEVEL, _percent("round(p_continue, 4)"))} WHEN n % 2 = 0 THEN {decisions.q(wording.SUMMARY_NO_RISK)} END,
  CASE WHEN cv_prediction = 'defect' THEN {decisions.filled(wording.SUMMARY_DEFECT, _percent("cv_confidence"))}
       WHEN cv_prediction IS NOT NULL THEN {decisions.filled(wording.SUMMARY_NO_DEFECT, _percent("cv_confidence"))} END), ''), {decisions.q(wording.SUMMARY_NONE)}) AS summary
FROM states LEFT JOIN findings USING (machine_id)""",
    ("states", "findings"),
)
def explanation_branches(spark, sf_dir):
    """Summaries with a defect, without one, without a picture, without a score, and with nothing at all."""
    found = decisions.latest_findings(spark, sf_dir).select("machine_id", "cv_prediction", "cv_confidence")
    states = decisions._states(spark, sf_dir).select("machine_id", "n", "p_continue").join(found, "machine_id", "left")
    scored = F.col("n") >= decisions.MIN_EVENTS
    level = F.when(scored, fn.risk_level("p_continue", decisions.THRESHOLD))
    chance = F.when(scored, F.round("p_continue", 4)).when(F.col("n") % 2 == 1, F.lit(0.0))  # a score of no known level
    nothing = F.lit(None).cast("array<struct<rank:int,feature:string,value:double,contribution:double,direction:string>>")
    text = explain.human_summary(level, chance, nothing, F.col("cv_prediction"), F.col("cv_confidence"))
    return states.select("machine_id", text.alias("summary"))


# --- files ----------------------------------------------------------------


@query(
    "json_array_records",
    """
SELECT c_custkey AS id, c_mktsegment AS segment, 'say "}{" \\ ' || c_custkey || chr(10) || '[{' AS note, round(c_acctbal::DOUBLE, 2) AS balance FROM customer""",
)
def json_array_records(spark, sf_dir):
    """Customers written as JSON arrays with quotes, braces and line breaks in their texts, and read back by ranges."""
    note = F.concat(F.lit('say "}{" \\ '), F.col("c_custkey").cast("string"), F.lit("\n[{"))
    customers = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        note.alias("note"),
        F.struct(F.col("c_acctbal").cast("double").alias("balance")).alias("money"),
    )
    folder = new_folder(spark, "arrays")
    part = F.floor(F.col("id") / 500)  # an array holds 500 records
    customers.groupBy(part).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).select("value").write.text(folder)
    found = readers.read_records(spark, folder, "id long, segment string, note string, money struct<balance: double>")
    return rounded(found.select("id", "segment", "note", F.col("money.balance").alias("balance")), 2)


@query(
    "csv_production",
    "SELECT machine_id, count(*) AS n, CAST(sum(production_count) AS BIGINT) AS units, round(avg(quality_score), 6) AS quality, count(quality_score) AS scores FROM production_raw GROUP BY machine_id",
    ("production_raw",),
)
def csv_production(spark, sf_dir):
    """The raw production table written as CSV and read back through its loader."""
    folder = new_folder(spark, "raw")
    sinks.write_table(inputs.production_raw(spark, sf_dir), f"{folder}/raw_production_data.csv", format="csv")
    raw = readers.read_raw_production(spark, folder)
    return rounded(
        raw.groupBy("machine_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("production_count").alias("units"),
            F.avg("quality_score").alias("quality"),
            F.count("quality_score").alias("scores"),
        )
    )


@query(
    "page_files",
    r"SELECT page, md5(text) AS digest FROM (SELECT text, row_number() OVER (PARTITION BY source, doc_id // 50 ORDER BY doc_id) AS page FROM documents) WHERE regexp_matches(text, '[^\s\x0b\x1c-\x1f\x{85}\p{Z}]')",
)
def page_files(spark, sf_dir):
    """Documents written as files of up to 50 pages with form feeds between, and read back page by page."""
    folder = new_folder(spark, "pages")
    documents = inputs.table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    pages = F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "text"))), lambda p: p["text"])
    files = documents.groupBy("source", F.floor(F.col("doc_id") / 50).alias("part")).agg(F.array_join(pages, "\f").alias("value"))
    sinks.write_text_files(files.select("value"), folder, "\f", folders=True)
    return readers.read_page_files(spark, folder, ["page", F.md5(F.col("text").cast("binary")).alias("digest")])
