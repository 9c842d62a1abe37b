"""Queries: latest windows, sequences, latest records, signals, attribution."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from plantflow.config import SEQUENCE_COLUMNS, SEQUENCE_SHIFTS
from plantflow.functions import columns as fn
from plantflow.operators import encode, explain, score
from plantflow.plans import inputs as tables
from plantflow.plans import sql_tables
from plantflow.plans.registry import common, query, rounded
from plantflow.session import durable
from plantflow.sources import star_inputs as inputs

ORDER = sql_tables.SHIFT_ORDER
_RANK = "CASE split WHEN 'test' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END"

common(
    "latest_window",
    f"""
SELECT * EXCLUDE (rn, cnt, r, best), 6 - rn AS position FROM (
  SELECT *, min(r) OVER (PARTITION BY machine_id) AS best FROM (
    SELECT *, row_number() OVER (PARTITION BY machine_id, split ORDER BY sim_day DESC, {ORDER} DESC) AS rn, count(*) OVER (PARTITION BY machine_id, split) AS cnt, {_RANK} AS r FROM split_features)
  WHERE cnt >= 5) WHERE r = best AND rn <= 5""",
    ("split_features",),
)


@query(
    "latest_window",
    "SELECT machine_id, split, position, sim_day, shift, round(production_rate, 6) AS production_rate FROM latest_window",
    ("latest_window",),
)
def latest_window(spark, sf_dir):
    """The last five shifts per machine from the newest split that has five."""
    rows = score.latest_window(tables.feature_table(spark, sf_dir))
    return rounded(rows.select("machine_id", "split", "position", "sim_day", "shift", "production_rate"))


@query(
    "latest_events",
    "SELECT user_id, event_id, 8 - rn AS position FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS cnt FROM events) WHERE rn <= 7 AND cnt >= 7",
)
def latest_events(spark, sf_dir):
    """The last seven events of every user that has seven."""
    events = inputs.events(spark, sf_dir)
    return score.latest_rows(events, 7, "user_id", [F.col("ts").desc()]).select("user_id", "event_id", "position")


_CHECK = " + ".join(f"{i + 1} * coalesce({c}, 0)" for i, c in enumerate(SEQUENCE_COLUMNS))


def _sequence_sql(within: str, where: str = "") -> str:
    return f"""
SELECT machine_id, sim_day, shift, label, round(checksum, 4) AS checksum FROM (
  SELECT machine_id, sim_day, shift, failure_next_shift AS label, count(*) OVER w AS n,
    {" + ".join(f"{5 - o} * lag(check_row, {o}) OVER (PARTITION BY machine_id{within} ORDER BY sim_day, {ORDER})" if o else "5 * check_row" for o in range(5))} AS checksum
  FROM (SELECT *, ({_CHECK})::DOUBLE AS check_row FROM split_features)
  WINDOW w AS (PARTITION BY machine_id{within} ORDER BY sim_day, {ORDER} ROWS 4 PRECEDING)) WHERE n = 5{where}"""


def _checksum(windows):
    """Position-weighted sum of a window, so that results compare as one number."""
    row_sum = lambda row: F.aggregate(
        F.transform(row, lambda v, i: F.coalesce(v, F.lit(0.0)) * (i + 1)), F.lit(0.0), lambda s, x: s + x
    )
    total = F.aggregate(F.transform("window", lambda row, i: row_sum(row) * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return rounded(windows.withColumn("checksum", total).select("machine_id", "sim_day", "shift", "label", "checksum"), 4)


@query("sequences", _sequence_sql(", split"), ("split_features",))
def sequences(spark, sf_dir):
    """Sliding windows of five shifts inside one split, labelled by their last shift."""
    features = tables.feature_table(spark, sf_dir).withColumn("label", F.col("failure_next_shift"))
    return _checksum(score.sequences(features, SEQUENCE_COLUMNS, label="label"))


@query("sequence_as_of", _sequence_sql("", " AND sim_day = 20 AND shift = 'Afternoon'"), ("split_features",))
def sequence_as_of(spark, sf_dir):
    """The windows that end at day 20, Afternoon, whatever split their rows are in."""
    features = tables.feature_table(spark, sf_dir).withColumn("label", F.col("failure_next_shift"))
    return _checksum(score.window_as_of(features, SEQUENCE_COLUMNS, 20, "Afternoon", label="label"))


@query(
    "window_counts",
    "SELECT machine_id, split, greatest(count(*) - 4, 0) AS windows FROM split_features GROUP BY machine_id, split HAVING count(*) >= 5",
    ("split_features",),
)
def window_counts(spark, sf_dir):
    """n - 4 windows per machine and split."""
    windows = score.sequences(tables.feature_table(spark, sf_dir), ["production_rate"])
    return windows.groupBy("machine_id", "split").agg(F.count(F.lit(1)).alias("windows"))


@query(
    "latest_record",
    "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def latest_record(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return score.latest_record(orders, "o_custkey", F.col("o_orderdate"), F.col("o_orderkey")).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


# --- signals and attribution ----------------------------------------------

SIGNALS = ["production_rate", "quality_score", "downtime_minutes", "vibration_mm_s_mean", "temperature_k_mean"]
COEFFICIENTS = [0.4, -0.3, 0.9, 0.6, 0.2]
INTERCEPT = -1.0

_TRAIN = "(SELECT {f}({c}) FROM split_features WHERE split = 'train')"


def _filled(c: str) -> str:
    return f"coalesce({c}, {_TRAIN.format(f='median', c=c)})"


common(
    "signal_stats",
    " UNION ALL ".join(
        f"SELECT {i} AS i, '{c}' AS name, {w}::DOUBLE AS w, avg({_filled(c)}) AS m, stddev_samp({_filled(c)}) AS s, {_TRAIN.format(f='median', c=c)} AS med FROM split_features WHERE split = 'train'"
        for i, (c, w) in enumerate(zip(SIGNALS, COEFFICIENTS))
    ),
    ("split_features",),
)
common(
    "signal_z",
    "SELECT l.machine_id, l.position, st.i, st.name, st.w, coalesce(l.v, st.med) AS actual, (coalesce(l.v, st.med) - st.m) / st.s AS z FROM ("
    + " UNION ALL ".join(f"SELECT machine_id, position, {i} AS i, {c} AS v FROM latest_window" for i, c in enumerate(SIGNALS))
    + ") l JOIN signal_stats st USING (i)",
    ("latest_window", "signal_stats"),
)
common(
    "attributions",
    f"""
SELECT machine_id, name AS feature, i, value, base_prob, base_prob - 1 / (1 + exp(-(total - part))) AS contribution FROM (
  SELECT *, sum(part) OVER (PARTITION BY machine_id) + ({INTERCEPT}) AS total, 1 / (1 + exp(-(sum(part) OVER (PARTITION BY machine_id) + ({INTERCEPT})))) AS base_prob FROM (
    SELECT machine_id, name, i, w * avg(z) AS part, max(actual) FILTER (position = 5) AS value FROM signal_z GROUP BY machine_id, name, i, w))""",
    ("signal_z",),
)


def _contract(features):
    return encode.fit_contract(features, SIGNALS, flags=False, standardise=True, window=SEQUENCE_SHIFTS)


def _latest_standardised(spark, sf_dir):
    features = durable(tables.feature_table(spark, sf_dir).select("machine_id", "split", "sim_day", "shift", *SIGNALS))
    contract = _contract(features)
    recent = durable(score.latest_window(features))
    filled = encode.flag_and_impute(recent.filter(F.col("position") == SEQUENCE_SHIFTS), contract.medians, [])
    actual = filled.select("machine_id", F.array(*[F.col(c).cast("double") for c in SIGNALS]).alias("actual"))
    return encode.apply_contract(recent, contract, keep=["machine_id", "position"]), actual


@query(
    "important_signals",
    "SELECT machine_id, string_agg(name, ',' ORDER BY k) AS signals FROM (SELECT machine_id, name, row_number() OVER (PARTITION BY machine_id ORDER BY abs(z) DESC, i) AS k FROM signal_z WHERE position = 5) WHERE k <= 3 GROUP BY machine_id",
    ("signal_z",),
)
def important_signals(spark, sf_dir):
    """The three channels of each machine's last shift that deviate most from training."""
    rows, _ = _latest_standardised(spark, sf_dir)
    last = rows.filter(F.col("position") == SEQUENCE_SHIFTS)
    unit = {c: 0.0 for c in SIGNALS}, {c: 1.0 for c in SIGNALS}
    return score.important_signals(last, SIGNALS, *unit).select("machine_id", F.array_join("important_signals", ",").alias("signals"))


def _attributions(spark, sf_dir):
    rows, actual = _latest_standardised(spark, sf_dir)
    windows = score.window_arrays(rows, SIGNALS).join(actual, "machine_id")
    return explain.neutralisation_importance(windows, SIGNALS, score.linear_scorer(COEFFICIENTS, INTERCEPT))


@query(
    "neutralisation_importance",
    "SELECT machine_id, feature, round(value, 6) AS value, round(base_prob, 6) AS base_prob, round(contribution, 6) AS contribution FROM attributions",
    ("attributions",),
)
def neutralisation_importance(spark, sf_dir):
    """How far each machine's score falls when one feature is set to its training mean."""
    return rounded(_attributions(spark, sf_dir).drop("feature_order"))


@query(
    "top_contributions",
    "SELECT machine_id, feature, rank, round(contribution, 6) AS contribution, CASE WHEN contribution > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY abs(contribution) DESC, i) AS rank FROM attributions) WHERE rank <= 3",
    ("attributions",),
)
def top_contributions(spark, sf_dir):
    top = explain.top_contributions(_attributions(spark, sf_dir), k=3)
    return top.select("machine_id", "feature", "rank", "contribution", "direction")


@query(
    "explanation_summary",
    """
SELECT machine_id, concat_ws(' ', 'Predicted risk: ' || CASE WHEN p >= 0.4 THEN 'HIGH' WHEN p < 0.2 THEN 'LOW' ELSE 'MEDIUM' END || ' (failure probability ' || printf('%.1f', round(p, 4) * 100) || '%).',
  'The prediction is pushed toward failure mainly by: ' || up || '.', 'Pushing toward normal operation: ' || down || '.') AS summary FROM (
  SELECT machine_id, any_value(base_prob) AS p, string_agg(replace(feature, '_', ' '), ', ' ORDER BY ku) FILTER (contribution > 0 AND ku <= 3) AS up,
    string_agg(replace(feature, '_', ' '), ', ' ORDER BY ku) FILTER (contribution <= 0 AND ku <= 2) AS down FROM (
    SELECT *, row_number() OVER (PARTITION BY machine_id, contribution > 0 ORDER BY abs(contribution) DESC, i) AS ku FROM attributions) GROUP BY machine_id)""",
    ("attributions",),
)
def explanation_summary(spark, sf_dir):
    """Each machine's explanation in words."""
    contributions = _attributions(spark, sf_dir)
    base = contributions.groupBy("machine_id").agg(F.max("base_prob").alias("prob"))
    lists = explain.explanation_lists(explain.top_contributions(contributions, k=5))
    joined = score.risk(base, 0.4).join(lists, "machine_id")
    nothing = F.lit(None).cast("string")
    text = explain.human_summary(
        F.col("risk_level"), F.round("prob", 4), F.col("feature_explanations"), nothing, F.lit(None).cast("double")
    )
    return joined.select("machine_id", text.alias("summary"))


@query(
    "linear_contributions",
    "SELECT l_orderkey, l_linenumber, l_partkey, feature, value, round(contribution, 4) AS contribution FROM ("
    + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, '{c}' AS feature, {c} AS value, {w}::DOUBLE * ({c} - (SELECT avg({c}) FROM lineitem)) AS contribution FROM lineitem"
        for c, w in (("l_quantity", 0.02), ("l_discount", -3.0), ("l_tax", 1.5))
    )
    + ")",
)
def linear_contributions(spark, sf_dir):
    """Contributions of a linear model against the mean of all rows, for every line."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    weights = {"l_quantity": 0.02, "l_discount": -3.0, "l_tax": 1.5}
    parts = explain.linear_contributions(lines, lines, weights, ["l_orderkey", "l_linenumber", "l_partkey"])
    return rounded(parts.drop("feature_order"), 4, "value")


@query(
    "background_sample",
    "SELECT model, id, label FROM scored WHERE split = 'train' ORDER BY md5('42|' || model || '-' || id), model || '-' || id LIMIT 50",
    ("scored",),
)
def background_sample(spark, sf_dir):
    """A seeded sample of 50 training rows."""
    scored = inputs.scored(spark, sf_dir).filter(F.col("split") == "train")
    named = scored.withColumn("row", F.concat_ws("-", "model", F.col("id").cast("string")))
    return explain.background_sample(named, "row").select("model", "id", "label")


def fixed_weights(inputs_: int, hidden: int = 16) -> score.RecurrentWeights:
    """Weights by a rule, in place of a trained model file."""

    def grid(rows: int, cols: int, phase: float) -> np.ndarray:
        return np.sin(np.arange(rows * cols).reshape(rows, cols) * 0.37 + phase) / np.sqrt(rows)

    size = inputs_ + hidden
    return score.RecurrentWeights(
        grid(size, hidden, 0.1), np.zeros(hidden), grid(size, hidden, 0.2), np.zeros(hidden),
        grid(size, hidden, 0.3), np.zeros(hidden), grid(hidden, 1, 0.4), np.zeros(1),
    )


@query("recurrent_scores")
def recurrent_scores(spark, sf_dir):
    """Every sequence of every machine scored by the recurrent model in Arrow batches."""
    features = durable(tables.feature_table(spark, sf_dir).select("machine_id", "split", "sim_day", "shift", *SIGNALS))
    encoded = encode.apply_contract(features, _contract(features), keep=["machine_id", "split", "sim_day", "shift"])
    windows = score.sequences(encoded, SIGNALS)
    scored = score.recurrent_scorer(fixed_weights(len(SIGNALS)))(windows, "window")
    return rounded(score.risk(scored, 0.5).select("machine_id", "split", "sim_day", "shift", "prob", "predicted_failure", "risk_level"))


@query("recurrent_attributions")
def recurrent_attributions(spark, sf_dir):
    """Neutralisation importance of the recurrent model for every machine's last window."""
    rows, _ = _latest_standardised(spark, sf_dir)
    windows = score.window_arrays(rows, SIGNALS)
    found = explain.neutralisation_importance(windows, SIGNALS, score.recurrent_scorer(fixed_weights(len(SIGNALS))))
    return rounded(explain.top_contributions(found))
