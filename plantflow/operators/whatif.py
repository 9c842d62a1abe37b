"""What-if scenarios for every machine: risk, downtime, output and money over a horizon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plantflow import wording
from plantflow.config import SEQUENCE_SHIFTS, Economics
from plantflow.functions.columns import compounded_risk
from plantflow.operators.score import Scorer

# The scenarios, in the order that breaks ties, and what each one changes.
SCENARIOS = ["continue_operating", "stop_for_maintenance", "reduce_load"]
REDUCED_COLUMNS = ["load_pct_mean", "torque_nm_mean", "rotational_speed_rpm_mean", "production_rate"]
AFTER_MAINTENANCE = {
    "downtime_minutes": 0.0,
    "downtime_ratio": 0.0,
    "has_recent_maintenance": 1.0,
    "days_since_last_maintenance": 0.0,
    "failure_occurred_this_shift": 0.0,
    "operating_status_DOWN": 0.0,
    "operating_status_MAINTENANCE": 0.0,
    "operating_status_RUNNING": 1.0,
}


# What each scenario says of itself and of where its risk comes from.
DESCRIPTIONS = {
    "continue_operating": "Continue normal operation at the current production rate for the full horizon.",
    "stop_for_maintenance": (
        "Stop now for preventive maintenance (%sh, the fleet's empirical average planned-maintenance duration), "
        "then resume normal operation."
    ),
    "reduce_load": "Reduce production rate/load by %s for the full horizon.",
}
PROBABILITY_SOURCES = {
    "continue_operating": "GRU model, current real input window (unmodified)",
    "stop_for_maintenance": (
        "GRU model, counterfactual post-maintenance input "
        "(fleet-wide healthy-state training averages + reset maintenance fields)"
    ),
    "reduce_load": (
        "GRU model, counterfactual input with load/torque/rpm/production_rate "
        "scaled down %s from the machine's real current readings"
    ),
}


def after_maintenance(state: DataFrame, baseline: DataFrame, features: Sequence[str]) -> DataFrame:
    """The state a machine would have after maintenance: fleet means of healthy shifts plus reset fields."""
    means = state.withColumn("_healthy", baseline.select(F.struct(*baseline.columns)).scalar())
    changed = {}
    for c in features:
        if c in AFTER_MAINTENANCE:
            changed[c] = F.lit(AFTER_MAINTENANCE[c])
        elif c == "maintenance_count_past_7d":
            changed[c] = F.col(c) + 1.0
        elif c in baseline.columns:
            changed[c] = F.col(f"_healthy.{c}")
    return means.withColumns(changed).drop("_healthy")


def reduced_load(state: DataFrame, economics: Economics = Economics()) -> DataFrame:
    """The current state with load, torque, speed and rate scaled down."""
    kept = 1.0 - economics.load_reduction
    return state.withColumns({c: F.col(c) * kept for c in REDUCED_COLUMNS if c in state.columns})


def flat_window(state: DataFrame, features: Sequence[str], means: dict, stds: dict, n: int = SEQUENCE_SHIFTS) -> DataFrame:
    """A steady state as scorer input: the standardised row repeated over the window."""
    row = F.array(*[(F.col(c).cast("double") - F.lit(means[c])) / F.lit(stds[c] or 1.0) for c in features])
    return state.withColumn("window", F.array_repeat(row, n))


def scenario_probabilities(
    state: DataFrame, current: DataFrame, baseline: DataFrame, features: Sequence[str], means: dict, stds: dict,
    scorer: Scorer, economics: Economics = Economics(), n: int = SEQUENCE_SHIFTS, key: str = "machine_id",
) -> DataFrame:
    """Per-machine risk now, after maintenance and at reduced load; all changed states scored in one call.

    `state` has the raw features of each machine's last shift, `current(key, window)` its real window.
    """
    keep = [key, "machine_type", "production_rate"]
    changed = {
        "p_maintenance": flat_window(after_maintenance(state, baseline, features), features, means, stds, n),
        "p_reduced": flat_window(reduced_load(state, economics), features, means, stds, n),
    }
    stacked = current.select(key, F.lit("p_continue").alias("_case"), "window")
    for case, frame in changed.items():
        stacked = stacked.unionByName(frame.select(key, F.lit(case).alias("_case"), "window"))
    scored = scorer(stacked, "window").groupBy(key).agg(
        *[F.max(F.when(F.col("_case") == c, F.col("prob"))).alias(c) for c in ("p_continue", *changed)]
    )
    return state.select(*keep).join(scored, key)


def financials(units: Column, downtime_hours: Column, risk: Column, economics: Economics) -> dict[str, Column]:
    revenue = units * economics.unit_margin_usd
    downtime = downtime_hours * economics.downtime_cost_per_hour_usd
    repair = risk * economics.failure_repair_usd
    return {
        "expected_revenue_usd": F.round(revenue, 2),
        "downtime_cost_usd": F.round(downtime, 2),
        "expected_failure_repair_cost_usd": F.round(repair, 2),
        "estimated_net_value_usd": F.round(revenue - downtime - repair, 2),
    }


def _scenario(name: str, p: Column, rate: Column, full_rate: Column, economics: Economics, horizon: Column) -> Column:
    hours = horizon * economics.shift_hours
    if name == "stop_for_maintenance":
        down = F.least(F.lit(economics.maintenance_downtime_hours), hours)
        risk = compounded_risk(p, (hours - down) / economics.shift_hours)
        units = rate * (hours - down)
        loss = rate * down
    else:
        risk = compounded_risk(p, horizon)
        down = risk * economics.failure_downtime_hours
        units = rate * F.greatest(F.lit(0.0), hours - down)
        loss = full_rate * hours - units
    values = {
        "scenario": F.lit(name),
        "scenario_order": F.lit(SCENARIOS.index(name) + 1),
        "per_shift_failure_probability": F.round(p, 4),
        "cumulative_failure_risk": F.round(risk, 4),
        "expected_downtime_hours": F.round(down, 2),
        "expected_production_units": F.round(units, 1),
        "production_loss_units": F.round(loss, 1),
        **financials(units, down, risk, economics),
    }
    return F.struct(*[v.alias(k) for k, v in values.items()])


def scenario_table(states: DataFrame, economics: Economics = Economics(), horizon_shifts: int | Column | None = None) -> DataFrame:
    """One row per machine and scenario from `production_rate, p_continue, p_maintenance, p_reduced`."""
    horizon = horizon_shifts if isinstance(horizon_shifts, Column) else F.lit(horizon_shifts or economics.horizon_shifts)
    rate = F.col("production_rate")
    cases = [
        _scenario("continue_operating", F.col("p_continue"), rate, rate, economics, horizon),
        _scenario("stop_for_maintenance", F.col("p_maintenance"), rate, rate, economics, horizon),
        _scenario("reduce_load", F.col("p_reduced"), rate * (1.0 - economics.load_reduction), rate, economics, horizon),
    ]
    return states.withColumn("horizon_shifts", horizon).select(*states.columns, "horizon_shifts", F.inline(F.array(*cases)))


def with_descriptions(scenarios: DataFrame, economics: Economics = Economics()) -> DataFrame:
    """Add `description`, `failure_probability_source` and `horizon_hours` to every scenario row."""
    hours = F.col("horizon_shifts") * F.lit(float(economics.shift_hours))
    stopped = F.format_string("%.1f", F.least(F.lit(float(economics.maintenance_downtime_hours)), hours))
    share = f"{economics.load_reduction:.0%}"

    def text(of: dict[str, str]) -> Column:
        chosen = F.lit(None).cast("string")
        for name, said in of.items():
            value = F.format_string(said, stopped) if name == "stop_for_maintenance" and "%s" in said else F.lit(said.replace("%s", share))
            chosen = F.when(F.col("scenario") == name, value).otherwise(chosen)
        return chosen

    return scenarios.withColumns(
        {"description": text(DESCRIPTIONS), "failure_probability_source": text(PROBABILITY_SOURCES), "horizon_hours": hours}
    )


SCENARIO_FIELDS = [
    "scenario", "description", "failure_probability_source", "per_shift_failure_probability", "cumulative_failure_risk",
    "expected_downtime_hours", "expected_production_units", "production_loss_units", "expected_revenue_usd",
    "downtime_cost_usd", "expected_failure_repair_cost_usd", "estimated_net_value_usd",
]


def scenario_records(
    states: DataFrame, economics: Economics = Economics(), horizon_shifts: int | Column | None = None, key: Sequence[str] = ("machine_id",)
) -> DataFrame:
    """The whole record of each machine, one row: horizon, current state, all scenarios in order, and the best of them.

    `states` is what `scenario_table` reads, with `machine_type`. Each machine's three scenarios are made and
    compared in its row.
    """
    key = list(key)
    table = with_descriptions(scenario_table(states, economics, horizon_shifts), economics)
    fields = F.struct("scenario_order", *SCENARIO_FIELDS)
    best = F.struct(F.coalesce("estimated_net_value_usd", F.lit(float("-inf"))), -F.col("scenario_order"))
    rows = table.groupBy(*key).agg(
        F.first("machine_type").alias("machine_type"),
        F.first("horizon_shifts").alias("horizon_shifts"),
        F.first("horizon_hours").alias("horizon_hours"),
        F.round(F.first("production_rate"), 2).alias("current_production_rate"),
        F.round(F.first("p_continue"), 4).alias("current_failure_probability"),
        F.sort_array(F.collect_list(fields)).alias("scenarios"),
        F.max_by("scenario", best).alias("recommended_scenario"),
    )
    return rows.withColumns({"recommendation_basis": F.lit(wording.SCENARIO_BASIS), "status": F.lit("ok")})


def recommend(scenarios: DataFrame, key: Sequence[str] = ("machine_id",)) -> DataFrame:
    """The scenario with the highest net value per machine; the first one wins ties."""
    best = W.partitionBy(*key).orderBy(F.col("estimated_net_value_usd").desc_nulls_last(), "scenario_order")
    return (
        scenarios.withColumn("_place", F.row_number().over(best))
        .filter(F.col("_place") == 1)
        .drop("_place")
        .withColumn("recommendation_basis", F.lit(wording.SCENARIO_BASIS))
        .withColumnRenamed("scenario", "recommended_scenario")
    )
