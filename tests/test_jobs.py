import pytest
from pyspark.sql import functions as F

from plantflow.config import SEQUENCE_COLUMNS
from plantflow.operators import score
from plantflow.plans import jobs
from plantflow.plans.catalog_windows import fixed_weights
from plantflow.sources import readers, sinks, star_inputs as inputs


@pytest.fixture(scope="module")
def prepared(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    for name, table in (("sensor", inputs.sensor_raw), ("production", inputs.production_raw), ("maintenance", inputs.maintenance_raw)):
        sinks.write_table(table(spark, sf_dir), f"{folder}/raw/raw_{name}_data.csv", format="csv")
    jobs.prepare(spark, f"{folder}/raw", f"{folder}/out", inputs.EVENT_DAYS)
    return f"{folder}/out"


def test_prepare_writes_tables_and_reports(spark, prepared):
    table = readers.read_splits(spark, f"{prepared}/splits")
    assert {r.split for r in table.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert not [c for c in table.columns if c.startswith("_")]
    ledger = spark.read.json(f"{prepared}/reports/cleaning")
    counts = {(r.table, r.rule): r.n for r in ledger.filter("column is null").collect()}
    assert counts["sensor", "rows_after"] == spark.read.parquet(f"{prepared}/cleaned_sensor").count()
    integration = spark.read.json(f"{prepared}/reports/integration").first()
    assert integration.rows_before_merge == integration.rows_after_merge == spark.read.parquet(f"{prepared}/integrated").count()
    assert integration.final_columns == 33


def test_train_saves_and_registers(spark, prepared):
    metrics = jobs.train(spark, prepared, ["logistic_regression"])
    assert metrics.count() == 3
    registry = spark.read.parquet(f"{prepared}/registry").first()
    assert (registry.selected_model, registry.version) == ("logistic_regression", 1)
    assert spark.read.json(f"{prepared}/reports/metrics_long").count() > 20


def test_decide_for_all_and_review(spark, prepared, tmp_path):
    table = readers.read_splits(spark, f"{prepared}/splits")
    statuses = table.filter("split = 'train'").select("operating_status").distinct().count()
    scorer = score.recurrent_scorer(fixed_weights(len(SEQUENCE_COLUMNS) + statuses))
    decided = jobs.decide_all(table, scorer)
    rows = decided.collect()
    assert len(rows) == table.select("machine_id").distinct().count()
    one = next(r for r in rows if r.pm_status == "ok")
    assert one.priority in ("URGENT", "ELEVATED", "ROUTINE") and len(one.trace) == 7
    assert len(one.xai.feature_explanations) == 5 and len(one.scenarios) == 3
    assert one.vision_status == "unavailable" and one.rag_status is None
    assert "Vision result unavailable: No vision result found" in " ".join(one.reasoning)
    reviews = spark.createDataFrame(
        [(one.machine_id, "APPROVE", None, None, "s"), (one.machine_id, "REJECT", None, None, "s"), ("M-none", "APPROVE", None, None, "s")],
        "machine_id string, human_decision string, comment string, modified_action string, supervisor string",
    )
    refused = jobs.record_reviews(decided, reviews, str(tmp_path / "log"))
    assert refused.count() == 2
    logged = spark.read.json(str(tmp_path / "log")).select("final_action", F.col("original_ai_recommendation.recommendation")).first()
    assert logged.final_action == logged.recommendation == one.recommendation


def test_decisions_at_a_past_shift(spark, prepared):
    """With a day and shift, explanation and what-if start from the window that ends there, and from nothing later."""
    table = readers.read_splits(spark, f"{prepared}/splits")
    statuses = table.filter("split = 'train'").select("operating_status").distinct().count()
    scorer = score.recurrent_scorer(fixed_weights(len(SEQUENCE_COLUMNS) + statuses))
    at = (12, "Afternoon")
    then = {r.machine_id: r for r in jobs.decide_all(table, scorer, at=at).collect() if r.pm_status == "ok"}
    place = F.col("sim_day") * 10 + F.when(F.col("shift") == "Morning", 0).when(F.col("shift") == "Afternoon", 1).otherwise(2)
    known = table.filter((F.col("split") == "train") | (place <= 121))
    earlier = {r.machine_id: r for r in jobs.decide_all(known, scorer, at=at).collect() if r.pm_status == "ok"}
    assert then and {k: (r.failure_probability, r.xai.top_features) for k, r in then.items()} == {k: (r.failure_probability, r.xai.top_features) for k, r in earlier.items()}
    now = {r.machine_id: r for r in jobs.decide_all(table, scorer).collect() if r.pm_status == "ok"}
    assert any(then[k].failure_probability != now[k].failure_probability for k in then)
    records = jobs.simulate_at(table, table.select("machine_id").distinct().selectExpr("machine_id", "12 as sim_day", "'Afternoon' as shift"), score.linear_scorer([0.1] * 5, -1.0), SEQUENCE_COLUMNS[:5])
    one = records.first()
    assert [s.scenario for s in one.scenarios] == ["continue_operating", "stop_for_maintenance", "reduce_load"]
    assert one.horizon_hours == one.horizon_shifts * 8 and one.recommended_scenario == max(one.scenarios, key=lambda s: (s.estimated_net_value_usd, -s.scenario_order)).scenario
    assert one.scenarios[1].description.startswith("Stop now for preventive maintenance (4.5h, ")
    assert one.scenarios[2].description == "Reduce production rate/load by 20% for the full horizon."


def test_workflow_neither_indexes_pages_nor_counts_groups_of_every_table(spark, sf_dir, monkeypatch):
    """One count of the events stands for all tables made from them, and few questions need no posting lists."""
    from plantflow.operators import retrieve, skew
    from plantflow.plans import catalog

    def refused(*_, **__):
        raise AssertionError("not for this query")

    monkeypatch.setattr(retrieve, "build_index", refused)
    with monkeypatch.context() as patch:
        patch.setattr(skew, "has_hot_group", refused)
        catalog.QUERIES["feature_table"](spark, sf_dir)
    rows = catalog.QUERIES["machine_workflow"](spark, sf_dir).collect()
    assert rows and all(r.steps == 7 and r.question for r in rows)


def test_one_count_of_events_bounds_all_groups(spark, sf_dir, small_groups):
    """Groups that may be too large are measured by each step, as before."""
    from plantflow.plans import inputs as tables

    assert tables.hot_groups(spark, sf_dir) is None
    spark.conf.unset("spark.plantflow.maxGroupRows")
    assert tables.hot_groups(spark, sf_dir) is False
    most = max(
        table(spark, sf_dir).groupBy("machine_id").count().agg(F.max("count")).first()[0]
        for table in (inputs.sensor_raw, inputs.production_raw, inputs.maintenance_raw)
    )
    largest = inputs.table(spark, sf_dir, "events").groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert most <= 2 * largest
