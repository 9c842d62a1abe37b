import pytest
from pyspark.sql import functions as F

from plantflow.config import SplitDays
from plantflow.operators import encode, features, integrate, profile, score

COLUMNS = "machine_id string, date string, shift string, quality_score double, failure_occurred_this_shift int"


def shifts(spark, rows, schema=COLUMNS):
    return spark.createDataFrame(rows, schema).withColumn("date", F.col("date").cast("date"))


def test_history_uses_earlier_shifts_only(spark):
    rows = [("M-1", f"2024-01-0{d}", "Morning", q, 0) for d, q in zip(range(1, 6), (90.0, 80.0, 70.0, 60.0, 50.0))]
    got = features.add_history(shifts(spark, rows), ["quality_score"]).orderBy("date").collect()
    assert [r.quality_score_lag1 for r in got] == [None, 90.0, 80.0, 70.0, 60.0]
    assert [r.quality_score_rollmean_3 for r in got] == [None, 90.0, 85.0, 80.0, 70.0]
    assert got[4].quality_score_rollmean_9 == 75.0


def test_shift_order_within_a_day(spark):
    rows = [("M-1", "2024-01-01", s, q, 0) for s, q in (("Night", 3.0), ("Afternoon", 2.0), ("Morning", 1.0))]
    got = features.add_history(shifts(spark, rows), ["quality_score"]).collect()
    assert {r.shift: r.quality_score_lag1 for r in got} == {"Morning": None, "Afternoon": 1.0, "Night": 2.0}


def test_label_is_the_next_shift(spark):
    rows = [("M-1", f"2024-01-0{d}", "Morning", 1.0, f) for d, f in zip(range(1, 4), (0, 1, 0))]
    labelled = features.add_target(shifts(spark, rows)).filter("failure_next_shift is not null").orderBy("date").collect()
    assert [(str(r.date), r.failure_next_shift) for r in labelled] == [("2024-01-01", 1), ("2024-01-02", 0)]


def test_label_of_a_shift_before_one_without_readings_is_dropped(spark):
    rows = [("M-1", f"2024-01-0{d}", "Morning", 1.0, f) for d, f in zip(range(1, 4), (0, None, 1))]
    labelled = features.add_target(shifts(spark, rows)).filter("failure_next_shift is not null").collect()
    assert [str(r.date) for r in labelled] == ["2024-01-02"]


def test_join_keeps_production_rows(spark):
    production = spark.createDataFrame(
        [("M-1", "CNC", "2024-01-01", "Morning", 1.0), ("M-1", "CNC", "2024-01-01", "Night", 1.0), ("M-9", "CNC", None, "Night", 1.0)],
        "machine_id string, machine_type string, date string, shift string, production_rate double",
    ).withColumn("date", F.col("date").cast("date"))
    sensor = spark.createDataFrame(
        [("M-1", "2024-01-02 01:00:00", 3.0, 1), ("M-1", "2024-01-01 23:00:00", 5.0, 0)], "machine_id string, t string, x double, failure_flag int"
    ).withColumn("timestamp", F.col("t").cast("timestamp"))
    events = sensor.select("machine_id", F.lit("2023-12-31 06:00:00").cast("timestamp").alias("timestamp")).limit(1)
    joined = integrate.integrate(production, sensor, events, ["x"])
    rows = {(r.machine_id, r.shift): r for r in joined.collect()}
    assert len(rows) == 3
    night = rows["M-1", "Night"]
    assert (night.x_mean, night.x_max, night.failure_occurred_this_shift) == (4.0, 5.0, 1)
    assert (night.days_since_last_maintenance, night.maintenance_count_past_7d) == (1.67, 1)
    assert rows["M-1", "Morning"].x_mean is None
    assert (rows["M-9", "Night"].days_since_last_maintenance, rows["M-9", "Night"].maintenance_count_past_7d) == (None, 0)
    summary = integrate.integration_summary(production, joined, "x_mean").first()
    assert (summary.rows_before_merge, summary.rows_after_merge, summary.unmatched_sensor_rows) == (3, 3, 2)


def test_time_split_is_disjoint_and_ordered(spark):
    days = spark.range(0, 95).select(F.date_add(F.lit("2026-05-01").cast("date"), F.col("id").cast("int")).alias("date"))
    split = features.time_split(days, SplitDays())
    got = {r.split: (r.low, r.high) for r in split.groupBy("split").agg(F.min("sim_day").alias("low"), F.max("sim_day").alias("high")).collect()}
    assert got == {"train": (1, 50), "validation": (51, 65), "test": (66, 90)}
    assert features.overlapping_days(split).isEmpty()


def test_overlap_checks_every_pair(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train")], "sim_day int, split string")
    assert [(r.sim_day, r.splits) for r in features.overlapping_days(df).collect()] == [(1, ["test", "train"])]


@pytest.fixture
def table(spark):
    rows = [(f"M-{m}", d, s, "train" if d <= 3 else "validation" if d == 4 else "test", float(10 * d + i), "RUNNING" if d != 2 else "DOWN")
            for m in (1, 2) for d in range(1, 7) for i, s in enumerate(("Morning", "Afternoon", "Night")) if not (m == 2 and d > 4)]
    return spark.createDataFrame(rows, "machine_id string, sim_day int, shift string, split string, v double, operating_status string")


def test_sequences_stay_in_their_split(spark, table):
    labelled = table.withColumn("label", F.col("v"))
    windows = score.sequences(labelled, ["v"], 5, label="label")
    counts = {(r.machine_id, r.split): r["count"] for r in windows.groupBy("machine_id", "split").count().collect()}
    assert counts == {("M-1", "train"): 5, ("M-2", "train"): 5, ("M-1", "test"): 2}
    for r in windows.collect():
        steps = [x[0] for x in r.window]
        assert steps == sorted(steps) and steps[-1] == r.label
    across = score.window_as_of(table, ["v"], 4, "Morning")
    assert [[x[0] for x in r.window] for r in across.orderBy("machine_id").collect()] == [[22.0, 30.0, 31.0, 32.0, 40.0]] * 2


def test_latest_window_prefers_the_newest_full_split(spark, table):
    rows = score.latest_window(table, 5).orderBy("machine_id", "position").collect()
    assert [(r.machine_id, r.split) for r in rows] == [("M-1", "test")] * 5 + [("M-2", "train")] * 5
    assert [r.v for r in rows[:5]] == [51.0, 52.0, 60.0, 61.0, 62.0]
    assert score.latest_window(table, 50).isEmpty()


def test_contract_freezes_training(spark):
    df = spark.createDataFrame(
        [("train", 1.0, "A"), ("train", None, "B"), ("train", 3.0, "A"), ("test", None, "C")], "split string, x double, kind string"
    )
    contract = encode.fit_contract(df, ["x"], ["kind"])
    assert contract.features == ["x", "kind_A", "kind_B", "x_missing"]
    row = encode.apply_contract(df.filter("split = 'test'"), contract).first()
    assert (row.x, row.kind_A, row.kind_B, row.x_missing) == (2.0, 0.0, 0.0, 1.0)
    bare = encode.apply_contract(df.select("split"), contract).first()
    assert (bare.x, bare.kind_A, bare.x_missing) == (0.0, 0.0, 0.0)


def test_contract_round_trip(spark, tmp_path):
    contract = encode.Contract(["a"], {"k": ["x"]}, {"a": 1.5}, ["a"], {"a": 0.0}, {"a": 2.0}, 5)
    contract.save(spark, str(tmp_path / "contract"))
    assert encode.Contract.load(spark, str(tmp_path / "contract")) == contract


def test_scaler_uses_training_rows_and_replaces_zero(spark):
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", 3.0, 5.0), ("test", 99.0, 9.0)], "split string, x double, c double")
    got = {r.column: (r.mean, r.std) for r in profile.scaler_statistics(df, ["x", "c"]).collect()}
    assert got["x"] == (2.0, pytest.approx(2**0.5)) and got["c"] == (5.0, 1.0)


def test_overview_counts_copies_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "x int, y string")
    row = profile.dataset_overview(df).first()
    assert (row.rows, row["columns"], row.missing_values_total, row.duplicate_rows) == (3, 2, 2, 1)


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0)], "a double, b double")
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] == got["b", "a"] == got["a", "a"] == 1.0


def test_many_anchors_at_once(spark, sf_dir):
    """Anchored rows equal the windows of one anchor after the other; odd anchors have none."""
    from plantflow.operators import score
    from plantflow.plans import inputs as tables

    names = ["production_rate", "downtime_minutes"]
    table = tables.feature_table(spark, sf_dir).select("machine_id", "split", "sim_day", "date", "shift", *names).cache()
    wanted = [(2, "Night"), (15, "Morning"), (18, "Afternoon"), (18, "Night"), (40, "Morning"), (3, "none")]
    days = spark.createDataFrame([(day, shift) for day, shift in wanted], "sim_day int, shift string")
    anchors = table.select("machine_id").distinct().crossJoin(days)
    anchors = anchors.union(anchors).union(spark.createDataFrame([("M-none", 15, "Morning"), (None, 15, "Morning")], anchors.schema))
    rows = score.anchored_rows(table, anchors)
    assert rows.columns == [*table.columns, "anchor", "position"]
    got = {r.anchor: r.window for r in score.window_arrays(rows, names, "anchor").collect()}
    want = {}
    for day, shift in wanted:
        for r in score.window_as_of(table, names, day, shift).collect():
            want[f"{r.machine_id}|{day}|{shift}"] = r.window
    assert got == want and len(want) > 20
    assert {r.n for r in rows.groupBy("anchor").count().select(F.col("count").alias("n")).collect()} == {5}
