import pytest
from pyspark.sql import functions as F

from plantflow.config import CHANNELS
from plantflow.operators import quality
from plantflow.sources import schema

SENSOR = "machine_id string, machine_type string, timestamp string, " + ", ".join(f"{c} double" for c in CHANNELS) + ", tool_wear_min double, operating_status string, failure_flag int"


def reading(minute, value, status="RUNNING", machine="M-1", kind="CNC", stamp=None):
    stamp = stamp or f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"
    return (machine, kind, stamp, value, 300.0, 1.0, 5.0, 40.0, 1500.0, 50.0, 0.0, status, 0)


def ledger(df):
    return {(r.rule, r.column): r.n for r in df.collect()}


def clean_values(spark, rows, **options):
    clean = quality.clean_sensor(spark.createDataFrame(rows, SENSOR), **options)
    return [r.temperature_k for r in clean.orderBy("timestamp").collect()]


@pytest.mark.parametrize("gap", [1, 4, 5, 8, 9, 10])
@pytest.mark.parametrize("place", ["start", "middle", "end"])
def test_gap_lengths_while_down(spark, gap, place):
    """At most four readings are filled from each side; the rest of a DOWN gap stays NULL."""
    values = [300.0] * 3 + [None] * gap + [310.0] * 3
    values = values[3:] if place == "start" else values[: 3 + gap] if place == "end" else values
    got = clean_values(spark, [reading(15 * i, v, "DOWN") for i, v in enumerate(values)])
    missing = sum(v is None for v in got)
    assert missing == max(0, gap - (8 if place == "middle" else 4))


def test_running_gap_falls_back_to_the_median_of_filled_values(spark):
    values = [300.0, 302.0] + [None] * 10 + [310.0]
    got = clean_values(spark, [reading(15 * i, v) for i, v in enumerate(values)])
    assert got[2:6] == [302.0] * 4 and got[8:12] == [310.0] * 4
    assert got[6] == got[7] == 302.0 + (310.0 - 302.0) / 2 or got[6] == 302.0 or got[6] == 310.0
    assert None not in got


def test_running_only_leaves_down_rows_alone(spark):
    rows = [reading(0, 300.0), reading(15, None, "DOWN"), reading(30, None), reading(45, 300.0)]
    assert clean_values(spark, rows, running_only=True) == [300.0, None, 300.0, 300.0]
    assert clean_values(spark, rows) == [300.0] * 4


def test_order_of_repairs_and_ledger(spark):
    rows = [
        reading(0, 300.0, kind="cnc "),
        reading(0, 300.0, kind="CNC"),  # a copy once labels are normalised
        reading(15, 500.0),
        reading(30, 301.0),
        reading(45, 301.0, stamp="unknown"),
    ]
    raw = spark.createDataFrame(rows, SENSOR)
    flagged = quality.flag_sensor(raw)
    found = ledger(quality.sensor_ledger(raw, flagged))
    assert found["rows_before", None] == 5
    assert found["rows_dropped_malformed_timestamp", None] == 1
    assert found["rows_dropped_exact_duplicate", None] == 1
    assert found["physically_invalid_values_nulled", "temperature_k"] == 1
    assert found["running_state_values_imputed", "temperature_k"] == 1
    assert found["rows_after", None] == 3
    assert not [c for c in quality.cleaned(flagged).columns if c.startswith("_")]


@pytest.mark.parametrize("limit", ["4000000", "3"])
def test_ledger_of_the_write_equals_the_ledger_of_a_scan(spark, tmp_path, limit):
    """Also where a machine counts as too large, for NULL machines and for an empty table."""
    spark.conf.set("spark.plantflow.maxGroupRows", limit)
    try:
        rows = [reading(15 * i, 300.0 + i if i % 4 else None, "RUNNING" if i % 5 else "DOWN", machine=("M-1", "M-1", "M-2", None)[i % 4]) for i in range(40)]
        rows += rows[:5] + [reading(45, 900.0, stamp="unknown"), reading(46, 900.0)]
        raw = spark.createDataFrame(rows, SENSOR).repartition(3)
        clean, found = quality.clean_and_record("sensor", raw, str(tmp_path / "clean"))
        flagged = quality.flag_sensor(raw)
        assert ledger(found) == ledger(quality.sensor_ledger(raw, flagged))
        assert ledger(found)["rows_dropped_exact_duplicate", None] == 5 and ledger(found)["rows_before", None] == 47
        assert sorted(map(str, clean.collect())) == sorted(map(str, quality.cleaned(flagged).collect()))
        _, nothing = quality.clean_and_record("sensor", raw.limit(0), str(tmp_path / "none"))
        assert set(ledger(nothing).values()) == {0}
    finally:
        spark.conf.unset("spark.plantflow.maxGroupRows")


def test_ledger_of_the_write_reads_nothing_flagged_again(spark, tmp_path):
    raw = spark.createDataFrame([reading(i, 300.0) for i in range(9)], SENSOR)
    _, found = quality.clean_and_record("sensor", raw, str(tmp_path / "clean"))
    plan = found._jdf.queryExecution().toString()
    assert "_glitch" not in plan and "_gap" not in plan and "Window" not in plan


def test_bounds_are_inclusive_and_nan_is_missing(spark):
    rows = [reading(0, 250.0), reading(15, 400.0), reading(30, float("nan"), "DOWN")]
    assert clean_values(spark, rows) == [250.0, 400.0, 400.0]


def test_all_null_channel_and_empty_table(spark):
    assert clean_values(spark, [reading(15 * i, None) for i in range(3)]) == [None] * 3
    assert clean_values(spark, []) == []


PRODUCTION = "machine_id string, machine_type string, date string, shift string, production_rate double, production_count bigint, quality_score double, downtime_minutes double, operating_status string"


def test_production_repairs(spark):
    def row(day, count, score):
        return ("M-1", "cnc", day, "Night", 10.0, count, score, 0.0, "running ")

    raw = spark.createDataFrame(
        [row("2024-01-01", 10, 90.0), row("2024-01-02", -1, None), row("2024-01-03", 13, 80.0), row("n/a", 12, 70.0), row("n/a", 12, 70.0)],
        PRODUCTION,
    )
    flagged = quality.flag_production(raw)
    rows = {str(r.date): r for r in quality.cleaned(flagged).collect()}
    assert len(rows) == 4 and "None" in rows  # a bad date is kept
    assert rows["2024-01-02"].production_count == 11  # median of 10, -1, 13, 12
    assert rows["2024-01-02"].quality_score == 80.0
    found = ledger(quality.production_ledger(raw, flagged))
    assert found["rows_dropped_exact_duplicate", None] == 1
    assert found["invalid_production_count_fixed", "production_count"] == 1
    assert found["quality_score_imputed", "quality_score"] == 1


def test_maintenance_urgency(spark):
    raw = spark.createDataFrame(
        [("M-1", "2024-01-01 00:00:00", "Preventive", "Scheduled", "x", None), ("M-1", "bad", "Preventive", "Scheduled", "x", "Low")],
        ", ".join(f"{c} string" for c in schema.MAINTENANCE_SCHEMA),
    )
    rows = quality.clean_maintenance(raw).collect()
    assert [r.urgency for r in rows] == ["Unknown"]


def test_schema_gate(spark):
    with pytest.raises(schema.SchemaValidationError, match="missing_column"):
        schema.validate_schema(spark.createDataFrame([("M-1",)], "machine_id string"), schema.SENSOR_SCHEMA, "sensor")
    good = spark.createDataFrame([reading(0, 300.0)], SENSOR)
    assert schema.validate_schema(good, schema.SENSOR_SCHEMA, "sensor") is good
    with pytest.raises(schema.SchemaValidationError, match="empty"):
        schema.validate_schema(good.filter("false"), schema.SENSOR_SCHEMA, "sensor")
    with pytest.raises(schema.SchemaValidationError, match="no_machine_id"):
        schema.validate_schema(good.withColumn("machine_id", F.lit(None).cast("string")), schema.SENSOR_SCHEMA, "sensor")
    with pytest.raises(schema.SchemaValidationError, match="mostly_unparseable \\(load_pct\\)"):
        schema.validate_schema(good.withColumn("load_pct", F.lit("high")), schema.SENSOR_SCHEMA, "sensor")


def test_rows_move_once(spark, sf_dir):
    """Repeats, gaps and medians of the sensor table share one exchange and one sort; production shares one exchange."""
    from plantflow.sources import star_inputs

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    sensor = plan(quality.clean_sensor(star_inputs.sensor_raw(spark, sf_dir), hot=False))
    assert sensor.count("Exchange hashpartitioning") == 1 and sensor.count("- Sort [") == 1


def test_repeats_by_digest(spark):
    """Rows that differ only in where a field is missing, or in a field's type of nothing, are no repeats."""
    rows = [
        ("m", 1, None, 5.0, "a"), ("m", 1, 5.0, None, "a"), ("m", 1, 5.0, None, "a"), ("m", 1, 0.0, 5.0, "a"), ("m", 1, -0.0, 5.0, "a"),
        (None, 1, 1.0, 2.0, None), (None, 1, 1.0, 2.0, None), (None, 1, 1.0, 2.0, ""), ("m", 2, 5.0, None, "a"), ("m", None, 1.0, 1.0, "x"),
        ("m", None, 1.0, 1.0, "x"),
    ]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double, s string")
    plain = quality.drop_exact_duplicates(df).collect()
    placed = quality.drop_repeats(df.repartition("k"), "k", "t").drop("_digest").collect()
    assert sorted(map(str, placed)) == sorted(map(str, plain)) and len(plain) == 7
