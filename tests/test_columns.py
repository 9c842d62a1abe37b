import random

import pytest
from pyspark.sql import Row, functions as F

from plantflow.config import Shift
from plantflow.functions import columns as fn


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def test_label_strips_tabs_and_keeps_null(spark):
    df = spark.createDataFrame([(" cnc\t",), ("Press ",), (None,)], "c string")
    assert values(df.select(fn.normalise_label("c").alias("v"))) == ["CNC", "PRESS", None]


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("unknown", "n/a", "x"), ("2024-01-02 03:04:05", "2024-01-02", "1.5"), (None, None, "NaN")], "t string, d string, n string")
    rows = df.select(fn.lenient_timestamp("t").alias("t"), fn.lenient_date("d").alias("d"), fn.lenient_double("n").alias("n")).collect()
    assert [r.t is None for r in rows] == [True, False, True]
    assert [r.d is None for r in rows] == [True, False, True]
    assert [r.n for r in rows] == [None, 1.5, None]


@pytest.mark.parametrize(
    "time, shift, date",
    [
        ("2024-01-02 05:59:59", "Night", "2024-01-01"),
        ("2024-01-02 06:00:00", "Morning", "2024-01-02"),
        ("2024-01-02 13:59:59", "Morning", "2024-01-02"),
        ("2024-01-02 14:00:00", "Afternoon", "2024-01-02"),
        ("2024-01-02 22:00:00", "Night", "2024-01-02"),
        ("2024-01-03 00:00:00", "Night", "2024-01-02"),
    ],
)
def test_shift_boundaries(spark, time, shift, date):
    df = spark.createDataFrame([(time,)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    row = df.select(fn.shift_name("t").alias("s"), fn.shift_date("t").cast("string").alias("d")).first()
    assert (row.s, row.d) == (shift, date)


def test_hour_outside_every_shift(spark):
    df = spark.range(1).select(F.lit("2024-01-01 03:00:00").cast("timestamp").alias("t"))
    assert df.select(fn.shift_name("t", [Shift("Day", 8, 16)]).alias("v")).first().v == "Unknown"


def test_shift_start_is_null_for_unknown_shift(spark):
    df = spark.createDataFrame([("Night",), ("Other",)], "s string")
    got = values(df.select(fn.shift_start(F.lit("2024-01-01").cast("date"), "s").cast("string").alias("v")))
    assert got == ["2024-01-01 22:00:00", None]


def test_ratios_handle_nulls_and_limits(spark):
    df = spark.createDataFrame([(0.0, 80), (480.0, 80), (600.0, 80), (None, 80)], "m double, c bigint")
    rows = df.select(fn.downtime_ratio("m").alias("r"), fn.production_efficiency("c", "m").alias("e")).collect()
    assert [r.r for r in rows] == [0.0, 1.0, 1.0, None]
    assert [r.e for r in rows] == [10.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("p, n, expected", [(0.1, 1, 0.1), (0.0, 5, 0.0), (0.5, 2, 0.75), (0.5, -3, 0.0)])
def test_compounded_risk(spark, p, n, expected):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(fn.compounded_risk("p", float(n)).alias("v")).first().v == pytest.approx(expected)


def test_risk_levels(spark):
    df = spark.createDataFrame([(0.8,), (0.4,), (0.39,), (None,)], "p double")
    assert values(df.select(fn.risk_level("p", 0.8).alias("v"))) == ["HIGH", "MEDIUM", "LOW", None]


def test_percent_rounds_like_exact_formatting(spark):
    random.seed(3)
    numbers = [round(random.random(), 4) for _ in range(3000)] + [i / 64 for i in range(65)] + [0.0, 1.0]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    rows = df.select("v", fn.percent("v").alias("t")).collect()
    # the text is the one exact binary formatting of the scaled value gives
    assert [r.t for r in rows] == [f"{r.v * 100:.1f}%" for r in rows]


def test_clean_text(spark):
    df = spark.createDataFrame([("Vibration Levels!! Elevated.",)], "t string")
    assert df.select(fn.clean_text("t").alias("v")).first().v == "vibration levels elevated"


def test_tokens_bigrams_and_stop_words(spark):
    df = spark.createDataFrame([("The Spindle of café x runs",)], "t string")
    tokens = fn.tokens("t", ["the", "of"])
    row = df.select(tokens.alias("t"), fn.unigrams_and_bigrams(tokens).alias("g")).first()
    assert row.t == ["spindle", "café", "runs"]
    assert row.g == ["spindle", "café", "runs", "spindle café", "café runs"]
    short = spark.createDataFrame([("a",), ("ab",)], "t string").select(fn.unigrams_and_bigrams(fn.tokens("t")).alias("v"))
    assert values(short) == [[], ["ab"]]


def test_safe_ratio(spark):
    df = spark.createDataFrame([Row(a=1, b=0), Row(a=1, b=4)])
    assert values(df.select(fn.safe_ratio(F.col("a"), F.col("b")).alias("v"))) == [0.0, 0.25]
