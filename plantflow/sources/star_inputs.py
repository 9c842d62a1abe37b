"""The logical inputs (sensor, production, maintenance, ...) read from the star-schema tables.

The given tables hold no dirt and no machines, so each input maps columns
(user -> machine, event -> reading) and adds dirt by fixed rules on the ids:
bad time strings, untidy labels, nulls, impossible values and exact copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantflow.config import SplitDays
from plantflow.functions import columns as fn
from plantflow.session import spread

# The given events cover January 2024.
EVENT_DAYS = SplitDays(start="2024-01-01", train=(1, 17), validation=(18, 22), test=(23, 30))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a session-zone timestamp and the JSON counter `k` as an integer."""
    return _event_columns(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a streaming frame over the table's files."""
    schema = table(spark, sf_dir, "events").schema
    return _event_columns(spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir))


def _event_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _machine_id() -> Column:
    return F.concat(F.lit("M-"), F.col("user_id").cast("string"))


def _machine_type() -> Column:
    kind = F.col("user_id") % 3
    return F.when(kind == 0, "Cnc").when(kind == 1, "Press").otherwise("Injection_Molder")


def _time_text() -> Column:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(F.col("event_id") % 997 == 0, "unknown").otherwise(text)


def _with_copies(df: DataFrame, rule: Column) -> DataFrame:
    """Append an exact copy of the rows a rule picks."""
    return df.withColumn("copy", F.explode(F.when(rule, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy")


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_from_events(events(spark, sf_dir))


def sensor_from_events(source: DataFrame) -> DataFrame:
    """Raw sensor readings from events; row by row, so it also works on a stream."""
    untidy = F.col("event_id") % 53 == 0
    long_gap = F.dayofmonth("ts").between(10, 15) & (F.col("user_id") % 3 == 0)

    def channel(value: Column, every: int) -> Column:
        return F.when((F.col("event_id") % every == 0) | long_gap, F.lit(None).cast("double")).otherwise(value)

    temperature = 295.0 + F.col("value") / 9.7
    glitch = F.col("event_id") % 211 == 0
    status = F.when(F.col("event_type") == "error", "DOWN").otherwise("RUNNING")
    readings = source.select(
        _machine_id().alias("machine_id"),
        F.when(untidy, F.concat(F.lit(" "), F.lower(_machine_type()), F.lit("\t"))).otherwise(_machine_type()).alias("machine_type"),
        _time_text().alias("timestamp"),
        channel(F.when(glitch, -temperature).otherwise(temperature), 7).alias("temperature_k"),
        (305.0 + F.col("k") / 9.7).alias("process_temperature_k"),
        channel(F.when(glitch, 99.0).otherwise(F.col("value") / 19.7), 11).alias("vibration_mm_s"),
        channel(5.0 + F.col("k") / 9.7, 13).alias("pressure_bar"),
        (40.0 + F.col("k") / 4.9).alias("torque_nm"),
        (1500.0 + F.col("value") * 5.0 / 1.03).alias("rotational_speed_rpm"),
        F.col("k").cast("double").alias("load_pct"),
        (F.col("event_id") % 240).cast("double").alias("tool_wear_min"),
        F.when(untidy, F.concat(F.lit(" "), F.lower(status), F.lit("\t"))).otherwise(status).alias("operating_status"),
        (F.col("event_type") == "error").cast("int").alias("failure_flag"),
        "event_id",
    )
    return _with_copies(readings, F.col("event_id") % 101 == 0).drop("event_id")


def production_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_shift = (
        events(spark, sf_dir)
        .withColumns({"shift": fn.shift_name("ts"), "day": fn.shift_date("ts")})
        .groupBy("user_id", "day", "shift")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("k").alias("ks"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
        .withColumn("d", F.dayofmonth("day"))
    )
    status = (
        F.when(F.col("errors") == F.col("n"), "DOWN").when(F.col("purchases") > 0, "MAINTENANCE").otherwise("RUNNING")
    )
    rows = by_shift.select(
        _machine_id().alias("machine_id"),
        F.when(F.col("user_id") % 7 == 0, F.lower(_machine_type())).otherwise(_machine_type()).alias("machine_type"),
        F.when((F.col("user_id") * 31 + F.col("d")) % 401 == 0, "n/a").otherwise(F.col("day").cast("string")).alias("date"),
        "shift",
        (F.col("ks") / 8.0).alias("production_rate"),
        F.when((F.col("user_id") + F.col("d")) % 29 == 0, F.lit(-1)).otherwise(F.col("ks")).cast("bigint").alias("production_count"),
        F.when((F.col("user_id") + F.col("d")) % 17 == 0, F.lit(None).cast("double"))
        .otherwise(100.0 - F.col("ks") / (9.7 * F.col("n")))
        .alias("quality_score"),
        (480.0 * F.col("errors") / F.col("n")).alias("downtime_minutes"),
        F.when(F.col("user_id") % 11 == 0, F.concat(F.lit(" "), F.lower(status))).otherwise(status).alias("operating_status"),
        "user_id",
    )
    return _with_copies(rows, F.col("user_id") % 50 == 0).drop("user_id")


def maintenance_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    level = F.col("event_id") % 3
    rows = (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "purchase")
        .select(
            _machine_id().alias("machine_id"),
            _time_text().alias("timestamp"),
            F.when(F.col("event_id") % 2 == 0, "Preventive").otherwise("Corrective").alias("maintenance_type"),
            F.when(kind == 0, "Scheduled").when(kind == 1, "Mechanical").when(kind == 2, "Electrical").otherwise("Quality").alias("incident_type"),
            F.concat(F.lit("Replaced "), F.col("k").cast("string"), F.lit(" parts!! Spindle checked.")).alias("maintenance_note"),
            F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("string"))
            .when(level == 0, "Low").when(level == 1, "Medium").otherwise("High").alias("urgency"),
            "event_id",
        )
    )
    return _with_copies(rows, F.col("event_id") % 101 == 0).drop("event_id")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score table `(model, split, id, label, prob)`: two fixed scores of every event."""
    base = events(spark, sf_dir).withColumn("split", _event_split()).filter(F.col("split").isNotNull())
    models = F.array(
        F.struct(F.lit("ratio").alias("model"), (F.col("value") / (F.col("value") + 50.0)).alias("prob")),
        F.struct(F.lit("counter").alias("model"), (F.col("k") / 100.0).alias("prob")),
    )
    label = ((F.col("event_type") == "error") | (F.col("k") > 90)).cast("int")
    return base.select(
        "split", F.col("event_id").alias("id"), label.alias("label"), F.inline(models)
    ).select("model", "split", "id", "label", "prob")


def _event_split() -> Column:
    day = fn.sim_day(F.to_date("ts"), EVENT_DAYS.start)
    label = F.lit(None).cast("string")
    for name, (low, high) in EVENT_DAYS.ranges().items():
        label = F.when(day.between(low, high), name).otherwise(label)
    return label


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page text `(document, page, text)`; some lines become section headings, some pages are blank."""
    headed = F.replace(F.col("text"), F.lit("\nE"), F.lit("\nSection 5: E"))
    opened = F.concat(F.lit("Section "), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(": "), F.col("source"), F.lit("\n"), headed)
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("source").alias("document"),
        F.col("doc_id").alias("page"),
        F.when(F.col("doc_id") % 71 == 0, F.lit(" \n "))
        .when(F.col("doc_id") % 3 == 0, opened)
        .otherwise(headed)
        .alias("text"),
    )
