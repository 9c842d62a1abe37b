"""Logical schemas of the raw tables and the quality gate they must pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from plantflow.functions.columns import lenient_double

# The columns of the three raw tables and whether they hold text or numbers.
SENSOR_SCHEMA = {
    "machine_id": "text",
    "machine_type": "text",
    "timestamp": "text",
    "temperature_k": "number",
    "process_temperature_k": "number",
    "vibration_mm_s": "number",
    "pressure_bar": "number",
    "torque_nm": "number",
    "rotational_speed_rpm": "number",
    "load_pct": "number",
    "tool_wear_min": "number",
    "operating_status": "text",
    "failure_flag": "integer",
}
PRODUCTION_SCHEMA = {
    "machine_id": "text",
    "machine_type": "text",
    "date": "text",
    "shift": "text",
    "production_rate": "number",
    "production_count": "integer",
    "quality_score": "number",
    "downtime_minutes": "number",
    "operating_status": "text",
}
MAINTENANCE_SCHEMA = {
    "machine_id": "text",
    "timestamp": "text",
    "maintenance_type": "text",
    "incident_type": "text",
    "maintenance_note": "text",
    "urgency": "text",
}
_CAST = {"number": "double", "integer": "bigint"}


class SchemaValidationError(ValueError):
    """A raw table cannot be used; the message names the table and the rule."""


def text_schema(schema: Mapping[str, str]) -> T.StructType:
    """Read schema with every column as text, so that bad values reach the cleaning rules."""
    return T.StructType([T.StructField(c, T.StringType()) for c in schema])


def typed(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast the numeric columns leniently: what does not parse becomes NULL."""
    casts = {c: lenient_double(c).cast(_CAST[kind]) for c, kind in schema.items() if kind in _CAST and c in df.columns}
    return df.withColumns(casts)


def quality_report(df: DataFrame, schema: Mapping[str, str], name: str) -> DataFrame:
    """Rule failures of a raw table as `(table, rule, column, n)`, all data rules from one pass.

    Rules: missing columns, an empty table, a numeric column of which more than
    half does not parse, and no machine id at all.
    """
    spark = df.sparkSession
    missing = [c for c in schema if c not in df.columns]
    if missing:
        rows = [(name, "missing_column", c, None) for c in missing]
        return spark.createDataFrame(rows, "table string, rule string, column string, n bigint")
    numeric = [c for c, kind in schema.items() if kind in _CAST]
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("machine_id").alias("ids"),
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"bad_{c}") for c in numeric],
    )
    checks = [("empty", None, F.col("rows"), F.col("rows") == 0)]
    checks += [("mostly_unparseable", c, F.col(f"bad_{c}"), F.col(f"bad_{c}") > F.col("rows") * 0.5) for c in numeric]
    checks += [("no_machine_id", "machine_id", F.col("ids"), (F.col("ids") == 0) & (F.col("rows") > 0))]
    found = [
        F.struct(
            F.lit(name).alias("table"),
            F.lit(rule).alias("rule"),
            F.lit(column).cast("string").alias("column"),
            n.cast("bigint").alias("n"),
            failed.alias("failed"),
        )
        for rule, column, n, failed in checks
    ]
    return totals.select(F.inline(F.array(*found))).filter("failed").drop("failed")


def validate_schema(df: DataFrame, schema: Mapping[str, str], name: str) -> DataFrame:
    """Return the table unchanged, or raise with every broken rule."""
    broken = quality_report(df, schema, name).collect()
    if broken:
        rules = ", ".join(r["rule"] + (f" ({r['column']})" if r["column"] else "") for r in broken)
        raise SchemaValidationError(f"[{name}] {rules}")
    return df
