"""Cleaned, integrated and feature tables over the star-schema inputs, as lazy frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantflow.operators import features, integrate, quality, skew
from plantflow.session import group_rows
from plantflow.sources import star_inputs as inputs


def hot_groups(spark: SparkSession, sf_dir: str) -> bool | None:
    """False if no table can have a machine too large for one task, else None: each step then measures its own input.

    An event becomes at most a reading, a shift and a maintenance entry, and a copy of each; so one count of the events
    stands for counting the tables made from them.
    """
    return False if 4 * skew.largest_group(inputs.table(spark, sf_dir, "events"), ["user_id"]) <= group_rows(spark) else None


def clean_tables(spark: SparkSession, sf_dir: str, hot: bool | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        quality.clean_production(inputs.production_raw(spark, sf_dir), hot=hot),
        quality.clean_sensor(inputs.sensor_raw(spark, sf_dir), hot=hot),
        quality.clean_maintenance(inputs.maintenance_raw(spark, sf_dir)),
    )


def integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = hot_groups(spark, sf_dir)
    return integrate.integrate(*clean_tables(spark, sf_dir, hot), hot=hot)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled feature table with its time split."""
    return features.time_split(features.build_features(integrated(spark, sf_dir)), inputs.EVENT_DAYS)
