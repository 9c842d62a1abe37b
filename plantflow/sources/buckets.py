"""Bucketed tables at a path: rows placed by a key once, so that joins and groups by that key move nothing afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_BUCKETS = 4_096


def write_bucketed(
    df: DataFrame, path: str, column: str, buckets: int, sort: Sequence[str] = (), placed: bool = False, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Write the rows to `path` in `buckets` files by a hash of `column`, sorted inside, and read them back as such.

    Rows that come from a table bucketed alike are `placed` already and are written where they are.
    """
    name = _name()
    rows = df if placed else df.repartition(buckets, column)
    writer = rows.write.format("parquet").option("path", path).options(**(options or {}))
    writer.bucketBy(buckets, column).sortBy(column, *sort).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, column: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """A table written by `write_bucketed`, also by another application."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name, order = _name(), ", ".join(f"`{c}`" for c in (column, *sort))
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{column}`) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def bucket_keys(spark: SparkSession, buckets: int) -> list[int]:
    """One number for each bucket, so that as many groups as buckets fill them evenly."""
    numbers = spark.range(24 * buckets + 64).select(F.col("id").cast("int").alias("n"))
    placed = numbers.groupBy(F.pmod(F.hash("n"), F.lit(buckets)).alias("bucket")).agg(F.min("n").alias("n"))
    return [r["n"] for r in placed.orderBy("bucket").collect()]


def _name() -> str:
    return f"plantflow_{uuid.uuid4().hex}"
