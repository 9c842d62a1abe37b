"""Shift aggregation over a stream of sensor readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plantflow.config import CHANNELS, PHYSICAL_BOUNDS, SHIFT_HOURS, SHIFTS, Shift
from plantflow.functions import columns as fn
from plantflow.operators.integrate import shift_measures


def shift_window(ts: str = "timestamp", shifts: Sequence[Shift] = SHIFTS, hours: int = SHIFT_HOURS) -> Column:
    """The tumbling window of equal shifts that contains an instant."""
    offset = min(s.start_hour for s in shifts)
    return F.window(ts, f"{hours} hours", f"{hours} hours", f"{offset} hours")


def stream_shift_aggregate(
    readings: DataFrame,
    columns: Sequence[str] = CHANNELS,
    late: str = "1 hour",
    shifts: Sequence[Shift] = SHIFTS,
) -> DataFrame:
    """Shift measures of a streaming (or batch) sensor frame.

    As in the batch cleaning, labels are normalised and bad times dropped, then repeats of a whole reading
    removed (different readings of a machine at one instant all count), then impossible values nulled. Shifts
    are closed once the watermark has passed them; readings later than that are left out and counted
    (`late_rows`).
    """
    labels = {c: fn.normalise_label(c) for c in ("machine_type", "operating_status") if c in readings.columns}
    typed = readings.withColumns({**labels, "timestamp": F.col("timestamp").try_cast("timestamp")})
    timed = typed.filter(F.col("timestamp").isNotNull())
    if readings.isStreaming:
        # copies have one time, so a copy that comes when its first is forgotten is a late row
        distinct = timed.withWatermark("timestamp", late).dropDuplicatesWithinWatermark()
    else:
        distinct = timed.dropDuplicates()
    bounded = distinct.withColumns({c: fn.within(c, *PHYSICAL_BOUNDS[c]) for c in columns if c in PHYSICAL_BOUNDS})
    grouped = bounded.groupBy("machine_id", shift_window("timestamp", shifts).alias("_window")).agg(*shift_measures(columns))
    start = F.col("_window.start")
    return grouped.withColumns({"date": F.to_date(start), "shift": fn.shift_name(start, shifts), "shift_start": start}).drop("_window")


def write_stream(shifts: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run over everything that is available and append the closed shifts to a table."""
    return (
        shifts.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def late_rows(query: StreamingQuery) -> int:
    """Readings that a query has left out because their time had passed the watermark, copies included.

    Spark keeps only the latest `spark.sql.streaming.numRecentProgressUpdates` updates; a run with more of
    them is refused rather than counted in part.
    """
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    updates = query.recentProgress
    if len(updates) >= kept:
        raise ValueError("raise spark.sql.streaming.numRecentProgressUpdates before the run to count its late rows")
    return sum(state["numRowsDroppedByWatermark"] for update in updates for state in update["stateOperators"])
