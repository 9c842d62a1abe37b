"""Cleaning of the three raw tables, with a ledger of every repair.

Each `flag_*` function returns the cleaned rows plus underscore columns that say
what was repaired; `cleaned` drops those columns and `*_ledger` sums them.

Rows are placed by machine once, before anything else. Repeats are found there,
and the windows of gaps and medians run on the same placing and one sort. A
machine with more rows than one task should hold goes another way: repeats by
whole rows, gaps in time segments, medians over value bins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

from plantflow.config import CHANNELS, GAP_READINGS, OUTLIER_CHANNELS, PHYSICAL_BOUNDS
from plantflow.functions import columns as fn
from plantflow.operators import skew
from plantflow.session import group_rows

Bounds = Mapping[str, tuple[float, float]]


def cleaned(flagged: DataFrame) -> DataFrame:
    """The cleaned table without the repair flags."""
    return flagged.drop(*[c for c in flagged.columns if c.startswith("_")])


def drop_exact_duplicates(df: DataFrame, copies: str = "_copies") -> DataFrame:
    """One row per distinct row; `copies` says how many there were."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def placed_by(df: DataFrame, key: str, hot: bool) -> DataFrame:
    """The rows in one task a key, unless a key is too large for one: all groups that hold the key then move nothing."""
    return df if hot else df.repartition(F.col(key))


def with_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add a digest of the row (of some columns) in two numbers of 64 bits; which fields are missing counts as well."""
    fields = [F.col(c) for c in columns or df.columns]
    missing = F.concat(*[c.isNull().cast("int").cast("string") for c in fields])
    return df.withColumns({"_digest": F.xxhash64(missing, *fields), "_digest2": F.xxhash64(*fields, missing, F.lit(1))})


def drop_repeats(df: DataFrame, key: str, ts: str, copies: str = "_copies") -> DataFrame:
    """`drop_exact_duplicates` for rows placed by `key`: repeats lie side by side in the order that later windows need."""
    marked = with_digest(df)
    alike = W.partitionBy(key, ts, "_digest", "_digest2")
    instant = W.partitionBy(key, ts).orderBy("_digest", "_digest2")
    repeated = (F.lag("_digest").over(instant) == F.col("_digest")) & (F.lag("_digest2").over(instant) == F.col("_digest2"))
    counted = marked.withColumn(copies, F.count(F.lit(1)).over(alike))
    return counted.withColumn("_again", F.coalesce(repeated, F.lit(False))).filter(~F.col("_again")).drop("_again", "_digest2")


def null_outside_bounds(df: DataFrame, bounds: Bounds = PHYSICAL_BOUNDS) -> DataFrame:
    """Null impossible readings and flag them in `_glitch_<channel>`."""
    flags = {f"_glitch_{c}": fn.outside(c, *b) for c, b in bounds.items() if c in df.columns}
    kept = {c: fn.within(c, *b) for c, b in bounds.items() if c in df.columns}
    return df.withColumns(flags).withColumns(kept)


def fill_short_gaps(
    df: DataFrame,
    columns: Sequence[str] = CHANNELS,
    key: str = "machine_id",
    ts: str = "timestamp",
    limit: int = GAP_READINGS,
    only: Column | None = None,
    hot: bool | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Carry the last reading forward, then the next one backward, over at most `limit` rows.

    The windows look `limit` rows either way, so a machine with very many
    readings is cut into time segments. Readings at one instant come in the order
    of the column `tie`, or of a hash of the row, whatever the partitioning.
    """

    def fill(frame: DataFrame, group: list[str]) -> DataFrame:
        rows = W.partitionBy(*group).orderBy(ts, F.col(tie) if tie else F.xxhash64(*[c for c in df.columns if c != ts]))
        back, ahead = rows.rowsBetween(-limit, 0), rows.rowsBetween(0, limit)
        filled = {}
        for c in columns:
            value = F.coalesce(
                F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead)
            )
            filled[c] = value if only is None else F.when(only, value).otherwise(F.col(c))
        return frame.withColumns(filled)

    return skew.over_segments(df, [key], ts, fill, before=limit, after=limit, hot=hot)


def with_group_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str], hot: bool | None = None) -> DataFrame:
    """Add `_median_<column>`, the exact median of the row's group; NULL for a row without a key."""
    keys = list(keys)
    if hot is None:
        hot = skew.has_hot_group(df, keys)
    if not hot:
        group = W.partitionBy(*keys)
        keyed = F.lit(True)
        for k in keys:
            keyed = keyed & F.col(k).isNotNull()
        return df.withColumns({f"_median_{c}": F.when(keyed, F.median(c).over(group)) for c in columns})
    medians = skew.exact_quantiles(df, keys, columns, [0.5], hot=True)
    named = medians.select(*keys, *[F.element_at(c, 1).alias(f"_median_{c}") for c in columns])
    return df.join(skew.checked_broadcast(named), keys, "left")


def flag_sensor(
    raw: DataFrame,
    bounds: Bounds = PHYSICAL_BOUNDS,
    gap: int = GAP_READINGS,
    running_only: bool = False,
    hot: bool | None = None,
) -> DataFrame:
    """Cleaned sensor readings with repair flags.

    Order matters: labels and times first, then duplicates, then bounds, then
    gaps. By default gap filling covers every status, so a DOWN period keeps
    only the nulls further than `gap` readings from its edges; `running_only`
    leaves all DOWN nulls alone.
    """
    if hot is None:
        hot = skew.has_hot_group(raw, ["machine_id"])
    channels = [c for c in bounds if c in raw.columns]
    typed = raw.withColumns(
        {
            "machine_type": fn.normalise_label("machine_type"),
            "operating_status": fn.normalise_label("operating_status"),
            "timestamp": fn.lenient_timestamp("timestamp"),
            **{c: fn.lenient_double(c) for c in channels},
        }
    ).filter(F.col("timestamp").isNotNull())

    running = F.col("operating_status") == "RUNNING"
    if hot:
        distinct = with_digest(drop_exact_duplicates(typed), typed.columns).drop("_digest2")
    else:
        distinct = drop_repeats(placed_by(typed, "machine_id", hot), "machine_id", "timestamp")
    bounded = null_outside_bounds(distinct, {c: bounds[c] for c in channels})
    gaps = bounded.withColumns({f"_gap_{c}": running & F.col(c).isNull() for c in channels})
    filled = fill_short_gaps(gaps, channels, limit=gap, only=running if running_only else None, hot=hot, tie="_digest")
    medians = with_group_median(filled, ["machine_id"], channels, hot=hot)
    return medians.withColumns(
        {c: F.when(running & F.col(c).isNull(), F.col(f"_median_{c}")).otherwise(F.col(c)) for c in channels}
    )


def clean_sensor(raw: DataFrame, **options) -> DataFrame:
    return cleaned(flag_sensor(raw, **options))


def flag_production(raw: DataFrame, hot: bool | None = None) -> DataFrame:
    """Cleaned production rows with repair flags; a row with a bad date stays, with a NULL date.

    Negative counts become the median of their machine and shift, which is
    taken over all rows, the negative ones included.
    """
    if hot is None:
        hot = skew.has_hot_group(raw, ["machine_id"])
    typed = raw.withColumns(
        {
            "machine_type": fn.normalise_label("machine_type"),
            "operating_status": fn.normalise_label("operating_status"),
            "date": fn.lenient_date("date"),
            "production_count": fn.lenient_double("production_count"),
            "quality_score": fn.lenient_double("quality_score"),
        }
    )
    distinct = drop_exact_duplicates(placed_by(typed, "machine_id", hot))
    counts = with_group_median(distinct, ["machine_id", "shift"], ["production_count"], hot=hot)
    both = with_group_median(counts, ["machine_id"], ["quality_score"], hot=hot)
    negative = F.coalesce(F.col("production_count") < 0, F.lit(False))
    return both.withColumns({"_fixed_count": negative, "_no_quality": F.col("quality_score").isNull()}).withColumns(
        {
            "production_count": F.bround(
                F.when(F.col("_fixed_count"), F.col("_median_production_count")).otherwise(F.col("production_count")), 0
            ).cast("bigint"),
            "quality_score": F.coalesce("quality_score", "_median_quality_score"),
        }
    )


def clean_production(raw: DataFrame, **options) -> DataFrame:
    return cleaned(flag_production(raw, **options))


def flag_maintenance(raw: DataFrame) -> DataFrame:
    """Cleaned maintenance events with repair flags."""
    timed = raw.withColumn("timestamp", fn.lenient_timestamp("timestamp")).filter(F.col("timestamp").isNotNull())
    distinct = drop_exact_duplicates(timed).withColumn("_no_urgency", F.col("urgency").isNull())
    return distinct.withColumn("urgency", F.coalesce("urgency", F.lit("Unknown")))


def clean_maintenance(raw: DataFrame) -> DataFrame:
    return cleaned(flag_maintenance(raw))


def iqr_outliers(df: DataFrame, columns: Sequence[str] = OUTLIER_CHANNELS, hot: bool | None = None) -> DataFrame:
    """Values beyond 1.5 interquartile ranges, per column: `(column, lower, upper, outliers)`."""
    columns = list(columns)
    quartiles = skew.exact_quantiles(df, [], columns, [0.25, 0.75], hot=hot)
    fences = {}
    for c in columns:
        q1, q3 = F.element_at(c, 1), F.element_at(c, 2)
        fences[c] = F.struct((q1 - 1.5 * (q3 - q1)).alias("lower"), (q3 + 1.5 * (q3 - q1)).alias("upper"))
    limits = quartiles.select(F.struct(*[f.alias(c) for c, f in fences.items()]).alias("f"))
    fenced = df.select(*columns).withColumn("_f", limits.scalar())
    counts = fenced.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.first(f"_f.{c}.lower").alias("lower"),
                F.first(f"_f.{c}.upper").alias("upper"),
                F.count_if(fn.outside(c, F.col(f"_f.{c}.lower"), F.col(f"_f.{c}.upper"))).alias("outliers"),
            ).alias(c)
            for c in columns
        ]
    )
    return counts.select(F.inline(F.array(*columns)))


# --- ledgers --------------------------------------------------------------

Entry = tuple[str, str | None, Column]  # rule, column, aggregate


def _entries(df: DataFrame, table: str, entries: Sequence[Entry]) -> DataFrame:
    """Aggregate many counters in one pass and list them as rows."""
    counts = df.agg(*[F.coalesce(value, F.lit(0)).cast("bigint").alias(f"n{i}") for i, (_, _, value) in enumerate(entries)])
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(rule).alias("rule"),
            F.lit(column).cast("string").alias("column"),
            F.col(f"n{i}").alias("n"),
        )
        for i, (rule, column, _) in enumerate(entries)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _row_counts(flagged_copies: str = "_copies") -> list[Entry]:
    return [
        ("rows_dropped_exact_duplicate", None, F.sum(F.col(flagged_copies) - 1)),
        ("rows_after", None, F.count(F.lit(1))),
    ]


def _before(table: str) -> list[Entry]:
    """Counters over the raw rows of a table."""
    rows = [("rows_before", None, F.count(F.lit(1)))]
    if table == "sensor":
        rows.append(("rows_dropped_malformed_timestamp", None, F.count_if(fn.lenient_timestamp("timestamp").isNull())))
    return rows


def _after(table: str, flagged: DataFrame) -> list[Entry]:
    """Counters over the flagged rows of a table."""
    if table == "production":
        return _row_counts() + [
            ("invalid_production_count_fixed", "production_count", F.count_if("_fixed_count")),
            ("quality_score_imputed", "quality_score", F.count_if("_no_quality")),
        ]
    if table == "maintenance":
        return _row_counts() + [("urgency_marked_unknown", "urgency", F.count_if("_no_urgency"))]
    channels = [c.removeprefix("_glitch_") for c in flagged.columns if c.startswith("_glitch_")]
    idle = ~F.coalesce(F.col("operating_status") == "RUNNING", F.lit(False))
    preserved = sum((F.count_if(idle & F.col(c).isNull()) for c in channels[1:]), F.count_if(idle & F.col(channels[0]).isNull()))
    return (
        _row_counts()
        + [("physically_invalid_values_nulled", c, F.count_if(f"_glitch_{c}")) for c in channels]
        + [("running_state_values_imputed", c, F.count_if(F.col(f"_gap_{c}") & F.col(c).isNotNull())) for c in channels]
        + [("down_state_missing_preserved", None, preserved)]
    )


def _outlier_entries(clean: DataFrame, outliers: Sequence[str], hot: bool | None = None) -> DataFrame:
    return iqr_outliers(clean, [c for c in outliers if c in clean.columns], hot).select(
        F.lit("sensor").alias("table"),
        F.lit("iqr_outliers_detected_and_kept").alias("rule"),
        "column",
        F.col("outliers").alias("n"),
    )


def sensor_ledger(raw: DataFrame, flagged: DataFrame, outliers: Sequence[str] = OUTLIER_CHANNELS) -> DataFrame:
    """Long `(table, rule, column, n)` record of what sensor cleaning did."""
    counted = _entries(raw, "sensor", _before("sensor")).unionByName(_entries(flagged, "sensor", _after("sensor", flagged)))
    return counted.unionByName(_outlier_entries(cleaned(flagged), [c for c in outliers if f"_glitch_{c}" in flagged.columns]))


def production_ledger(raw: DataFrame, flagged: DataFrame) -> DataFrame:
    return _entries(raw, "production", _before("production")).unionByName(_entries(flagged, "production", _after("production", flagged)))


def maintenance_ledger(raw: DataFrame, flagged: DataFrame) -> DataFrame:
    return _entries(raw, "maintenance", _before("maintenance")).unionByName(_entries(flagged, "maintenance", _after("maintenance", flagged)))


def clean_and_record(table: str, raw: DataFrame, path: str, outliers: Sequence[str] = OUTLIER_CHANNELS) -> tuple[DataFrame, DataFrame]:
    """Clean a raw table (`sensor`, `production` or `maintenance`) into Parquet at `path`: the written table and its ledger.

    Repairs are counted by the tasks that write the rows, so flagged rows are neither kept nor read again; such counts
    are taken once a written part, also if a task is repeated. Raw rows are counted in the job that looks for large
    machines, before the write, since counts taken above an exchange could be taken twice when an executor is lost.
    Outliers need the quartiles of the cleaned values; they are read from the written columns.

    In Spark 4.1 a session that has counted this way cannot score with a logistic or forest model that was fitted in
    the session and not read back, since its training summary holds the session; `models.fit` reads its models back.
    """
    spark = raw.sparkSession
    before = _before(table)
    names = [f"n{i}" for i in range(len(before))]
    counted = [value.alias(n) for n, (_, _, value) in zip(names, before)]
    if table == "maintenance":
        found = raw.agg(*counted).first()
        flagged = flag_maintenance(raw)
    else:
        sizes = raw.groupBy("machine_id").agg(F.count(F.lit(1)).alias("_n"), *counted)
        found = sizes.agg(F.max("_n").alias("_most"), *[F.sum(n).alias(n) for n in names]).first()
        hot = (found["_most"] or 0) > group_rows(spark)
        flagged = flag_sensor(raw, hot=hot) if table == "sensor" else flag_production(raw, hot=hot)
    entries = [(table, rule, column, int(found[n] or 0)) for n, (rule, column, _) in zip(names, before)]

    after, seen = _after(table, flagged), Observation()
    metrics = [F.coalesce(value, F.lit(0)).cast("bigint").alias(f"n{i}") for i, (_, _, value) in enumerate(after)]
    cleaned(flagged.observe(seen, *metrics)).write.mode("overwrite").parquet(path)
    entries += [(table, rule, column, int(seen.get[f"n{i}"] or 0)) for i, (rule, column, _) in enumerate(after)]

    written = spark.read.schema(cleaned(flagged).schema).parquet(path)
    ledger = spark.createDataFrame(entries, "table string, rule string, column string, n bigint")
    if table == "sensor":
        ledger = ledger.unionByName(_outlier_entries(written, [c for c in outliers if f"_glitch_{c}" in flagged.columns]))
    return written, ledger
