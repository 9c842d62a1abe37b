"""Group operations that stay whole when one group holds a large share of all rows.

A window, a median or a running total needs its group together. These helpers
first measure the groups with a counting aggregate (partial counts on the map
side). When every group fits one task, the plain Spark expression is used. When
one does not, the group is cut into pieces of bounded size that are solved on
their own and put together through small per-piece totals. Results are equal,
also for a group whose key is NULL, which is a group like any other here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType

from plantflow.session import broadcast_bytes, broadcast_rows, durable, group_rows


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group: one counting job over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def has_hot_group(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any group has more rows than one task should hold."""
    return largest_group(df, keys) > group_rows(df.sparkSession)


def _field_bytes(name: str, kind: DataType) -> Column:
    """About the bytes that a value takes in memory."""
    own = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(own)
    elif isinstance(kind, ArrayType) and not isinstance(kind.elementType, (StringType, BinaryType, ArrayType)):
        size = 8 * F.greatest(F.size(own), F.lit(0))
    elif isinstance(kind, ArrayType):
        size = F.octet_length(F.to_json(own))
    else:
        size = F.lit(0)
    return F.lit(16) + F.coalesce(size, F.lit(0)).cast("bigint")


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Materialise a side table; hint a broadcast only when its rows and bytes are within the bounds."""
    table = durable(df)
    size = reduce(Column.__add__, [_field_bytes(f.name, f.dataType) for f in table.schema])
    rows, held = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    fits = rows <= broadcast_rows(df.sparkSession) and held <= broadcast_bytes(df.sparkSession)
    return F.broadcast(table) if fits else table


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a table of groups to rows by their keys, where NULL is a key as well."""
    named = {k: f"_right_{i}" for i, k in enumerate(keys)}
    hinted = right.withColumnsRenamed(named)
    if not named:
        return left.join(hinted, how=how)
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in named.items()])
    return left.join(hinted, same, how).drop(*named.values())


def time_bucket(rows: DataFrame, keys: Sequence[str], limit: int, seconds: int = 3600) -> Callable[[Column], Column]:
    """Time buckets, at most `seconds` wide, that hold at most `limit` rows of a key; or one instant each."""
    width = seconds * 1_000_000
    while True:
        place = F.floor(F.col("_us") / F.lit(width))
        largest = rows.groupBy(*keys, place.alias("_place")).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
        if width == 1 or (largest or 0) <= limit:
            return lambda us: F.floor(us / F.lit(width))
        width = max(1, width // 60)


def over_segments(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    body: Callable[[DataFrame, list[str]], DataFrame],
    before: int = 0,
    after: int = 0,
    bucket_seconds: int = 3600,
    hot: bool | None = None,
) -> DataFrame:
    """Run row windows of bounded reach per key, cutting large keys into time segments.

    `body(frame, group)` adds window columns partitioned by `group`; a row may
    depend on at most `before` earlier and `after` later rows in `ts` order.
    A segment is a run of whole time buckets with about one task's worth of
    rows. It gets a copy of the neighbouring buckets that hold those rows, and
    the copies are dropped after the windows. Buckets are made as narrow as a
    burst needs, down to one instant.
    """
    keys = list(keys)
    if hot is None:
        hot = has_hot_group(df, keys)
    if not hot:
        return body(df, keys)

    limit = group_rows(df.sparkSession)
    bucket = time_bucket(df.select(*keys, F.unix_micros(ts).alias("_us")), keys, limit, bucket_seconds)(F.unix_micros(ts))
    by_bucket = W.partitionBy(*keys).orderBy("_bucket")
    layout = (
        df.groupBy(*keys, bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(by_bucket))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(W.partitionBy(*keys)))
        .filter(F.col("_total") > limit)
        .withColumn("_own", F.floor(F.col("_start") / limit))
        .withColumn("_prev", F.lag("_own").over(by_bucket))
        .withColumn("_next", F.lead("_own").over(by_bucket))
        .withColumn("_opens", F.when(~F.col("_own").eqNullSafe(F.col("_prev")), F.col("_own")))
        .withColumn("_closes", F.when(~F.col("_own").eqNullSafe(F.col("_next")), F.col("_own")))
    )
    # A bucket is copied forward to the segments that open within `before` rows
    # of its end, and backward to those that close within `after` rows of its start.
    needs = [F.array("_own")]
    if before:
        reach = W.partitionBy(*keys).orderBy("_start").rangeBetween(0, before - 1)
        layout = layout.withColumn("_opening", F.collect_set("_opens").over(reach)).withColumn(
            "_forward", F.lead("_opening").over(by_bucket)
        )
        needs.append(F.coalesce("_forward", F.array().cast("array<bigint>")))
    if after:
        reach = W.partitionBy(*keys).orderBy("_end").rangeBetween(-(after - 1), 0)
        layout = layout.withColumn("_closing", F.collect_set("_closes").over(reach)).withColumn(
            "_backward", F.lag("_closing").over(by_bucket)
        )
        needs.append(F.coalesce("_backward", F.array().cast("array<bigint>")))
    places = layout.select(*keys, "_bucket", "_own", F.array_distinct(F.concat(*needs)).alias("_segments"))

    tagged = (
        df.withColumn("_bucket", bucket)
        .transform(lambda rows: join_groups(rows, checked_broadcast(places), [*keys, "_bucket"], "left"))
        .withColumn("_own", F.coalesce("_own", F.lit(0).cast("bigint")))
        .withColumn("_segment", F.explode(F.coalesce("_segments", F.array(F.lit(0).cast("bigint")))))
    )
    done = body(tagged, [*keys, "_segment"])
    return done.filter(F.col("_segment") == F.col("_own")).drop("_bucket", "_own", "_segments", "_segment")


def _with_bins(df: DataFrame, groups: list[str], order: str) -> DataFrame | None:
    """Give every row of a large group one of many evenly filled value bins; None if no group is large.

    The number of bins follows the measured size of the largest group, so that
    a bin fits one task.
    """
    limit = group_rows(df.sparkSession)
    largest = largest_group(df, groups)
    if largest <= limit:
        return None
    bins = 16
    while bins * limit < 2 * largest:
        bins *= 2
    df = durable(df)  # read four times from here on
    shares = [i / bins for i in range(1, bins)]
    sketch = (
        df.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(order, shares, 10 * bins).alias("_cuts"))
        .filter(F.col("_n") > limit)
        .select(*groups, F.array_distinct("_cuts").alias("_cuts"))
    )
    # The sketch is materialised: both users of the bins must see the same cuts.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bins.bit_length()))])

    def descend(place: Column, step: Column) -> Column:
        reachable = place + step <= F.size("_cuts")
        cut = F.try_element_at(F.col("_cuts"), place + step)
        return F.when(reachable & (cut <= F.col(order)), place + step).otherwise(place)

    return (
        join_groups(df, checked_broadcast(sketch), groups, "left")
        .withColumn("_bin", F.when(F.col("_cuts").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), descend)))
        .drop("_cuts")
    )


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    amounts: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add `<amount>_upto` (running total including the row) and `<amount>_all` per group.

    `order` must be unique within a group (aggregate to distinct values first).
    Large groups are summed in two levels: inside value bins, then over bin totals.
    """
    groups = list(groups)
    binned = _with_bins(df, groups, order)
    towards = F.col(order).desc() if descending else F.col(order).asc()
    if binned is None:
        running = W.partitionBy(*groups).orderBy(towards).rowsBetween(W.unboundedPreceding, 0)
        whole = W.partitionBy(*groups)
        for a in amounts:
            df = df.withColumn(f"{a}_upto", F.sum(a).over(running)).withColumn(f"{a}_all", F.sum(a).over(whole))
        return df

    inside = W.partitionBy(*groups, "_bin").orderBy(towards).rowsBetween(W.unboundedPreceding, 0)
    bins = binned.groupBy(*groups, "_bin").agg(*[F.sum(a).alias(f"_{a}_bin") for a in amounts])
    bin_order = F.col("_bin").desc() if descending else F.col("_bin").asc()
    earlier = W.partitionBy(*groups).orderBy(bin_order).rowsBetween(W.unboundedPreceding, -1)
    for a in amounts:
        bins = bins.withColumn(f"_{a}_before", F.coalesce(F.sum(f"_{a}_bin").over(earlier), F.lit(0)))
        bins = bins.withColumn(f"{a}_all", F.sum(f"_{a}_bin").over(W.partitionBy(*groups)))
        binned = binned.withColumn(f"_{a}_in", F.sum(a).over(inside))
    joined = join_groups(binned, bins.drop(*[f"_{a}_bin" for a in amounts]), [*groups, "_bin"])
    for a in amounts:
        joined = joined.withColumn(f"{a}_upto", F.col(f"_{a}_in") + F.col(f"_{a}_before"))
    return joined.drop("_bin", *[f"_{a}_in" for a in amounts], *[f"_{a}_before" for a in amounts])


SKETCH = 1_000  # a quantile sketch is off by at most one in so many ranks


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], shares: Sequence[float], hot: bool | None = None
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per group, one `array<double>` per column.

    Groups that fit a task use `percentile`, which holds their distinct values; a larger one is selected by bracket.
    """
    groups, columns = list(groups), list(columns)
    if hot is None:
        hot = has_hot_group(df, groups)
    if not hot:
        wanted = F.array(*[F.lit(float(s)) for s in shares])
        return df.groupBy(*groups).agg(*[F.percentile(c, wanted).alias(c) for c in columns])
    return bracket_quantiles(df, groups, columns, shares)


def bracket_quantiles(df: DataFrame, groups: Sequence[str], columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """The same by selection, whatever the size of a group.

    A sketch of fixed size, merged over tasks, gives two values between which each wanted rank must lie. Then only
    values inside the bracket are kept, with their counts; all below it are one count. No task holds more of a group
    than a few thousandths of its distinct values.
    """
    groups, columns = list(groups), list(columns)
    keys = [f"_k{i}" for i in range(max(1, len(groups)))]  # without groups, all rows are one
    named = [F.col(f"`{g}`").alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias("_k0")]
    base = df.select(*named, *[F.col(f"`{c}`").cast("double").alias(f"_c{j}") for j, c in enumerate(columns)])

    reach = 4.0 / SKETCH
    around = [share for s in shares for share in (max(0.0, s - reach), min(1.0, s + reach))]

    def sketch(j: int) -> Column:
        value = f"_c{j}"
        cuts = F.percentile_approx(value, [float(x) for x in around], SKETCH)
        return F.struct(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), cuts.alias("cuts")).alias(f"_s{j}")

    def brackets(j: int) -> Column:
        of = F.col(f"_s{j}")
        sides = []
        for i, s in enumerate(shares):
            whole = of["n"] <= SKETCH  # few values: all of them
            low = F.when(whole | F.lit(s <= reach), of["low"]).otherwise(F.get(of["cuts"], 2 * i))
            high = F.when(whole | F.lit(s >= 1.0 - reach), of["high"]).otherwise(F.get(of["cuts"], 2 * i + 1))
            sides.append(F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), of["n"].alias("n")))
        return F.array(*sides)

    sketches = durable(base.groupBy(*keys).agg(*[sketch(j) for j in range(len(columns))]))
    limits = sketches.select(*keys, *[brackets(j).alias(f"_b{j}") for j in range(len(columns))])
    met = join_groups(base, checked_broadcast(limits), keys)
    tall = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"_c{j}").alias("v"), F.col(f"_b{j}").alias("b")) for j in range(len(columns))])
    values = met.select(*keys, F.explode(tall).alias("_t")).filter(F.col("_t.v").isNotNull())
    value = F.col("_t.v")
    # for each bracket: the value inside it, NULL for one below it
    sides = [F.col("_t.b")[i] for i in range(len(shares))]
    seen = [F.when(value <= b["high"], F.struct(b["i"].alias("i"), b["n"].alias("n"), F.when(value >= b["low"], value).alias("v"))) for b in sides]
    counted = durable(
        values.select(*keys, F.col("_t.j").alias("_j"), F.explode(F.array(*seen)).alias("_e"))
        .filter(F.col("_e").isNotNull())
        .groupBy(*keys, "_j", F.col("_e.i").alias("_i"), F.col("_e.v").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_m"), F.max("_e.n").alias("_n"))
    )
    ranked = running_totals(counted, [*keys, "_j", "_i"], "_v", ["_m"])
    place = F.get(F.lit([float(s) for s in shares]), F.col("_i")) * (F.col("_n") - 1)
    first, last = F.col("_m_upto") - F.col("_m"), F.col("_m_upto")
    at = lambda rank: F.max(F.when((first <= rank) & (rank < last), F.col("_v")))
    low, high = F.floor(place), F.ceil(place)
    found = ranked.groupBy(*keys, "_j", "_i").agg(
        at(low).alias("_low"), at(high).alias("_high"), F.max(high - place).alias("_above"), F.max(place - low).alias("_below")
    )
    # the formula of `percentile`
    between = F.col("_above") * F.col("_low") + F.col("_below") * F.col("_high")
    lost = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    pick = F.when(F.col("_low").isNull() | F.col("_high").isNull(), lost).when((F.col("_above") == 0) & (F.col("_below") == 0), F.col("_low"))
    picked = found.withColumn("_q", pick.otherwise(between))

    def of_column(j: int) -> Column:
        each = [F.max(F.when((F.col("_j") == j) & (F.col("_i") == i), F.col("_q"))) for i in range(len(shares))]
        return F.when(F.max(F.when(F.col("_j") == j, True)), F.array(*each)).alias(columns[j])

    wide = picked.groupBy(*keys).agg(*[of_column(j) for j in range(len(columns))])
    # a group without any value is a row of NULLs, and so is a table without rows
    if not groups:
        return wide.agg(*[F.first(f"`{c}`").alias(c) for c in columns])
    every = join_groups(sketches.select(*keys), wide, keys, "left")
    return every.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], *[f"`{c}`" for c in columns])


def numbered(df: DataFrame, groups: Sequence[str], bucket: Column, order: Sequence[Column], name: str = "number") -> DataFrame:
    """Row number per group in two levels, plus the group's size as `<name>_of`.

    `bucket` must rise with the order and fill evenly (for example the leading
    digits of a hash); rows are sorted only inside a bucket.
    """
    groups = list(groups)
    placed = df.withColumn("_bucket", bucket)
    inside = W.partitionBy(*groups, "_bucket").orderBy(*order)
    earlier = W.partitionBy(*groups).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = (
        placed.groupBy(*groups, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn(f"{name}_of", F.sum("_n").over(W.partitionBy(*groups)))
        .drop("_n")
    )
    return (
        join_groups(placed.withColumn("_in", F.row_number().over(inside)), sizes, [*groups, "_bucket"])
        .withColumn(name, F.col("_in") + F.col("_before"))
        .drop("_bucket", "_in", "_before")
    )
