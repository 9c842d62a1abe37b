"""Records of large files whose ends a byte range cannot see: CSV with line breaks in quotes, JSON arrays.

Spark reads such a file by byte ranges, as text cut at a separator: a line break for CSV, a closing brace for JSON.
Whether a piece stands inside quotes, and how many braces are open before it, follows from sums over the pieces in
front of it. These are taken in two levels: a running sum inside each range, and a running sum over the totals of the
ranges of a file, one row each. With them every range knows at which of its pieces a record truly begins, and strings
its own records together; only what crosses the end of a range meets in another task, at most two rows a range.

The pieces are written once, so that both levels see the same ranges even if executors come and go in between.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, WindowSpec, functions as F, types as T

from plantflow.session import durable, stored

RANGE = ["file", "block"]


def _in_range(last: int = -1) -> WindowSpec:
    """The pieces of a range up to one."""
    return W.partitionBy(*RANGE).orderBy("n").rowsBetween(W.unboundedPreceding, last)


def _in_file() -> WindowSpec:
    """The ranges of a file in front of one."""
    return W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)


def _pieces(spark: SparkSession, path: str, separator: str, measures: Mapping[str, Column]) -> DataFrame:
    """Text between separators as `(file, block, n, value, …measures)`: its file, the range that read it, its order there."""
    found = spark.read.option("lineSep", separator).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    read = found.select(*place, F.monotonically_increasing_id().alias("n"), "value")
    return stored(read.withColumns(dict(measures)), "pieces")


def _before(of: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(of).over(window), F.lit(0))


def _carried(pieces: DataFrame, amount: str, name: str) -> DataFrame:
    """Add `name`: the sum of `amount` over all pieces of the file in front of the piece."""
    totals = pieces.groupBy(*RANGE).agg(F.sum(amount).alias("_all"))
    starts = durable(totals.select(*RANGE, _before("_all", _in_file()).alias("_start")))  # one row a range
    inside = pieces.withColumn("_inside", _before(amount, _in_range()))
    return inside.join(starts, RANGE).withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside")


def _records(pieces: DataFrame, separator: str) -> DataFrame:
    """Pieces strung together from each that `opens` a record to the next: `(file, block, number, record)`.

    Block and number say where the record begins; pieces of a file before its first record are left out.
    """
    numbered = pieces.withColumn("number", F.sum(F.col("opens").cast("int")).over(_in_range(0)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda p: p["value"]), separator)
    parts = numbered.groupBy(*RANGE, "number").agg(text.alias("record"))

    # the last record of a range may go on in ranges behind it, whose head (number 0) then belongs to it
    sums = numbered.groupBy(*RANGE).agg(F.max("number").alias("last"), F.min("number").alias("low"))
    opened = F.when(F.col("last") > 0, F.struct("block", F.col("last").alias("number")))
    ranges = durable(sums.select(*RANGE, "last", "low", F.last(opened, ignorenulls=True).over(_in_file()).alias("owner")))
    met = parts.join(ranges.drop("low"), RANGE)
    inner = met.filter((F.col("number") > 0) & (F.col("number") < F.col("last"))).select("file", "block", "number", "record")
    edges = met.filter((F.col("number") == 0) | (F.col("number") == F.col("last"))).filter((F.col("number") > 0) | F.col("owner").isNotNull())
    at = F.when(F.col("number") == 0, F.col("owner")).otherwise(F.struct("block", "number"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), separator)
    joined = edges.select("file", at.alias("at"), "block", "record").groupBy("file", "at").agg(whole.alias("record"))
    return inner.union(joined.select("file", "at.block", "at.number", "record"))


# --- CSV ------------------------------------------------------------------


def _count(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def stray_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a quote stands in the middle of a field without being doubled: sums of quotes then say nothing."""
    lines = spark.read.option("lineSep", "\n").text(path)
    single = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    return not lines.filter(single.rlike(r'[^,\r]"[^,\r]')).limit(1).isEmpty()


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """A comma-separated file with a header, all columns text; quoted text may hold line breaks, quotes are doubled.

    Every file has the header of the first; blank lines are left out.
    """
    lines = _carried(_pieces(spark, path, "\n", {"quotes": _count(F.col("value"), '"')}), "quotes", "before")
    records = _records(lines.withColumn("opens", F.col("before") % 2 == 0), "\n")
    records = stored(records.withColumn("record", F.regexp_replace("record", "\r$", "")).filter(F.trim("record") != ""), "records")
    place = F.struct("block", "number")
    heads = records.groupBy("file").agg(F.min(place).alias("at"), F.min_by("record", place).alias("head"))
    heads = durable(heads)
    header = heads.orderBy("file").first()
    if header is None:
        return spark.createDataFrame([], T.StructType([]))
    if heads.filter(F.col("head") != header["head"]).count():
        raise ValueError(f"files of {path} differ in their headers")
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    width = header["head"].count(",") + 1  # as many as there are names, or more
    fields = ", ".join(f"c{i} string" for i in range(width))
    cut = spark.createDataFrame([(header["head"],)], "record string").select(F.from_csv("record", fields, options).alias("r"))
    names = [n for n in cut.select("r.*").first() if n is not None]
    kinds = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    first = heads.select("file", F.col("at.block").alias("block"), F.col("at.number").alias("number"))
    rows = records.join(F.broadcast(first) if heads.count() <= 10_000 else first, ["file", "block", "number"], "left_anti")
    return rows.select(F.from_csv("record", kinds, options).alias("r")).select("r.*")


# --- JSON -----------------------------------------------------------------


def _braces(text: Column) -> Column:
    """Opening braces outside strings, for text that begins outside one; escapes are gone already."""
    return _count(F.regexp_replace(text, '"[^"]*("|$)', ""), "{")


def read_json_objects(spark: SparkSession, path: str, schema: T.StructType, corrupt: str) -> DataFrame:
    """The outermost objects of JSON files (arrays, or one object after the other), each read by `schema`.

    An object that does not parse is a row of NULLs with its text in the column `corrupt`.
    """
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    measures = {
        "quotes": _count(plain, '"'),
        "opened_outside": _braces(plain),
        "opened_inside": _braces(F.regexp_replace(plain, '^[^"]*("|$)', "")),
    }
    pieces = _carried(_pieces(spark, path, "}", measures), "quotes", "before")
    inside = F.col("before") % 2 == 1
    opened = F.when(inside, F.col("opened_inside")).otherwise(F.col("opened_outside"))
    closed = ((F.col("before") + F.col("quotes")) % 2 == 0).cast("int")  # the brace that ends the piece
    pieces = pieces.withColumn("opened", opened).withColumn("change", opened - closed)
    pieces = _carried(pieces.drop("opened_outside", "opened_inside"), "change", "depth")
    begins = (F.col("depth") <= 0) & (F.col("opened") > 0)
    # what lies between two objects belongs to neither, but a piece without a brace at depth 0 can only be the file's end
    kept = pieces.filter((F.col("depth") > 0) | begins).withColumn("opens", begins)
    records = _records(kept.select(*RANGE, "n", "value", "opens"), "}")
    text = F.concat(F.regexp_replace("record", r"^[^{]*", ""), F.lit("}"))
    asked = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return records.select(F.from_json(text, asked, options).alias("r")).select("r.*")
