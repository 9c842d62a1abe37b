"""Readers of raw tables, record files, page text and split tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plantflow.functions import columns as fn
from plantflow.session import durable
from plantflow.sources import folders, ranges, schema as sc
from plantflow.sources.sinks import path_exists

# File names of the raw tables in a raw folder.
RAW_FILES = {
    "raw_sensor_data": sc.SENSOR_SCHEMA,
    "raw_production_data": sc.PRODUCTION_SCHEMA,
    "raw_maintenance_data": sc.MAINTENANCE_SCHEMA,
}
LABELS = {"normal": 0, "defect": 1}
# Words that stand for a missing value, as pandas reads them.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV table with a header, written as spreadsheets and pandas do: quotes inside quotes are doubled.

    Columns are taken by name; without a schema all are text. Words for a missing
    value become NULL. With `multi_line` quoted text may hold line breaks; such files
    are read by ranges as well (`ranges`), unless a quote stands in the middle of a
    field without being doubled: then the file is read by one task.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Expected data file not found: {path}")
    if multi_line and not ranges.stray_quotes(spark, path):
        found = ranges.read_quoted_csv(spark, path)
    else:
        text = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        found = text.csv(path)
    found = found.select(*[F.when(~F.trim(f"`{c}`").isin(MISSING_WORDS), F.col(f"`{c}`")).alias(c) for c in found.columns])
    if schema is None:
        return found
    return found.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name in found.columns])


FREE_TEXT = {"raw_maintenance_data"}  # tables whose text may hold line breaks


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw table: every column as text, then typed leniently, then the quality gate."""
    kinds: Mapping[str, str] = RAW_FILES[name]
    text = read_csv(spark, f"{folder}/{name}.csv", multi_line=name in FREE_TEXT)
    sc.validate_schema(text, kinds, name)
    return sc.typed(text, kinds)


def read_raw_sensor(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, folder, "raw_sensor_data")


def read_raw_production(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, folder, "raw_production_data")


def read_raw_maintenance(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, folder, "raw_maintenance_data")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records from JSON array files; a missing or unreadable file gives no rows.

    Files are read by ranges, so one large array is many tasks. A record with a field
    of another type keeps its other fields. `unreadable_records` counts what could not
    be read in full.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = ranges.read_json_objects(spark, path, kinds, CORRUPT)
    names = [c for c in rows.columns if c != CORRUPT]
    nothing = F.col(CORRUPT).isNotNull() & (F.size(F.array_compact(F.array(*[F.col(f"`{c}`").cast("string") for c in names]))) == 0)
    return rows.filter(~nothing).drop(CORRUPT)


def unreadable_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """How many records stand in files of which not all could be read, as `(path, n)`; such a file's records all count."""
    rows = _with_corrupt(spark, path, schema)
    return rows.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("n")).select(F.lit(path).alias("path"), "n")


def _with_corrupt(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    asked = T.StructType([*kinds.fields, T.StructField(CORRUPT, T.StringType())])
    read = spark.read.schema(asked).option("multiLine", True).option("mode", "PERMISSIVE")
    return durable(read.option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits of a table written by `write_splits`; a filter on `split` reads only its folder."""
    return spark.read.parquet(path)


def union_splits(*splits: DataFrame) -> DataFrame:
    """Separate split tables as one."""
    whole = splits[0]
    for other in splits[1:]:
        whole = whole.unionByName(other)
    return whole


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages that hold any text."""
    return pages.filter(F.col("text").rlike(fn.NOT_BLANK))


def _page_file_bytes(spark: SparkSession, block: folders.Block) -> DataFrame:
    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).load(block.paths)
    name = F.array_join(F.slice(F.split("path", "/"), -block.depth, block.depth), "/")
    return files.select(name.alias("document"), F.col("content").cast("string").alias("content"))


def read_page_files(spark: SparkSession, path: str, columns: Sequence[Column | str] = ("document", "page", "text")) -> DataFrame:
    """Page text from text files, one file per document, pages separated by form feeds.

    A file in a folder `key=value` below is named with that folder. Files that are not text (see `unreadable_page_files`)
    are skipped; it is an error if nothing usable is left. If there are more files than the driver lists at once, what is
    read is stored (`folders`): then `columns`, made of document, page and text, says what is needed of each page.
    """

    def read(session: SparkSession, block: folders.Block) -> DataFrame:
        files = _page_file_bytes(session, block).filter(F.is_valid_utf8("content"))
        numbered = files.select("document", F.posexplode(F.split("content", "\f")).alias("page", "text"))
        return usable_pages(numbered.withColumn("page", F.col("page") + 1)).select(*columns)

    pages = folders.read_blocks(spark, path, read)
    if not pages.select(F.lit(1)).head(1):  # reads on only until a page is found
        raise ValueError(f"no document in {path} has usable text")
    return pages


def unreadable_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file that `read_page_files` leaves out, with the reason: not text in UTF-8, or without any text."""
    reason = F.when(~F.is_valid_utf8("content"), "not text in UTF-8").when(~F.col("content").rlike(fn.NOT_BLANK), "no text")

    def read(session: SparkSession, block: folders.Block) -> DataFrame:
        return _page_file_bytes(session, block).select("document", reason.alias("reason")).filter("reason IS NOT NULL")

    return folders.read_blocks(spark, path, read)


def labelled_assets(metadata: DataFrame, split: str | None = None) -> DataFrame:
    """Asset metadata `(image_path, label, machine_id, split)` with the numeric class."""
    codes = F.create_map(*[F.lit(v) for pair in LABELS.items() for v in pair])
    coded = metadata.withColumn("label_code", F.try_element_at(codes, F.col("label")))
    return coded if split is None else coded.filter(F.col("split") == split)
