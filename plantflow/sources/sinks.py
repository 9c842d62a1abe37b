"""Writers, the append-only audit log and the model registry table."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plantflow.session import files_at_once


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, format: str = "parquet") -> None:
    """Overwrite a table; every task writes a file for each partition value that it holds."""
    writer = df.write.mode("overwrite").format(format)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Train, validation and test rows as one table partitioned by `split`, so that readers prune."""
    write_table(df, path, "split")


def write_text_files(texts: DataFrame, path: str, end: str = "\n", folders: bool = False) -> None:
    """Every row of a one-column table as a text file of its own, all in one folder that does not exist yet.

    Tasks move their own files into place; the driver would move them one by one. With `folders` each task deals its
    files to folders below, named `folder=…`, of as many files as the driver lists at once; these are moved whole.
    """
    if folders:
        number = F.monotonically_increasing_id()  # the task, and in the lower 33 bits the row
        part = F.floor(number.bitwiseAND((1 << 33) - 1) / files_at_once(texts.sparkSession))
        texts = texts.withColumn("folder", F.concat_ws("-", F.shiftright(number, 33), part))
    writer = texts.write.option("maxRecordsPerFile", 1).option("lineSep", end)
    if folders:
        writer.partitionBy("folder").text(path)
    else:
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small result (metrics, ledger, one record per machine) as JSON lines."""
    df.write.mode("overwrite").json(path)


# --- audit log ------------------------------------------------------------


def append_audit(records: DataFrame, path: str, batch: str | None = None) -> bool:
    """Append decision records as JSON lines; existing records are never rewritten.

    With a `batch` name (of a stream's micro-batch, or of a submission that may be sent again) the records are
    written to a folder of that name and moved into the log in one step: a batch that is there already adds nothing,
    and one that failed half-way leaves nothing. Returns whether anything was added.
    """
    writer = records.write.option("ignoreNullFields", False)
    if batch is None:
        writer.mode("append").json(path)
        return True
    spark = records.sparkSession
    paths, own = spark._jvm.org.apache.hadoop.fs.Path, f"_staged-{uuid.uuid4().hex}"
    target, staged = paths(f"{path}/batch={batch}"), paths(path, own)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return False
    writer.json(staged.toString())
    files.rename(staged, target)
    late = paths(target, own)  # where a move ends that comes second; hidden from readers by its name
    if files.exists(late):
        files.delete(late, True)
        return False
    return True


def audit_stream(records: DataFrame, path: str, checkpoint: str, name: str = "stream") -> StreamingQuery:
    """Append a stream of decision records to the log, each micro-batch exactly once even if it is run again."""

    def add(batch: DataFrame, number: int) -> None:
        append_audit(batch, path, f"{name}-{number}")

    return records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_audit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All decision records; no rows when nothing was recorded yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def audit_record(audit: DataFrame, decision_id: str) -> DataFrame:
    return audit.filter(F.col("decision_id") == decision_id)


def audit_for_machine(audit: DataFrame, machine_id: str) -> DataFrame:
    return audit.filter(F.col("original_ai_recommendation.machine_id") == machine_id)


# --- model registry -------------------------------------------------------


def claim(spark: SparkSession, path: str) -> bool:
    """Take a path that no one has taken: true for exactly one of any number of writers at once.

    Every writer moves a folder with a file of its own to the path. A move is atomic where files are (local disks,
    HDFS); one that comes second ends below the first folder, so the writer whose file lies right at the path has it.
    """
    paths, own = spark._jvm.org.apache.hadoop.fs.Path, uuid.uuid4().hex
    target, staged = paths(path), paths(f"{path}.{own}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return False
    files.create(paths(staged, own), False).close()
    files.rename(staged, target)
    return files.exists(paths(target, own))


def register_model(best: DataFrame, registry_path: str, name: str, run_id: str, basis: str) -> DataFrame:
    """Append the chosen model as the next version of a registered name and return the new row.

    A version belongs to the writer that creates its file under `_versions` first, so that writers who register at
    once get different versions; one who loses takes the next number.
    """
    spark = best.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(registry_path).getFileSystem(spark._jsc.hadoopConfiguration())
    version = 1
    if files.exists(paths(registry_path)) and len(files.globStatus(paths(registry_path, "*.parquet"))):
        known = spark.read.parquet(registry_path).filter(F.col("registered_model_name") == name)
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
    digest = hashlib.sha256(name.encode()).hexdigest()[:32]
    while not claim(spark, f"{registry_path}/_versions/{digest}/{version}"):
        version += 1
    row = best.select(
        F.lit(name).alias("registered_model_name"),
        F.col("model").alias("selected_model"),
        F.lit(basis).alias("selection_basis"),
        F.lit(version).alias("version"),
        F.lit(run_id).alias("source_run_id"),
    )
    # written beside the table and moved in, since two writers cannot commit to one folder at once
    staged = f"{registry_path}/_staged/{uuid.uuid4().hex}"
    row.coalesce(1).write.parquet(staged)
    for part in files.globStatus(paths(staged, "*.parquet")):
        files.rename(part.getPath(), paths(registry_path, f"part-{digest}-{version}.parquet"))
    return spark.read.schema(row.schema).parquet(f"{registry_path}/part-{digest}-{version}.parquet")
