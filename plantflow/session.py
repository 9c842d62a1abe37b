"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Group size above which a window or a per-group buffer is split over several tasks.
GROUP_ROWS_CONF = "spark.plantflow.maxGroupRows"
GROUP_ROWS_DEFAULT = 4_000_000

# Row count up to which a measured side may be broadcast.
BROADCAST_ROWS_CONF = "spark.plantflow.maxBroadcastRows"
BROADCAST_ROWS_DEFAULT = 200_000

# Bytes up to which it may.
BROADCAST_BYTES_CONF = "spark.plantflow.maxBroadcastBytes"
BROADCAST_BYTES_DEFAULT = 64 << 20

# Number of files up to which the driver lists them at once.
FILES_AT_ONCE_CONF = "spark.plantflow.maxFilesAtOnce"
FILES_AT_ONCE_DEFAULT = 10_000


def build_session(app: str = "plantflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on: UTC, ANSI casts and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(BROADCAST_BYTES_DEFAULT)))


def group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS_DEFAULT)))


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS_DEFAULT)))


def files_at_once(spark: SparkSession) -> int:
    return int(spark.conf.get(FILES_AT_ONCE_CONF, str(FILES_AT_ONCE_DEFAULT)))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by the cluster in `spark.checkpoint.dir`.

    Only a local session without one (a test) gets a folder of its own; on a cluster every executor would
    write to its own disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if not configured and not is_local(context.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="plantflow-checkpoint-"))
    return context.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for a table in the shared folder."""
    return f"{shared_folder(spark)}/plantflow-{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back.

    For large frames that several steps read: each step then reads only its columns.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to all cores, if they come from a scan of too few files to keep these busy; else as they are.

    For work that stays in its row: a small table of one file would be one task, a large one is never moved.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan or df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted)
