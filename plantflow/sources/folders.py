"""Folders of very many small files, of which the driver holds only some at a time.

For a table that is read in one piece the driver keeps the status of every file, and a task for every few of them. Here
folders are taken together until they hold as many files as `files_at_once` allows; what is wanted of these is read and
stored before the next are listed. So the driver's memory is bounded by that number, or by the largest single folder.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import chain
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from plantflow.session import files_at_once, new_folder

AT_ONCE = 3  # blocks in work: while the tasks of one run out, those of the next begin
# Many small files a task: opening one counts as so many bytes, and no status outlives the block.
SMALL_FILES = {"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}


class Block(NamedTuple):
    """Folders that are read together; names of their files are told apart by their last `depth` parts."""

    paths: list[str]
    depth: int


def _leaves(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int]]:
    """Folders that Spark reads files from if given `path`: each with its depth and its number of entries.

    As always in Spark, files that lie beside folders named `key=value` are not read, and folders of other names neither.
    """
    paths = spark._jvm.org.apache.hadoop.fs
    files = paths.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    keyed = paths.GlobFilter("[^.]*=*")
    waiting = [(found.getPath(), 1) for found in reversed(list(files.globStatus(paths.Path(path)) or []))]
    while waiting:
        folder, depth = waiting.pop()
        below = [entry.getPath() for entry in files.listStatus(folder, keyed) if entry.isDirectory()]
        if below:
            waiting += [(one, depth + 1) for one in reversed(below)]
        else:
            yield folder.toString(), depth, len(files.listStatus(folder))


def blocks(spark: SparkSession, path: str) -> Iterator[Block]:
    """The folders of `path`, as many together as hold no more than `files_at_once` files; a larger one stands alone."""
    most, held, paths, depth = files_at_once(spark), 0, [], 1
    for folder, at, n in _leaves(spark, path):
        if paths and (at != depth or held + n > most):
            yield Block(paths, depth)
            held, paths = 0, []
        held, depth = held + n, at
        paths.append(re.sub(r"([{}\[\]*?\\])", r"\\\1", folder))  # a name, no pattern
    yield Block(paths or [path], depth)


def _session(spark: SparkSession) -> SparkSession:
    """A session of the same settings, but for small files."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **SMALL_FILES}.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def read_blocks(spark: SparkSession, path: str, read: Callable[[SparkSession, Block], DataFrame]) -> DataFrame:
    """What `read` makes of each block of `path`, all together: read when it is asked for if there is one, else stored."""
    waiting = blocks(spark, path)
    first, second = next(waiting), next(waiting, None)
    if second is None:
        return read(spark, first)
    own, folder = _session(spark), new_folder(spark, "files")

    def store(number: int, block: Block):
        gc.collect()  # frames of blocks before are held by cycles, and the driver keeps their lists of files
        rows = read(own, block)
        rows.write.parquet(f"{folder}/{number}")
        return rows.schema

    with ThreadPoolExecutor(AT_ONCE) as pool:
        try:
            jobs = [pool.submit(store, *numbered) for numbered in enumerate(chain((first, second), waiting))]
            schema = [job.result() for job in jobs][0]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
