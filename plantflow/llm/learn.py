"""What the learned operators share: which rows may be learned from, and texts in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plantflow.llm import blocks as b

PIECE_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: the CRC-32 of the id as text is divisible by 5, or there is no id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label (0 or 1) of each document that may be learned from; of several labels the largest."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def drawn(rows: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """About `most` of the rows at most, chosen by a hash of their key; all of them if there are no more."""
    total = rows.count()
    share = min(1.0, most / max(total, 1))
    return rows.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) < int(share * (1 << 30)))


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` bytes of text, at least one row each."""
    sizes = np.diff(b.text_buffer(batch[column])[1])
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most, "right")))
        yield batch.slice(at, end - at)
        at = end


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
