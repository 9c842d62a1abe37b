"""Helpers for jobs that look at whole texts in NumPy, one bounded block of documents at a time.

A corpus is dealt into *buckets* of about `BUCKET_BYTES` of text by a hash of the row. What buckets have
to tell each other (digests of windows, say) travels as arrays in rows `(part, bucket, ...)`, where `part`
is cut from the digest. A bucket sends a digest once, however often it holds it, so the rows of one
digest are bounded by the number of buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

BUCKET_BYTES = 2 << 20
SLICE_BYTES = 1 << 18

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.default_rng(20240607)
BYTE_VALUES = _RANDOM.integers(1, 2**64 - 1, 256, dtype=U64) | U64(1)
BASES = [int(x) | 1 for x in _RANDOM.integers(2**62, 2**64 - 1, 4, dtype=U64)]
_POWERS: dict[int, np.ndarray] = {}


# ---- frames ---------------------------------------------------------------------------------------


def text_rows(docs: DataFrame, *carried: str) -> DataFrame:
    """`doc_id` as long and `text`; other columns, whatever their names, are left behind.

    Those named in `carried` come along in a struct `row`, where their names clash with nothing.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*columns, *([F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")] if carried else []))


def schema(own: DataFrame | None, ddl: str) -> StructType:
    """The columns of a frame, with their own types, and those of the text behind them."""
    return StructType([*(own.schema.fields if own is not None else []), *StructType.fromDDL(ddl).fields])


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets the texts need, from their measured total size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-total // bucket_bytes))


def bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """Deal rows to buckets; by id and text, so that rows without an id do not meet in one bucket."""
    bucket: Column = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    return docs.select(bucket.alias("bucket"), "*")


# ---- Arrow ----------------------------------------------------------------------------------------


def text_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and their offsets; null counts as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts, offsets, at = [], [np.zeros(1, np.int64)], 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_binary()).fill_null(b"")
        _, ends, data = chunk.buffers()
        own = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, np.int64)
        if own[-1] > own[0]:
            parts.append(np.frombuffer(data, np.uint8)[own[0] : own[-1]])
        offsets.append(own[1:] - own[0] + at)
        at += int(own[-1] - own[0])
    buffer = np.concatenate(parts) if len(parts) > 1 else (parts[0] if parts else np.zeros(0, np.uint8))
    return buffer, np.concatenate(offsets)


def ids_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 and which of them are present."""
    present = ~np.asarray(column.is_null())
    return np.asarray(column.fill_null(0).cast(pa.int64())).astype(np.int64), present


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a column, one after the other, and each list's length."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = column.combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else whole.chunk(0)
    return np.asarray(whole.flatten()), np.asarray(whole.value_lengths()).astype(np.int64)


def list_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(U64)


def slices(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a sorted key and the bounds of each value's slice."""
    if not len(key):
        return key, np.zeros(1, np.int64)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.r_[first, len(key)]


def sum_ranges(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of `size` places lie in any of the half-open ranges."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, ends, 1)
    return np.cumsum(edge[:-1]) > 0


# ---- hashing --------------------------------------------------------------------------------------


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
        if len(have) > SLICE_BYTES * 16:  # a giant text: not worth keeping
            _POWERS.pop(base)
    return have[:n]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ U64(salt)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Rolling:
    """Karp-Rabin digests of any range of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray, base: int):
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(base, len(values)), out=self.sums[1:])
        self.inverse = pow(base, -1, 2**64)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = powers(self.inverse, len(self.sums))
        return mixed((self.sums[ends] - self.sums[starts]) * inverse[starts])

    def windows(self, size: int) -> np.ndarray:
        count = max(0, len(self.sums) - size)
        return mixed((self.sums[size:] - self.sums[:count]) * powers(self.inverse, len(self.sums))[:count])


def part_of(digest: np.ndarray, parts: int) -> np.ndarray:
    """The part a digest belongs to; grows with the digest."""
    return (((digest >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int32)


# ---- words ----------------------------------------------------------------------------------------


def _cuts(buffer: np.ndarray, offsets: np.ndarray, size: int, between: np.ndarray) -> list[int]:
    """Places at which the buffer may be cut without cutting a word, about `size` apart."""
    cuts, at = [0], size
    while at < len(buffer):
        limit = int(offsets[np.searchsorted(offsets, at)])
        while at < limit:
            blank = between[buffer[at : min(at + 4096, limit)]]
            if blank.any():
                at += int(blank.argmax())
                break
            at += len(blank)
        cuts.append(at)
        at += size
    if cuts[-1] < len(buffer):
        cuts.append(len(buffer))
    return cuts


class Words:
    """Words of all texts of a block: their digests, and the text each belongs to.

    `between` says which bytes part words, `values` what each byte counts as in a digest.
    """

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE, values: np.ndarray = BYTE_VALUES):
        starts, ends, digests = [], [], []
        cuts = _cuts(buffer, offsets, SLICE_BYTES, between)
        for low, high in zip(cuts, cuts[1:]):
            piece = buffer[low:high]
            blank = between[piece]
            edges = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")] - low
            before = np.r_[True, blank[:-1]]
            before[edges[edges < len(piece)]] = True
            after = np.r_[blank[1:], True]
            after[edges[edges > 0] - 1] = True
            start = np.flatnonzero(before & ~blank)
            end = np.flatnonzero(after & ~blank) + 1
            digests.append(Rolling(values[piece], BASES[0]).spans(start, end))
            starts.append(start + low)
            ends.append(end + low)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.starts, self.ends, self.digests = join(starts, np.int64), join(ends, np.int64), join(digests, U64)
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.place = np.arange(len(self.starts)) - self.first[self.text]
