"""Exact top-k search by inner product, with a vector-approximation file.

Every vector is turned into integers and, beside them, into a few bits a component: the number of its cell
in a grid over all vectors. From the cells alone, a score is known to within the width of the cells. Each
task scans the cells of its vectors for a bounded block of queries, and then reads exact vectors in the order
of their bounds, best first, until no bound left reaches the query's k-th best exact score. A task sends out
at most k + 1 rows a query, which are merged by rank.

Queries are taken in blocks of `BLOCK_BYTES`, each block in one scan over all vectors.

Edge cases: a vector that is null, empty of an id, or holds a null or a non-finite component takes no part.
Vectors are compared with vectors of their own length only. Rows are told apart from the query's own row by
id and vector, and of several equal ones exactly one is left out, so a repeated row finds its twin. Scores
are computed in whole numbers of any size, cut to the range of a long, and then ranked. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

CELLS = 16
BLOCK_BYTES = 4 << 20
MATRIX = 1 << 21  # bounds computed at once

FILE = "vec_id long, size int, exact array<double>, cells binary"
FOUND = "query int, query_id long, vec_id long, score long, own boolean"
LONG = np.iinfo(np.int64)


# ---- the file -------------------------------------------------------------------------------------


def _integers(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of the usable rows, by vector length."""
    ids, vectors = batch["vec_id"], batch["embedding"]
    usable = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    rows = np.flatnonzero(usable)
    if not len(rows):
        return {}
    vectors = vectors.take(pa.array(rows))
    own = np.asarray(ids.take(pa.array(rows)))
    sizes = np.asarray(vectors.value_lengths()).astype(np.int64)
    values = np.asarray(vectors.flatten().cast(pa.float64()).fill_null(np.nan))
    values = np.floor(256.0 * values)
    starts = np.cumsum(sizes) - sizes
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    good = bad[starts + sizes] == bad[starts]
    out = {}
    for size in np.unique(sizes[good]).tolist():
        at = np.flatnonzero(good & (sizes == size))
        out[size] = own[at], values[starts[at][:, None] + np.arange(size)[None, :]]
    return out


def grid(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Smallest and largest value of every component, by vector length."""

    def ranges(batches):
        for batch in batches:
            for size, (_, own) in _integers(batch).items():
                if not size:
                    own = np.zeros((1, 1))  # vectors without components still have a length to compare
                places = np.arange(own.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), size, np.int32)), pa.array(places), pa.array(own.min(0)), pa.array(own.max(0))],
                    ["size", "place", "low", "high"],
                )

    found = _input(vectors).mapInArrow(ranges, "size int, place int, low double, high double")
    rows = found.groupBy("size", "place").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out: dict[int, np.ndarray] = {}
    for row in rows:
        own = out.setdefault(row["size"], np.zeros((2, row["size"])))
        own[:, row["place"] : row["place"] + 1] = np.array([[row["low"]], [row["high"]]])[:, : own.shape[1]]
    return out


def _input(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _width(ranges: np.ndarray) -> np.ndarray:
    """Cell width of every component; a little more than a share of the range, so that the largest value fits."""
    return np.maximum(ranges[1] - ranges[0], 1.0) * (1 + 1e-9) / CELLS


def build(vectors: DataFrame, ranges: dict[int, np.ndarray]) -> DataFrame:
    """The vector-approximation file: one row for every usable vector, its integers and its cells."""

    def cells(batches):
        for batch in batches:
            for size, (ids, own) in _integers(batch).items():
                number = np.floor((own - ranges[size][0]) / _width(ranges[size])).clip(0, CELLS - 1).astype(np.uint8)
                bounds = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.array(np.full(len(ids), size, np.int32)),
                        pa.ListArray.from_arrays(bounds, pa.array(own.reshape(-1))),
                        pa.array([row.tobytes() for row in number], pa.binary()),
                    ],
                    ["vec_id", "size", "exact", "cells"],
                )

    return _input(vectors).mapInArrow(cells, FILE)


# ---- search ---------------------------------------------------------------------------------------


def _score(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row in whole numbers."""
    size = max(1, left.shape[1])
    most = (np.abs(left).max(initial=0) + 1) * (np.abs(right).max(initial=0) + 1) * size
    if most < 2**62:
        return np.einsum("ij,ij->i", left.astype(np.int64), right.astype(np.int64))
    exact = (sum(int(x) * int(y) for x, y in zip(a, b)) for a, b in zip(left.tolist(), right.tolist()))
    return np.array([min(max(x, LONG.min), LONG.max) for x in exact], np.int64)


class _Best:
    """The best rows so far of each query: score, then smaller id."""

    def __init__(self, queries: int, keep: int):
        self.keep = keep
        self.query, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.own = np.zeros(0, bool)
        self.least = np.full(queries, -np.inf)  # a row below it cannot enter

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        query, score = np.r_[self.query, query], np.r_[self.score, score]
        ids, own = np.r_[self.id, ids], np.r_[self.own, own]
        # ~score falls as the score rises and cannot overflow
        order = np.lexsort((ids, ~score, query))
        query = query[order]
        first = np.r_[0, np.flatnonzero(query[1:] != query[:-1]) + 1][: len(query)]
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        order = order[place < self.keep]
        self.score, self.id, self.own = score[order], ids[order], own[order]
        last = np.flatnonzero(place == self.keep - 1)
        self.query = query[place < self.keep]
        kept = np.flatnonzero(place[place < self.keep] == self.keep - 1)
        self.least[query[last]] = self.score[kept]


def _search_block(best: _Best, ids: np.ndarray, exact: np.ndarray, cells: np.ndarray, ranges: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> None:
    """Add to `best` what the vectors of one piece hold for the queries."""
    width = _width(ranges)
    centre = ranges[0] + (cells + 0.5) * width
    about = queries @ centre.T
    slack = np.abs(queries) @ (width * 0.5000001) + np.abs(queries).sum(1) * (np.abs(centre).max(initial=0) + 1) * 1e-12 + 1e-6
    keep = min(best.keep, len(ids))
    # the k-th best lower bound of this piece, or the k-th best score so far
    lower = np.partition(about, len(ids) - keep, axis=1)[:, len(ids) - keep] - slack if keep == best.keep else np.full(len(queries), -np.inf)
    # scores beyond a long are cut, so bounds are as well
    floor = np.minimum(np.maximum(best.least, lower), float(LONG.max))
    above = np.maximum(about + slack[:, None], float(LONG.min))
    query, row = np.nonzero(above >= floor[:, None])
    upper = above[query, row]
    order = np.lexsort((-upper, query))
    query, row, upper = query[order], row[order], upper[order]
    first = np.searchsorted(query, query)
    place, step, at = np.arange(len(query)) - first, best.keep, 0
    while len(query):
        now = place < at + step
        q, r = query[now], row[now]
        own = ids[r] == query_ids[q]
        own[own] = (exact[r[own]] == queries[q[own]]).all(1)
        best.add(q, _score(queries[q], exact[r]), ids[r], own)
        left = ~now & (upper >= best.least[query])
        query, row, upper, place = query[left], row[left], upper[left], place[left]
        at, step = at + step, step * 4


def _search(ranges: np.ndarray, size: int, query_ids: np.ndarray, queries: np.ndarray, k: int):
    def search(batches):
        best = _Best(len(queries), k + 1)
        step = max(64, MATRIX // max(1, len(queries)))
        for batch in batches:
            at = np.flatnonzero(np.asarray(batch["size"]) == size)
            if not len(at):
                continue
            rows = pa.array(at)
            ids = np.asarray(batch["vec_id"].take(rows))
            exact = np.asarray(batch["exact"].take(rows).flatten()).reshape(len(at), size)
            cells = np.frombuffer(b"".join(batch["cells"].take(rows).to_pylist()), np.uint8).reshape(len(at), size)
            for low in range(0, len(at), step):
                piece = slice(low, low + step)
                _search_block(best, ids[piece], exact[piece], cells[piece], ranges, query_ids, queries)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.query.astype(np.int32)),
                pa.array(query_ids[best.query]),
                pa.array(best.id),
                pa.array(best.score),
                pa.array(best.own),
            ],
            ["query", "query_id", "vec_id", "score", "own"],
        )

    return search


def _blocks(rows, size: int):
    """Queries from the driver's iterator, in blocks of bounded bytes."""
    count = max(1, BLOCK_BYTES // (8 * max(1, size)))
    while block := list(islice(rows, count)):
        ids = np.array([r["vec_id"] for r in block], np.int64)
        yield ids, np.array([r["exact"] for r in block], np.float64).reshape(len(block), size)


def search(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row for which `is_query` holds."""
    ranges = grid(vectors)
    file = build(vectors, ranges)
    found = []
    for size in sorted(ranges):
        wanted = file.where((F.col("size") == size) & is_query).select("vec_id", "exact")
        for ids, queries in _blocks(wanted.toLocalIterator(), size):
            part = file.mapInArrow(_search(ranges[size], size, ids, queries, k), FOUND)
            found.append(part.withColumn("block", F.lit(len(found))))
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = reduce(DataFrame.unionByName, found)
    order = [F.desc("score"), F.asc("vec_id")]
    each = Window.partitionBy("block", "query").orderBy(*order, "own")
    own = Window.partitionBy("block", "query", "own").orderBy(*order)
    rows = rows.withColumn("place", F.row_number().over(each)).where(F.col("place") <= k + 1)
    rows = rows.withColumn("again", F.row_number().over(own)).where(~(F.col("own") & (F.col("again") == 1)))
    return (
        rows.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
