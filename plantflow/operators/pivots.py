"""Nearest vectors by angle: rows grouped around pivots, whole groups left out by the bound of their angle."""

from __future__ import annotations

import numpy as np

from plantflow.operators.postings import DIGITS

SLACK = 10.0**-DIGITS  # scores closer than this are equal, so no group within it is left out


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; a row of zeros stays, and its cosine with anything is 0."""
    lengths = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.where(lengths == 0, 1.0, lengths)


def spread_out(rows: np.ndarray, count: int) -> np.ndarray:
    """At most `count` unit rows far from each other: each next one is the row with the least cosine to its closest."""
    rows = rows[(rows != 0).any(1)]
    if not len(rows) or count < 1:
        return rows[:0]
    chosen = [0]
    closest = rows @ rows[0]
    while len(chosen) < count:
        at = int(np.argmin(closest))
        if closest[at] > 1 - 1e-9:  # nothing but copies is left
            break
        chosen.append(at)
        closest = np.maximum(closest, rows @ rows[at])
    return rows[chosen]


class Nearest:
    """The `k` best items of every query, over blocks of rows met one after the other.

    The rows of a block belong to their closest pivot. If a group's rows lie within the angle r of the pivot, and the
    query at the angle a from it, no row's cosine exceeds cos(a - r). A group is scored for the queries that it can
    still change, first for those that it suits best, so that their kth score rises early. Pivots only decide how much
    is left out, never what is found. `scored` and `pairs` count the products made and all there could be.
    """

    def __init__(self, queries: np.ndarray, pivots: np.ndarray, k: int):
        self.queries, self.pivots, self.k = queries, pivots, k
        self.angles = np.arccos(np.clip(queries @ pivots.T, -1, 1))
        self.kth = np.full(len(queries), -np.inf)  # k rows seen so far reach this score
        self.scored = self.pairs = 0

    def best(self, rows: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`(query, row, score)` of this block's rows that may be among the best; `rank` is the order of equal scores."""
        self.pairs += len(rows) * len(self.queries)
        if not len(rows) or not len(self.queries) or self.k < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        order, begin, bounds = self._groups(rows)
        found = [[] for _ in self.queries]
        done = np.zeros(bounds.shape, bool)
        first = bounds.argmax(0)
        for every in (False, True):
            for g in range(len(begin) - 1):
                open_ = ~done[g] & (bounds[g] >= self.kth - SLACK)
                if not every:
                    open_ &= first == g
                asked = np.flatnonzero(open_)
                if not len(asked):
                    continue
                done[g, asked] = True
                own = order[begin[g] : begin[g + 1]]
                scores = np.round(rows[own] @ self.queries[asked].T, DIGITS)
                self.scored += scores.size
                for column, q in enumerate(asked.tolist()):
                    self._keep(found, q, own, scores[:, column], rank)
        query = np.repeat(np.arange(len(found)), [sum(len(r) for r, _ in f) for f in found])
        picked = [pair for f in found for pair in f]
        if not picked:
            return query, np.zeros(0, np.int64), np.zeros(0)
        return query, np.concatenate([r for r, _ in picked]), np.concatenate([s for _, s in picked])

    def _groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows in the order of their groups, where each group begins, and a bound for each group and query."""
        if not len(self.pivots):
            return np.arange(len(rows)), np.array([0, len(rows)]), np.full((1, len(self.queries)), np.inf)
        near = rows @ self.pivots.T
        group = near.argmax(1)
        group[~rows.any(1)] = len(self.pivots)  # rows of zeros: a group of its own, cosine 0
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=len(self.pivots) + 1)
        kinds = np.flatnonzero(sizes)
        begin = np.r_[0, np.cumsum(sizes[kinds])]
        least = np.minimum.reduceat(near.max(1)[order], begin[:-1])
        radius = np.arccos(np.clip(least, -1, 1))
        bounds = np.zeros((len(kinds), len(self.queries)))
        real = kinds < len(self.pivots)
        apart = self.angles[:, kinds[real]].T - radius[real, None]
        bounds[real] = np.cos(np.maximum(apart, 0))
        return order, begin, bounds

    def _keep(self, found: list, q: int, own: np.ndarray, scores: np.ndarray, rank: np.ndarray) -> None:
        """The best `k` of this block for query `q`, and the kth score they prove."""
        enough = scores >= self.kth[q]
        rows, scores = own[enough], scores[enough]
        if found[q]:
            rows, scores = np.r_[found[q][0][0], rows], np.r_[found[q][0][1], scores]
        if len(rows) > self.k:
            best = np.lexsort((rank[rows], -scores))[: self.k]
            rows, scores = rows[best], scores[best]
        if len(rows):
            found[q] = [(rows, scores)]
        if len(rows) >= self.k:
            self.kth[q] = max(self.kth[q], scores.min())
