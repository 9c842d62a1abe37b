"""Posting lists of a shard of chunks, and exact top-k search over them with block maxima.

A shard holds the lists of all its chunks: for every term the places of the chunks that have it and its weight there.
Places are cut into blocks of `BLOCK`; the largest weight of a term in each block bounds what the term can add to any
chunk of that block. A question adds up these bounds block by block, scores the blocks of the largest bounds first,
and stops at the first whose bound is below the k-th best score so far (or below the score asked for): no chunk there
can be among the best. What is returned is exact, ties included.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4
FIRST_BLOCKS = 64  # blocks scored before the k-th best score is looked at
DIGITS = 9  # scores alike to so many digits are ties, which go to the smaller place
MARGIN = 2 * 10.0**-DIGITS


class Postings:
    """Lists of one shard: `number` of each list's term (rising), its bounds, and places with weights."""

    def __init__(self, number: np.ndarray, bounds: np.ndarray, place: np.ndarray, weight: np.ndarray, size: int):
        self.number, self.bounds, self.place, self.weight = number, bounds, place, weight
        self.size, self.blocks = size, -(-size // BLOCK)
        # the block of every posting, and where the postings of a (list, block) begin
        block = place // BLOCK
        owner = np.repeat(np.arange(len(number)), np.diff(bounds))
        opens = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])][: len(block)])
        self.block = block
        self.at = block[opens]
        self.most = np.maximum.reduceat(weight, opens) if len(opens) else np.zeros(0)
        self.spans = np.searchsorted(owner[opens], np.arange(len(number) + 1))

    def lists(self, numbers: np.ndarray, weights: np.ndarray) -> list[tuple[int, float]]:
        at = np.searchsorted(self.number, numbers)
        known = (at < len(self.number)) & (self.number[np.minimum(at, max(0, len(self.number) - 1))] == numbers) if len(self.number) else np.zeros(len(numbers), bool)
        return list(zip(at[known].tolist(), weights[known].tolist()))

    def bound(self, lists: list[tuple[int, float]]) -> np.ndarray:
        """What a question can score at most in each block."""
        most = np.zeros(self.blocks)
        for i, weight in lists:
            span = slice(self.spans[i], self.spans[i + 1])
            most[self.at[span]] += weight * self.most[span]
        return most

    def score(self, lists: list[tuple[int, float]], chosen: np.ndarray) -> np.ndarray:
        """Scores of all chunks in the chosen blocks; 0 elsewhere."""
        out = np.zeros(self.blocks * BLOCK)
        for i, weight in lists:
            low, high = self.bounds[i], self.bounds[i + 1]
            own = np.flatnonzero(chosen[self.block[low:high]]) + low
            out[self.place[own]] += weight * self.weight[own]
        return out

    def best(self, numbers: np.ndarray, weights: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the k best chunks of at least `floor`, best first, and how many chunks were scored."""
        lists = self.lists(numbers, weights)
        bound = self.bound(lists)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        places, scores, scored = np.zeros(0, np.int64), np.zeros(0), 0
        at, step = 0, FIRST_BLOCKS
        while at < len(order):
            reach = at + int((bound[order[at : at + step]] >= floor - MARGIN).sum())
            if reach == at:
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[at:reach]] = True
            found = self.score(lists, chosen)
            new = np.flatnonzero((found > 0) & (found >= floor - MARGIN))
            places, scores = np.r_[places, new], np.r_[scores, found[new]]
            first = np.lexsort((places, -np.round(scores, DIGITS)))[:k]
            places, scores = places[first], scores[first]
            if len(scores) == k:
                floor = max(floor, float(scores[-1]))
            scored += (reach - at) * BLOCK
            at, step = reach, step * 2
        return places, scores, scored
