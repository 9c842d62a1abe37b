"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits of any script, with the marks on them, after NFKC and case folding of
documents and items alike. Seeds, all
strings of `SEED` tokens of the benchmark, are joined with the seeds of every document: a sorted array of
digests, shared with all tasks for one bounded block of benchmark items at a time. Only where an item's seeds
found in a document could cover enough of the item is it tiled: repeatedly the longest matches of unmarked
tokens are found by Karp-Rabin digests of falling length, and marked in both texts, so that every token is in
one tile at most. The order of tiles does not count, which is how passages with their parts moved about are
caught. A document is contaminated if the tiles cover `COVERAGE` of an item's tokens or more.

Every tile lies within the document's seeds that are in the item, so only those stretches are tiled; of equal
stretches no more than could ever be used.

Edge cases: a null or empty text is clean; items without id or text, or with fewer than SEED tokens, take no
part; of equally covered items the smallest id is named; repeated rows are judged each; columns of any name
are kept beside the judgement.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plantflow.llm import blocks as b
from plantflow.llm import learn

SEED = 5
COVERAGE = 0.5
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 8 << 20

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_VALUES = b.BYTE_VALUES.copy()
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]

FOUND = "item_id long, coverage double, n_items int"


def fold(text: str) -> str:
    """A text in NFKC and folded case, with blanks for what is neither ASCII nor a letter, a digit or a mark."""
    text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    for c in set(text):
        if not (c.isascii() or c.isalnum() or unicodedata.category(c)[0] == "M"):
            text = text.replace(c, " ")
    return text


def folded(texts: pa.Array) -> pa.Array:
    """The texts as `tokens` reads them; those in ASCII are left as they are."""
    plain = pc.fill_null(pc.string_is_ascii(texts), True).to_pylist()
    if all(plain):
        return texts
    return pa.array([t.as_py() if p else fold(t.as_py()) for t, p in zip(texts, plain)], pa.large_string())


def tokens(texts: pa.Array) -> b.Words:
    buffer, offsets = b.text_buffer(folded(texts))
    return b.Words(buffer, offsets, _BETWEEN, _VALUES)


def _seeds(words: b.Words) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all seeds and the tokens they start at."""
    at = np.flatnonzero(words.place + SEED <= words.counts[words.text])
    return b.Rolling(words.digests, b.BASES[1]).spans(at, at + SEED), at


# ---- tiling ---------------------------------------------------------------------------------------


def tiles(item: list[int], text: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of greedy string tiling: longest matches first, none overlap."""
    used_item, used_text = [False] * len(item), [False] * len(text)
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(text), 4 * least))
    while True:
        matches = _maximal(item, text, used_item, used_text, size)
        longest = max(matches, default=0)
        if longest > 2 * size:
            size = longest
            continue
        for length in sorted(matches, reverse=True):
            for i, j in matches[length]:
                if any(used_item[i : i + length]) or any(used_text[j : j + length]):
                    continue  # what is left of it comes up again in the next search
                found.append((i, j, length))
                used_item[i : i + length] = used_text[j : j + length] = [True] * length
        if matches:
            # cut matches may still have pieces of this size
            if any(True for _ in _maximal(item, text, used_item, used_text, size)):
                continue
        if size == least:
            return found
        size = max(least, size // 2)


def _maximal(item, text, used_item, used_text, size) -> dict[int, list[tuple[int, int]]]:
    """Matches of unmarked tokens that cannot be made longer, by length (at least `size`)."""
    places = defaultdict(list)
    for digest, i in _runs(item, used_item, size):
        places[digest].append(i)
    out: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for digest, j in _runs(text, used_text, size):
        for i in places.get(digest, ()):
            if i and j and item[i - 1] == text[j - 1] and not used_item[i - 1] and not used_text[j - 1]:
                continue  # part of the match that starts one token before
            length = 0
            while (
                i + length < len(item) and j + length < len(text) and item[i + length] == text[j + length]
                and not used_item[i + length] and not used_text[j + length]
            ):
                length += 1
            if length >= size:
                out[length].append((i, j))
    return out


_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def _runs(tokens: list[int], used: list[bool], size: int):
    """Karp-Rabin digest and start of every string of `size` unmarked tokens."""
    top = pow(_BASE, size - 1, _MODULUS)
    digest = length = 0
    for k, token in enumerate(tokens):
        if used[k]:
            digest = length = 0
            continue
        if length == size:
            digest = (digest - tokens[k - size] * top) % _MODULUS
            length -= 1
        digest = (digest * _BASE + token) % _MODULUS
        length += 1
        if length == size:
            yield digest, k - size + 1


# ---- a block of the benchmark ---------------------------------------------------------------------


class Block:
    """Items of the benchmark: their tokens, and their seeds in order."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = tokens(pa.array(texts, pa.string()))
        self.ids = np.array(ids, np.int64)
        self.first, self.count = words.first, words.counts
        self.digests = words.digests
        seed, at = _seeds(words)
        order = np.argsort(seed, kind="stable")
        self.seeds, self.bounds = b.slices(seed[order])
        self.at, self.item = at[order], words.text[at][order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.seeds >> b.U64(44)).astype(np.int64)] = True

    def judge(self, texts: pa.Array, coverage: float) -> list[tuple[int, int, float, int]]:
        """(text, item id, coverage, items) of each contaminated text."""
        words = tokens(texts)
        seed, at = _seeds(words)
        near = np.flatnonzero(self.maybe[(seed >> b.U64(44)).astype(np.int64)])
        place = np.searchsorted(self.seeds, seed[near])
        hit = np.zeros(len(near), bool)
        inside = place < len(self.seeds)
        hit[inside] = self.seeds[place[inside]] == seed[near[inside]]
        near, place = near[hit], place[hit]
        # one row for each seed of an item that a text has
        times = self.bounds[place + 1] - self.bounds[place]
        row = np.repeat(self.bounds[place] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        start = np.repeat(at[near], times)
        text, item = words.text[start], self.item[row]
        order = np.lexsort((start, item, text))
        text, item, start, row = text[order], item[order], start[order], row[order]
        first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])][: len(text)])
        found: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for low, high in zip(first.tolist(), [*first[1:].tolist(), len(text)]):
            share = self._cover(words, int(item[low]), start[low:high], self.at[row[low:high]], coverage)
            if share >= coverage:
                found[int(text[low])].append((-share, int(self.ids[item[low]])))
        return [(t, min(own)[1], -min(own)[0], len(own)) for t, own in found.items()]

    def _cover(self, words: b.Words, item: int, starts: np.ndarray, places: np.ndarray, least: float) -> float:
        """Share of the item's tokens that tiles with the text cover; 0 if seeds show it is below `least`."""
        size, first = int(self.count[item]), int(self.first[item])
        reach = b.sum_ranges(size, places - first, places - first + SEED)
        if reach.sum() < least * size:
            return 0.0
        starts = np.unique(starts)
        parts = np.flatnonzero(np.diff(starts) > 1) + 1
        text: list[int] = []
        copies: Counter = Counter()
        for run in np.split(starts, parts):
            own = tuple(words.digests[run[0] : run[-1] + SEED].tolist())
            copies[own] += 1
            if copies[own] <= size // SEED:
                text += [*own, -1 - len(text)]  # a token of its own parts the stretches
        own = self.digests[first : first + size].tolist()
        return sum(length for _, _, length in tiles(own, text)) / size


# ---- the operator ---------------------------------------------------------------------------------


def _blocks(benchmark: DataFrame):
    """The benchmark in blocks of bounded size, one after the other on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).toLocalIterator()
    while block := list(islice(rows, BLOCK_ITEMS)):
        ids, texts, size = [], [], 0
        for row in block:
            if size > BLOCK_BYTES:
                yield Block(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(row["item_id"])
            texts.append(row["text"])
            size += len(row["text"].encode())
        yield Block(ids, texts)


def judged(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Every document as a struct `row`, with the most covered item, its coverage, and how many items are covered.

    Clean documents have no item and coverage 0.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.struct("*").alias("row"),
        F.lit(None).cast("long").alias("item_id"),
        F.lit(0.0).alias("coverage"),
        F.lit(0).alias("n_items"),
    )
    schema = b.schema(rows.select("row"), FOUND)
    for block in _blocks(benchmark):
        rows = rows.mapInArrow(_mark(context.broadcast(block), coverage), schema)
    return rows


def _mark(block, coverage: float):
    def mark(batches):
        for batch in batches:
            texts = batch["row"].field("text")
            if batch["row"].null_count:
                texts = pa.array(texts.to_pylist(), pa.string())
            whole = pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], [*batch.schema.names, "text"])
            for piece in learn.pieces(whole):
                item, share, count = (piece[name].to_pylist() for name in ("item_id", "coverage", "n_items"))
                for t, own, cover, items in block.value.judge(piece["text"], coverage):
                    if (-cover, own) < (-share[t], own if item[t] is None else item[t]):
                        item[t], share[t] = own, cover
                    count[t] += items
                yield pa.RecordBatch.from_arrays(
                    [piece["row"], pa.array(item, pa.int64()), pa.array(share, pa.float64()), pa.array(count, pa.int32())],
                    ["row", "item_id", "coverage", "n_items"],
                )

    return mark


def judge(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, contaminated, item_id, coverage, n_items."""
    return judged(b.text_rows(docs), benchmark, coverage).select(
        F.col("row.doc_id").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"), "item_id", "coverage", "n_items"
    )


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return judged(docs, benchmark, coverage).where(F.col("n_items") == 0).select("row.*")
