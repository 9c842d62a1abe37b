"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed over whole texts, in pieces of bounded size. Trees are boosted on a sample of at most about `SAMPLE` labelled documents (the rows that may be learned from, drawn by a hash of
doc_id): features are cut into at most `BINS` bins, a node's split is found from histograms of gradients, and
all trees have one depth. The model is a few flat arrays (feature, threshold, children, value); scoring walks
all documents of a batch down all trees in NumPy at once.

Edge cases: a null text counts as empty, and has statistics and a score like any other; without labels, or
with labels of one kind only, every score is the share of label 1 (0.5 without labels); a row without doc_id is
scored, and never learned from; repeated rows are scored each and learned from once; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantflow.llm import blocks as b
from plantflow.llm import learn
from plantflow.session import durable

SAMPLE = 20_000
BINS = 64
DEPTH = 4
ROUNDS = 80
RATE = 0.15
CUT = 0.3

FEATURES = (
    "bytes", "words", "word_length", "upper", "digit", "punctuation", "blank", "line_ends", "wide",
    "distinct_words", "top_word", "adjacent_repeats", "distinct_trigrams", "symbol_ends", "no_letters",
    "line_words", "repeated_lines", "longest_word", "shout_words",
)

_LOWER, _UPPER, _DIGIT, _SIGN, _BLANK, _END, _WIDE = range(1, 8)
_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(0x21, 0x7F)]] = _SIGN
_CLASS[[*range(0x61, 0x7B)]] = _LOWER
_CLASS[[*range(0x41, 0x5B)]] = _UPPER
_CLASS[[*range(0x30, 0x3A)]] = _DIGIT
_CLASS[b.SPACE] = _BLANK
_CLASS[0x0A] = _END
_CLASS[0x80:] = _WIDE
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>@\\^_|~"]] = True


# ---- statistics -----------------------------------------------------------------------------------


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    return count / np.maximum(total, 1)


def _distinct(digest: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and how often its most frequent one occurs."""
    order = np.lexsort((digest, text))
    d, t = digest[order], text[order]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])][: len(d)])
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, t[first], np.diff(np.r_[first, len(d)]))
    return np.bincount(t[first], minlength=texts), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    buffer, offsets = b.text_buffer(texts)
    n = len(offsets) - 1
    size = np.diff(offsets)
    of = np.repeat(np.arange(n), size)
    count = np.bincount(of * 8 + _CLASS[buffer], minlength=8 * n).reshape(n, 8)
    words = b.Words(buffer, offsets)
    per = words.counts
    length = words.ends - words.starts
    of_words = lambda what: np.bincount(words.text[what], minlength=n)
    again = np.zeros(len(length), bool)
    again[1:] = (words.digests[1:] == words.digests[:-1]) & (words.text[1:] == words.text[:-1])
    letters = np.r_[0, np.cumsum((_CLASS[buffer] == _LOWER) | (_CLASS[buffer] == _UPPER) | (_CLASS[buffer] == _WIDE))]
    upper = np.r_[0, np.cumsum(_CLASS[buffer] == _UPPER)]
    no_letters = letters[words.ends] == letters[words.starts]
    shout = (upper[words.ends] - upper[words.starts] > 1) & (upper[words.ends] - upper[words.starts] == letters[words.ends] - letters[words.starts])
    distinct, top = _distinct(words.digests, words.text, n)
    opens = np.flatnonzero(words.place + 3 <= per[words.text])
    trigrams, _ = _distinct(b.Rolling(words.digests, b.BASES[1]).spans(opens, opens + 3), words.text[opens], n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, words.text, length)
    ends = np.flatnonzero(buffer == 0x0A)
    starts = np.unique(np.r_[offsets[:-1][size > 0], ends + 1])
    starts = starts[starts < len(buffer)]
    line_of = np.searchsorted(offsets, starts, "right") - 1
    stops = np.minimum(np.r_[ends, len(buffer)][np.searchsorted(ends, starts)], offsets[line_of + 1])
    full = stops > starts
    starts, stops, line_of = starts[full], stops[full], line_of[full]
    lines = np.bincount(line_of, minlength=n)
    kinds, _ = _distinct(b.Rolling(b.BYTE_VALUES[buffer], b.BASES[2]).spans(starts, stops), line_of, n)
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(per),
            _share(np.bincount(words.text, weights=length, minlength=n), per),
            _share(count[:, _UPPER], count[:, _UPPER] + count[:, _LOWER]),
            _share(count[:, _DIGIT], size),
            _share(count[:, _SIGN], size),
            _share(count[:, _BLANK], size),
            _share(count[:, _END], size),
            _share(count[:, _WIDE], size),
            _share(distinct, per),
            _share(top, per),
            _share(of_words(again), per),
            _share(trigrams, np.maximum(per - 2, 0)),
            _share(of_words(_SYMBOL[buffer[words.ends - 1]] if len(length) else again), per),
            _share(of_words(no_letters), per),
            _share(per, lines),
            1 - _share(kinds, lines),
            np.log1p(longest),
            _share(of_words(shout), per),
        ]
    ).astype(np.float32)


# ---- trees ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees, one after the other; a leaf is its own child."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                low = rows[every, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return learn.sigmoid(total)


def _bin_edges(column: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))


def boost(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Gradient boosting of the log loss, with second-order leaf values."""
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    node: dict[str, list] = {name: [] for name in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def add(value: float) -> int:
        at = len(node["value"])
        for name, x in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", value)):
            node[name].append(x)
        return at

    if len(np.unique(labels)) == 2:
        edges = [_bin_edges(rows[:, f]) for f in range(rows.shape[1])]
        binned = np.column_stack([np.searchsorted(e, rows[:, f]) for f, e in enumerate(edges)])
        total = np.full(len(rows), base)
        for _ in range(rounds):
            p = learn.sigmoid(total)
            gradient, curve = labels - p, p * (1 - p)
            root = add(0.0)
            roots.append(root)
            at = np.full(len(rows), root)
            level = [root]
            for _ in range(depth):
                level = _split_level(level, at, binned, edges, gradient, curve, node, add)
            nodes = range(root, len(node["value"]))
            g = np.bincount(at - root, weights=gradient, minlength=len(nodes))
            h = np.bincount(at - root, weights=curve, minlength=len(nodes))
            for i in nodes:
                node["value"][i] = rate * g[i - root] / (h[i - root] + 1.0)
            total += np.array(node["value"])[at]
    kinds = {"feature": np.int64, "threshold": np.float32, "left": np.int64, "right": np.int64, "value": np.float64}
    return Trees(base, np.array(roots, np.int64), depth=depth, **{k: np.array(node[k], kinds[k]) for k in kinds})


def _split_level(level, at, binned, edges, gradient, curve, node, add) -> list[int]:
    """Split the nodes of a level where that gains, and move their rows down."""
    place = {name: i for i, name in enumerate(level)}
    slot = np.full(len(node["value"]), -1)
    slot[level] = range(len(level))
    own = slot[at]
    live = own >= 0
    best = [(1e-3, -1, -1)] * len(level)
    for f, edge in enumerate(edges):
        if not len(edge):
            continue
        bins = len(edge) + 1
        key = own[live] * bins + binned[live, f]
        g = np.bincount(key, weights=gradient[live], minlength=len(level) * bins).reshape(-1, bins).cumsum(1)
        h = np.bincount(key, weights=curve[live], minlength=len(level) * bins).reshape(-1, bins).cumsum(1)
        all_g, all_h = g[:, -1:], h[:, -1:]
        low_g, low_h = g[:, :-1], h[:, :-1]
        gain = low_g**2 / (low_h + 1) + (all_g - low_g) ** 2 / (all_h - low_h + 1) - all_g**2 / (all_h + 1)
        gain[(low_h < 1) | (all_h - low_h < 1)] = 0
        cut = gain.argmax(1)
        for i, c in enumerate(cut.tolist()):
            if gain[i, c] > best[i][0]:
                best[i] = (gain[i, c], f, c)
    below = []
    for name, i in place.items():
        _, f, c = best[i]
        if f < 0:
            continue
        node["feature"][name], node["threshold"][name] = f, edges[f][c]
        node["left"][name], node["right"][name] = add(0.0), add(0.0)
        mine = np.flatnonzero(own == i)
        at[mine] = np.where(binned[mine, f] <= c, node["left"][name], node["right"][name])
        below += [node["left"][name], node["right"][name]]
    return below


# ---- the operator ---------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Boost trees on the statistics of at most about `sample` labelled documents."""
    chosen = learn.drawn(durable(learn.labelled(labels, "quality")), sample)

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                found = statistics(piece["text"])
                bounds = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
                values = pa.ListArray.from_arrays(bounds, pa.array(found.reshape(-1)))
                yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["label"], values], ["doc_id", "label", "features"])

    rows = (
        b.text_rows(docs).join(F.broadcast(chosen), "doc_id")  # bounded by `sample`
        .select("doc_id", "label", "text")
        .mapInArrow(run, "doc_id long, label int, features array<float>")
        .groupBy("doc_id").agg(F.min("features").alias("features"), F.max("label").alias("label"))
        .orderBy("doc_id").select("features", "label").collect()
    )
    if not rows:
        return boost(np.zeros((0, len(FEATURES))), np.zeros(0))
    return boost(np.array([r["features"] for r in rows], np.float32), np.array([r["label"] for r in rows], np.float64))


def _scored(docs: DataFrame, labels: DataFrame, sample: int, carried: tuple[str, ...] = ()) -> DataFrame:
    trees = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    rows = b.text_rows(docs, *carried)
    kept = [c for c in rows.columns if c != "text" or carried]

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                score = pa.array(trees.value.score(statistics(piece["text"])))
                yield pa.RecordBatch.from_arrays([*(piece[c] for c in kept), score], [*kept, "score"])

    return rows.mapInArrow(run, b.schema(rows.select(kept), "score double"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score reaches `cut`)."""
    return _scored(docs, labels, sample).select(
        "doc_id",
        learn.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """The documents whose score reaches `cut`, with all their columns."""
    scored = _scored(docs, labels, sample, tuple(docs.columns))
    return scored.where(F.col("score") >= cut).select("row.*")
