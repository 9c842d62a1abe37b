"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is `<word>` in lower case (A-Z), and the bag of its character strings of 3 to 5 bytes, each hashed to
a row of an embedding table. A segment of `SEGMENT` words averages the rows of all its strings and feeds a
softmax over (clean, toxic). Table and softmax are trained jointly in NumPy. A misspelt word shares most of
its strings, and so its place, with the word it stands for.

Toxic documents are mostly clean text, so a document scores as its worst segment does, and training goes by
segments too: first every segment of a toxic document counts as a little toxic, then only those that the
model so far finds worst, against clean documents' segments, among them the ones it finds worst.

Training uses a sample of at most about `TOXIC` toxic and `CLEAN` clean documents of up to `LONGEST` bytes,
about `TRAIN_BYTES` together (the rows that may be learned from, drawn by a hash of doc_id). Scoring covers whole texts of any length:
as the softmax is linear in the average, each table row is reduced to one number beforehand, and running sums
over a piece of text give all its segments at once.

Edge cases: a null, empty or blank text has nothing toxic and scores 0; without labels of both
kinds every score is the share of label 1 (0.5 without labels); a row without doc_id is scored, never learned
from; repeated rows are scored each and learned from once; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantflow.llm import blocks as b
from plantflow.llm import learn
from plantflow.session import durable

SEGMENT = 6
SIZES = (3, 4, 5)
TABLE_BITS = 16
WIDTH = 8
TOXIC = 1_500
CLEAN = 2_500
LONGEST = 1 << 16
TRAIN_BYTES = 10 << 20
EPOCHS = 5
CUT = 0.5

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_CODE = np.random.default_rng(20240608).integers(1, 2**32 - 1, 256, dtype=np.uint32)
_TURN = np.uint32(0x9E3779B1)


# ---- segments and strings -------------------------------------------------------------------------


class _Strings:
    """The words of a piece of text with single blanks between, and the table row of every string in them."""

    def __init__(self, texts: pa.Array):
        buffer, offsets = b.text_buffer(texts)
        self.texts = len(offsets) - 1
        self.words = words = b.Words(buffer, offsets)
        sizes = words.ends - words.starts
        self.begin = np.cumsum(sizes + 1) - sizes - 1  # the blank before each word
        self.line = np.full(int(sizes.sum() + len(sizes)) + 1, 0x20, np.uint8)
        of = np.repeat(words.starts - self.begin - 1, sizes)
        inside = np.ones(len(self.line), bool)
        inside[self.begin] = False
        inside[-1] = False
        at = np.flatnonzero(inside)
        self.line[at] = _FOLD[buffer[at + of]]
        self.inside = inside
        # segments: SEGMENT words of one text
        self.opens = np.flatnonzero(words.place % SEGMENT == 0)
        self.of = words.text[self.opens]

    def rows(self):
        """For each string size: table rows by place, and the places where a string of one word starts."""
        code = _CODE[self.line]
        blanks = np.r_[0, np.cumsum(~self.inside)]
        hashed = code
        for size in range(2, max(SIZES) + 1):
            if len(code) < size:
                return
            hashed = hashed[:-1] * _TURN + code[size - 1 :]
            if size in SIZES:
                whole = blanks[size - 1 : len(blanks) - 1][: len(hashed)] == blanks[1 : len(hashed) + 1]
                mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(size)
                yield (mixed >> np.uint32(32 - TABLE_BITS)).astype(np.int64), whole


def _segment_sums(strings: _Strings, weight: np.ndarray) -> np.ndarray:
    """Average weight of the strings of every segment."""
    total = np.zeros(len(strings.line) + 1)
    count = np.zeros(len(strings.line) + 1, np.int64)
    for rows, whole in strings.rows():
        total[1 : len(rows) + 1] += np.where(whole, weight[rows], 0.0)
        count[1 : len(rows) + 1] += whole
    total, count = np.cumsum(total), np.cumsum(count)
    low = strings.begin[strings.opens]
    high = np.r_[low[1:], len(strings.line)]
    return (total[high] - total[low]) / np.maximum(count[high] - count[low], 1)


# ---- the model ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What table and softmax amount to: the log odds that a string adds, and the bias."""

    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of the worst segment of each text."""
        strings = _Strings(texts)
        worst = np.full(strings.texts, -np.inf)
        if len(strings.opens):
            np.maximum.at(worst, strings.of, _segment_sums(strings, self.weight))
        nothing = np.isinf(worst)
        worst[nothing] = 0.0
        return np.where(nothing & self.weight.any(), 0.0, learn.sigmoid(worst + self.bias))


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of all segments, one segment after the other, their bounds, and each segment's text."""
    bags, sizes, owners = [], [], []
    for i, text in enumerate(texts):
        strings = _Strings(pa.array([text]))
        if not len(strings.opens):
            continue
        places, rows = [], []
        for found, whole in strings.rows():
            at = np.flatnonzero(whole)
            places.append(at)
            rows.append(found[at].astype(np.int32))
        if not places:
            continue
        place, row = np.concatenate(places), np.concatenate(rows)
        segment = np.searchsorted(strings.begin[strings.opens], place, "right") - 1
        order = np.argsort(segment, kind="stable")
        bags.append(row[order])
        sizes.append(np.bincount(segment, minlength=len(strings.opens)))
        owners.append(np.full(len(strings.opens), i))
    if not bags:
        return np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)
    bounds = np.r_[0, np.cumsum(np.concatenate(sizes))]
    rows = np.empty(bounds[-1], np.int32)
    end = len(rows)
    while bags:  # each part is freed as it is copied
        own = bags.pop()
        rows[end - len(own) : end] = own
        end -= len(own)
    return rows, bounds, np.concatenate(owners)


def _averages(weight: np.ndarray, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Average weight of every segment, a few thousand segments at a time."""
    out = np.zeros(len(bounds) - 1)
    for low in range(0, len(out), 4096):
        own = bounds[low : low + 4097]
        sums = np.r_[0, np.cumsum(weight[rows[own[0] : own[-1]]], dtype=np.float64)]
        out[low : low + 4096] = (sums[own[1:] - own[0]] - sums[own[:-1] - own[0]]) / np.maximum(np.diff(own), 1)
    return out


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Train table and softmax jointly by Adagrad on minibatches of segments."""
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    flat = Model(np.zeros(1 << TABLE_BITS), float(np.log(share / (1 - share))))
    rows, bounds, owner = _bags(texts)
    toxic = labels[owner] == 1 if len(owner) else np.zeros(0, bool)
    if not toxic.any() or toxic.all():
        return flat
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << TABLE_BITS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-6, np.float32) for x in (table, softmax, bias)]
    size = np.maximum(np.diff(bounds), 1)

    def odds() -> np.ndarray:
        return _averages(table @ (softmax[:, 1] - softmax[:, 0]), rows, bounds) + float(bias[1] - bias[0])

    clean = np.flatnonzero(~toxic)
    for epoch in range(epochs):
        if epoch < 2:
            chosen = np.flatnonzero(toxic)
        else:
            score = odds()
            best = np.full(len(labels), -np.inf)
            np.maximum.at(best, owner[toxic], score[toxic])
            chosen = np.flatnonzero(toxic & ((score >= best[owner]) | (score > 2.0)))
        count = min(len(clean), max(2 * len(chosen), 20_000))
        others = rng.choice(clean, count, replace=False)
        if epoch >= 2:
            others = np.union1d(others, clean[np.argsort(-score[clean])[: len(chosen)]])
        picked = rng.permutation(np.r_[chosen, others])
        for low in range(0, len(picked), 512):
            own = picked[low : low + 512]
            n = size[own]
            ids = rows[np.repeat(bounds[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            at = np.repeat(np.arange(len(own)), n)
            mean = np.add.reduceat(table[ids], np.cumsum(n) - n) / n[:, None]
            logits = mean @ softmax + bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), toxic[own].astype(int)] -= 1
            p /= len(own)
            back = (p @ softmax.T / n[:, None])[at]
            touched, where = np.unique(ids, return_inverse=True)
            steep = np.column_stack([np.bincount(where, weights=back[:, k], minlength=len(touched)) for k in range(WIDTH)])
            for k, (value, gradient, rate) in enumerate(((softmax, mean.T @ p, 0.1), (bias, p.sum(0), 0.1))):
                seen[k + 1] += gradient**2
                value -= rate * gradient / np.sqrt(seen[k + 1])
            seen[0][touched] += steep**2
            table[touched] -= 0.3 * steep / np.sqrt(seen[0][touched])
    weight = (table @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
    return _placed(Model(weight, float(bias[1] - bias[0])), rows, bounds, owner, labels)


def _placed(model: Model, rows: np.ndarray, bounds: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> Model:
    """Shift the bias so that 0.5 parts toxic from clean documents best, by their worst segments."""
    score = _averages(model.weight, rows, bounds)
    worst = np.full(len(labels), -np.inf)
    np.maximum.at(worst, owner, score)
    known = np.isfinite(worst)
    x, y = worst[known], labels[known] == 1
    order = np.argsort(x)
    x, y = x[order], y[order]
    # errors if everything above place i is called toxic, per kind
    missed = np.r_[0, np.cumsum(y)] / max(y.sum(), 1)
    wrong = np.r_[(~y).sum() - np.r_[0, np.cumsum(~y)]] / max((~y).sum(), 1)
    best = np.flatnonzero(missed + wrong == (missed + wrong).min())
    at = best[len(best) // 2]
    edge = x[at] if at == 0 else x[-1] if at == len(x) else (x[at - 1] + x[at]) / 2
    return Model(model.weight, -float(edge))


# ---- the operator ---------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> Model:
    known = learn.labelled(labels, "toxic")
    chosen = learn.drawn(known.where("label = 1"), toxic).union(learn.drawn(known.where("label = 0"), clean))
    found = durable(
        b.text_rows(docs).where(F.octet_length("text") <= LONGEST)
        .join(F.broadcast(chosen), "doc_id")  # bounded by `toxic` + `clean`
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    )
    total = found.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    share = int(min(1.0, TRAIN_BYTES / total) * (1 << 30))
    rows = found.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) < share)
    rows = rows.orderBy("doc_id").select("text", "label").collect()
    return fit([r["text"] for r in rows], np.array([r["label"] for r in rows], np.int64))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score reaches `cut`)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                scores = pa.array(model.value.score(piece["text"]))
                yield pa.RecordBatch.from_arrays([piece["doc_id"], scores], ["doc_id", "score"])

    return b.text_rows(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        learn.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )
