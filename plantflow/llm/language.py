"""Language identification: a bidirectional gated recurrent network over bytes.

Each byte of a text is read by two gated recurrent layers, one from the left and one from the right, and both
states at a place give a softmax over the languages there. A document's probabilities are the mean over all
its places. Texts are read in strings of `SPAN` bytes, side by side in one batch, each from a zero state; every
byte of every text is read. Gates are piecewise linear (clipped), which keeps a step to a few array
operations. The reset gate acts on the recurrent part of the candidate.

The network is trained in NumPy by backpropagation through time and Adam, on strings drawn from at most about
`SAMPLE` documents of up to `LONGEST` bytes (rows that may be learned from, with a language). Languages are counted
over all rows first, and about equally many documents of each are drawn by a hash of doc_id, so that a rare language
is learned however large the table; equally many strings for each language.

Edge cases: a null text, or one without any letter (a character of a Unicode letter category), is `und` with
score 0; so is every text if nothing can be learned; a row without doc_id is scored, never learned from;
repeated rows are scored each and learned from once; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from plantflow.llm import blocks as b
from plantflow.llm import learn

WIDTH = 8
SPAN = 64
SAMPLE = 3_000
LEAST = 32  # documents of a language drawn at least, if it has as many
LONGEST = 1 << 16
STRINGS = 24_000
BATCH = 256
EPOCHS = 4
LANES = 4_096  # strings read side by side
LETTER = regex.compile(r"\p{L}")


# ---- one direction --------------------------------------------------------------------------------
#
# x: input part of all gates, (3 * WIDTH, steps, lanes): update, reset, candidate
# u: recurrent weights, (3 * WIDTH, WIDTH)


def _gates(x: np.ndarray, h: np.ndarray, u: np.ndarray, bias: np.ndarray):
    r = u @ h
    gates = x[: 2 * WIDTH] + r[: 2 * WIDTH]
    np.clip(gates, 0.0, 1.0, out=gates)
    r = r[2 * WIDTH :] + bias
    c = gates[WIDTH:] * r
    c += x[2 * WIDTH :]
    np.clip(c, -1.0, 1.0, out=c)
    return gates[:WIDTH], gates[WIDTH:], r, c


def forward(x: np.ndarray, u: np.ndarray, bias: np.ndarray, states: np.ndarray) -> None:
    """Fill states, (WIDTH, steps, lanes)."""
    h = np.zeros((WIDTH, x.shape[2]), np.float32)
    for t in range(x.shape[1]):
        z, _, _, c = _gates(x[:, t], h, u, bias)
        c -= h
        c *= z
        h = h + c
        states[:, t] = h


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # (2, 256, 3 * WIDTH): what a byte adds to each gate, for each direction
    recurrent: np.ndarray  # (2, 3 * WIDTH, WIDTH)
    bias: np.ndarray  # (2, WIDTH, 1)
    out: np.ndarray  # (languages, 2 * WIDTH + 1)

    def states(self, strings: np.ndarray) -> np.ndarray:
        """(2 * WIDTH + 1, steps, lanes): both directions' states at every place, and a one."""
        steps, lanes = strings.shape
        both = np.ones((2 * WIDTH + 1, steps, lanes), np.float32)
        for side, order in enumerate((strings, strings[::-1])):
            x = np.empty((3 * WIDTH, steps, lanes), np.float32)
            for k in range(3 * WIDTH):
                np.take(np.ascontiguousarray(self.embed[side, :, k]), order, out=x[k], mode="clip")
            into = both[side * WIDTH : (side + 1) * WIDTH]
            forward(x, self.recurrent[side], self.bias[side], into if side == 0 else into[:, ::-1])
        return both

    def places(self, strings: np.ndarray) -> np.ndarray:
        """(languages, steps, lanes): probabilities at every place."""
        both = self.states(strings)
        logits = (self.out @ both.reshape(2 * WIDTH + 1, -1)).reshape(len(self.languages), *strings.shape)
        logits -= logits.max(0)
        np.exp(logits, out=logits)
        logits /= logits.sum(0)
        return logits

    def pooled(self, texts: pa.Array) -> np.ndarray:
        """(texts, languages): mean over all places of each text; zero for an empty one."""
        buffer, offsets = b.text_buffer(texts)
        size = np.diff(offsets)
        count = -(-size // SPAN)
        of = np.repeat(np.arange(len(size)), count)
        begin = offsets[:-1][of] + SPAN * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
        length = np.minimum(SPAN, offsets[1:][of] - begin)
        total = np.zeros((len(size), len(self.languages)))
        padded = np.concatenate([buffer, np.zeros(SPAN, np.uint8)])
        for low in range(0, len(of), LANES):
            own, n = begin[low : low + LANES], length[low : low + LANES]
            place = np.arange(SPAN)[:, None]
            strings = padded[own[None, :] + place]
            inside = place < n[None, :]
            strings[~inside] = 0
            sums = (self.places(strings) * inside[None]).sum(1)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(of[low : low + LANES], weights=sums[k], minlength=len(size))
        return total / np.maximum(size, 1)[:, None]

    def name(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        lettered = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        pooled = self.pooled(texts)
        best = pooled.argmax(1)
        names = [self.languages[k] if known else "und" for k, known in zip(best, lettered)]
        return names, np.where(lettered, pooled[np.arange(len(best)), best], 0.0).clip(0, 1)


# ---- training -------------------------------------------------------------------------------------


def _backward(x, u, bias, states, outer):
    """Gradients of one direction, given those of its states; forward values are found again step by step."""
    dx = np.zeros_like(x)
    du, db = np.zeros_like(u), np.zeros_like(bias)
    dh = np.zeros_like(states[:, 0])
    for t in range(x.shape[1] - 1, -1, -1):
        h = states[:, t - 1] if t else np.zeros_like(dh)
        z, r, s, c = _gates(x[:, t], h, u, bias)
        dh = dh + outer[:, t]
        dz = dh * (c - h) * ((z > 0) & (z < 1))
        dc = dh * z * (np.abs(c) < 1)
        dr = dc * s * ((r > 0) & (r < 1))
        ds = dc * r
        dx[:, t] = np.concatenate([dz, dr, dc])
        back = np.concatenate([dz, dr, ds])
        du += back @ h.T
        db += ds.sum(1, keepdims=True)
        dh = dh * (1 - z) + u.T @ back
    return dx, du, db


def fit(strings: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Train on strings, (count, SPAN), every place of which has its document's language."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    embed = normal(2, 256, 3 * WIDTH, scale=0.3)
    embed[:, :, : 2 * WIDTH] += 0.5  # the middle of a clipped gate
    net = Network(languages, embed, normal(2, 3 * WIDTH, WIDTH, scale=0.2), np.zeros((2, WIDTH, 1), np.float32), normal(len(languages), 2 * WIDTH + 1, scale=0.2))
    values = [net.embed, net.recurrent, net.bias, net.out]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(epochs):
        order = rng.permutation(len(strings))
        for low in range(0, len(order), BATCH):
            own = order[low : low + BATCH]
            batch = np.ascontiguousarray(strings[own].T)
            both = net.states(batch)
            flat = both.reshape(2 * WIDTH + 1, -1)
            logits = net.out @ flat
            logits -= logits.max(0)
            p = np.exp(logits)
            p /= p.sum(0)
            p = p.reshape(len(languages), *batch.shape)
            p[labels[own], :, np.arange(len(own))] -= 1
            p = p.reshape(len(languages), -1) / p[0].size
            gradients = [np.zeros_like(v) for v in values]
            gradients[3] += p @ flat.T
            outer = (net.out.T @ p).reshape(both.shape)
            for side in range(2):
                text = batch if side == 0 else batch[::-1]
                x = np.moveaxis(net.embed[side][text], -1, 0)
                part = slice(side * WIDTH, (side + 1) * WIDTH)
                states, above = (a[part] if side == 0 else a[part][:, ::-1] for a in (both, outer))
                dx, gradients[1][side], gradients[2][side] = _backward(np.ascontiguousarray(x), net.recurrent[side], net.bias[side], states, above)
                for k in range(3 * WIDTH):
                    gradients[0][side, :, k] = np.bincount(text.reshape(-1), weights=dx[k].reshape(-1), minlength=256)
            step += 1
            for value, gradient, m, v in zip(values, gradients, first, second):
                m += 0.1 * (gradient - m)
                v += 0.01 * (gradient**2 - v)
                value -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def sample_shares(counts: dict[str, int], sample: int) -> dict[str, int]:
    """How much of each language to draw, in parts of 2 ** 30: equally many documents of each.

    What a small language does not need goes to the larger ones, so a language of few documents is drawn whole.
    """
    shares, left = {}, sample
    for i, (language, count) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        wanted = max(left // (len(counts) - i), LEAST)
        shares[language] = (1 << 30) if count <= wanted else int((1 << 30) * wanted / count)
        left -= min(count, wanted)
    return shares


def train(docs: DataFrame, sample: int = SAMPLE) -> Network:
    """Learn from strings of about `sample` documents, or `LEAST` of each language if that is more."""
    known = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~learn.held_out(F.col("doc_id")))
        .where(F.octet_length("text").between(1, LONGEST))
    )
    counted = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()  # a row a language
    shares = sample_shares({r["lang"]: r["n"] for r in counted}, sample)
    if not shares:
        return Network([], *[np.zeros(0)] * 4)
    share = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair]), F.col("lang"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    chosen = (
        known.where(place < share)
        .groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("own")).orderBy("doc_id").select("own.*").collect()
    )
    languages = sorted({r["lang"] for r in chosen})
    rng = np.random.default_rng(11)
    strings, labels = [], []
    for k, language in enumerate(languages):
        texts = [r["text"].encode() for r in chosen if r["lang"] == language]
        for i in range(STRINGS // len(languages)):
            text = texts[i % len(texts)]
            at = int(rng.integers(0, max(1, len(text) - SPAN + 1)))
            strings.append(np.frombuffer(text[at : at + SPAN].ljust(SPAN, b"\0"), np.uint8))
            labels.append(k)
    return fit(np.array(strings), np.array(labels), languages)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score."""
    network = docs.sparkSession.sparkContext.broadcast(train(docs, sample))

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                names, scores = network.value.name(piece["text"])
                yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return b.text_rows(docs).mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", learn.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
