"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A model file gives pieces with log scores. Text is written with the marker for every blank, one marker in
front if the model says so, and cut into the pieces whose scores add up to the most; of equally good cuts the
one whose last piece starts first (the longer last piece). A character that no piece stands for costs the
smallest score less 10 and becomes its UTF-8 bytes, if the model has byte pieces, else the unknown piece.

Pieces are held in a double-array trie (base, check, value) shared with all tasks. Encoding works on a bounded
piece of a batch at a time: all places walk down the trie together; distinct words are cut once; the best cut
of all of them is found place by place, for all words at once. Words can be cut on their own if no piece of
the model goes on behind a blank; otherwise whole texts are.

Decoding joins the pieces, turns byte pieces back into bytes and markers into blanks, and takes the marker in
front away. It returns the text exactly, unless the text itself holds the marker character, which reads as a
blank, or the model has no byte pieces and the text a character it does not know.

Edge cases: a null text has null ids and decodes to null; an empty text has no ids; repeated rows are encoded
each; columns named in `carried` come along, others are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plantflow.llm import blocks as b
from plantflow.llm import learn

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_COST = 10.0
PIECE_BYTES = 1 << 18  # text encoded at once
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
_MARK = np.frombuffer(MARKER.encode(), np.uint8)
_STOP = 0xFF  # never in UTF-8


# ---- the model file -------------------------------------------------------------------------------


def _fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[wire]
            yield number, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Trie:
    """Child of state s by byte c is base[s] + c, if check there is s; value is the piece that ends at a state."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(keys: dict[bytes, int]) -> Trie:
    names = sorted(keys)
    size = sum(map(len, names)) + 4096
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = -2
    # where to look for room, by the number of children: room left behind is too narrow for as many
    hint = [1] * 257
    todo = [(0, 0, len(names), 0)]
    while todo:
        state, first, last, depth = todo.pop()
        if first < last and len(names[first]) == depth:
            value[state] = keys[names[first]]
            first += 1
        if first == last:
            continue
        bounds, codes = [first], [names[first][depth]]
        for i in range(first + 1, last):
            if names[i][depth] != codes[-1]:
                bounds.append(i)
                codes.append(names[i][depth])
        bounds.append(last)
        at = hint[len(codes)]
        while True:
            window = 64 if len(codes) == 1 else 1024
            if at + window + 512 > len(check):
                base, check, value = (np.r_[x, np.full(len(x), e, np.int32)] for x, e in ((base, 0), (check, -1), (value, -1)))
            fits = np.ones(window, bool)
            for c in codes:
                fits &= check[at + c : at + c + window] == -1
            if fits.any():
                at += int(fits.argmax())
                break
            at += window
        hint[len(codes)] = at
        base[state] = at
        for c, i, j in zip(codes, bounds, bounds[1:]):
            check[at + c] = state
            todo.append((at + c, i, j, depth + 1))
    used = int(np.flatnonzero(check != -1)[-1]) + 257
    return Trie(base[:used].copy(), check[:used].copy(), value[:used].copy())


class Model:
    """Pieces, scores and rules of a model file."""

    def __init__(self, data: bytes):
        pieces, spec = [], {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1], struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 3:
                spec |= dict(_fields(value))
        if spec.get(2):
            raise ValueError("models that rewrite characters are not supported")
        self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.texts = [p for p, _, _ in pieces]
        self.kinds = np.array([k for _, _, k in pieces])
        normal = [s for _, s, k in pieces if k == NORMAL]
        most = max(normal, default=0.0)
        self.scores = np.array([len(p) * most - 0.1 if k == USER else s for p, s, k in pieces])
        unknown = [i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN]
        self.unknown, self.unknown_score = unknown[0], min(normal, default=0.0) - UNKNOWN_COST
        # byte pieces are named <0x00> to <0xFF>
        self.byte_ids = np.full(256, -1, np.int32)
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        self.fallback = bool((self.byte_ids >= 0).all())
        own = {p: i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        self.trie = double_array(own)
        mark = MARKER.encode()
        self.by_words = not any(mark in _behind(p, mark) for p in own)
        surface = [
            bytes([int(p[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p
            for p, _, k in pieces
        ]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.sizes = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    # ---- encoding

    def normal(self, text: str) -> bytes:
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return b""
        return ((MARKER if self.prefix else "") + text.replace(" ", MARKER)).encode()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's number of ids."""
        whole = [self.normal(t or "") for t in texts]
        size = np.array([len(w) for w in whole], np.int64)
        buffer = np.frombuffer(b"".join(whole), np.uint8)
        first = (np.cumsum(size) - size)[size > 0]
        begins = np.zeros(len(buffer), bool)
        if self.by_words and len(buffer) > 2:
            mark = np.zeros(len(buffer), bool)
            mark[:-2] = (buffer[:-2] == _MARK[0]) & (buffer[1:-1] == _MARK[1]) & (buffer[2:] == _MARK[2])
            begins = mark.copy()
            begins[3:] &= ~mark[:-3]
        begins[first] = True
        start = np.flatnonzero(begins)
        length = np.diff(np.r_[start, len(buffer)])
        ids, counts, unit = self._cut_distinct(buffer, start, length)
        # ids of every unit in turn
        bounds = np.cumsum(counts) - counts
        every = counts[unit]
        out = ids[_spread(bounds[unit], every)]
        text = np.searchsorted(np.cumsum(size), start, "right")
        return out, np.bincount(text, weights=every, minlength=len(texts)).astype(np.int64)

    def _cut_distinct(self, buffer, start, length):
        """Cut each distinct unit once: ids, number of ids of each, and which one every unit is."""
        digest = b.Rolling(b.BYTE_VALUES[buffer], b.BASES[0]).spans(start, start + length)
        _, chosen, unit = np.unique(digest, return_index=True, return_inverse=True)
        like = chosen[unit]
        same = (length[like] == length).all()
        if same:
            at = _spread(start, length)
            same = np.array_equal(buffer[at], buffer[_spread(start[like], length)])
        if not same:  # two units with one digest: cut every unit
            chosen = unit = np.arange(len(start))
        ids, counts = self._cut(buffer, start[chosen], length[chosen])
        return ids, counts, unit

    def _cut(self, buffer, start, length):
        """Best cut of each unit."""
        # units apart from each other by a byte that no piece holds
        begin = np.cumsum(length + 1) - length - 1
        line = np.full(int(length.sum() + len(length)) + 1, _STOP, np.uint8)
        line[_spread(begin, length)] = buffer[_spread(start, length)]
        opens = np.flatnonzero((line & 0xC0 != 0x80) & (line != _STOP))  # where characters start
        low, high, piece = self._matches(line, opens)
        score = self.scores[piece]
        step = 1 + (line[opens] >= 0xC0).astype(np.int64) + (line[opens] >= 0xE0) + (line[opens] >= 0xF0)
        known = np.zeros(len(line), bool)
        width = np.zeros(len(line), np.int64)
        width[opens] = step
        known[low[high - low == width[low]]] = True
        lone = opens[~known[opens]]
        low, high = np.r_[low, lone], np.r_[high, lone + width[lone]]
        piece = np.r_[piece, np.full(len(lone), self.unknown)]
        score = np.r_[score, np.full(len(lone), self.unknown_score)]

        unit = np.searchsorted(begin, low, "right") - 1
        order = np.lexsort((low, high, high - begin[unit]))
        low, high, piece, score, unit = (x[order] for x in (low, high, piece, score, unit))
        best = np.full(len(line) + 1, -np.inf)
        best[begin] = 0.0
        back = np.zeros(len(line) + 1, np.int64)
        taken = np.zeros(len(line) + 1, np.int32)
        _, levels = b.slices(high - begin[unit])
        for i, j in zip(levels.tolist(), levels[1:].tolist()):
            value = best[low[i:j]] + score[i:j]
            ends, bounds = b.slices(high[i:j])
            top = np.maximum.reduceat(value, bounds[:-1])
            at = np.flatnonzero(value == np.repeat(top, np.diff(bounds)))
            at = at[np.searchsorted(at, bounds[:-1])]
            best[ends], back[ends], taken[ends] = top, low[i:j][at], piece[i:j][at]

        # back from the ends, all units at once
        place, owner = begin + length, np.arange(len(begin))
        units, ids, places = [], [], []
        live = place > begin
        place, owner = place[live], owner[live]
        while len(place):
            units.append(owner)
            ids.append(taken[place])
            places.append(back[place])
            place = back[place]
            live = place > begin[owner]
            place, owner = place[live], owner[live]
        if not units:
            return np.zeros(0, np.int32), np.zeros(len(begin), np.int64)
        units, ids, places = np.concatenate(units), np.concatenate(ids), np.concatenate(places)
        order = np.argsort(places, kind="stable")
        units, ids, places = units[order], ids[order], places[order]
        times = np.ones(len(ids), np.int64)
        if self.fallback:
            lost = np.flatnonzero(ids == self.unknown)
            times[lost] = width[places[lost]]
            ids = np.repeat(ids, times)
            at = _spread(np.cumsum(times)[lost] - times[lost], times[lost])
            ids[at] = self.byte_ids[line[_spread(places[lost], times[lost])]]
        return ids, np.bincount(units, weights=times, minlength=len(begin)).astype(np.int64)

    def _matches(self, line, opens):
        """Start, end and piece of every piece found in the line."""
        lows, highs, found = [], [], []
        place, state, depth = opens, np.zeros(len(opens), np.int32), 0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        while len(place):
            to = base[state] + line[place + depth]
            go = check[to] == state
            place, state = place[go], to[go]
            depth += 1
            piece = value[state]
            ends = piece >= 0
            lows.append(place[ends])
            highs.append(place[ends] + depth)
            found.append(piece[ends])
        if not lows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(lows), np.concatenate(highs), np.concatenate(found)

    # ---- decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        sizes = self.sizes[ids]
        data = self.surface[_spread(self.starts[ids], sizes)].tobytes()
        running = np.r_[0, np.cumsum(sizes)]
        ends = np.cumsum(counts)
        out = []
        for low, high in zip(running[ends - counts].tolist(), running[ends].tolist()):
            text = data[low:high].decode("utf-8", "replace").replace(MARKER, " ")
            out.append(text[1:] if self.prefix and text.startswith(" ") else text)
        return out


def _behind(piece: bytes, mark: bytes) -> bytes:
    while piece.startswith(mark):
        piece = piece[len(mark) :]
    return piece


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each start, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


# ---- the operators --------------------------------------------------------------------------------


def load(spark: SparkSession, path: str = MODEL) -> Model:
    """The model at a path that Spark can read."""
    return Model(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))


def _id_column(ids: np.ndarray, counts: np.ndarray, null: pa.Array) -> pa.Array:
    bounds = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32()), mask=null)


def encode(docs: DataFrame, model: Model, carried: tuple[str, ...] = (), check: bool = False) -> DataFrame:
    """doc_id, text and ids, and in a struct `row` the columns named in `carried`.

    With `check` the ids are decoded at once, and a column `round_trip` says whether that gave the text; the
    text itself is then left out.
    """
    rows = b.text_rows(docs, *carried)
    names = [c for c in rows.columns if not (check and c == "text")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch, most=PIECE_BYTES):
                texts = piece["text"].to_pylist()
                ids, counts = shared.value.encode(texts)
                columns = [*(piece[n] for n in names), _id_column(ids, counts, piece["text"].is_null())]
                if check:
                    again = shared.value.decode(ids, counts)
                    columns.append(pa.array([t is None or t == a for t, a in zip(texts, again)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids", *(["round_trip"] if check else [])])

    more = "ids array<int>" + (", round_trip boolean" if check else "")
    return rows.mapInArrow(run, b.schema(rows.select(*names), more))


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """The frame with a column `decoded`: the text that its `ids` stand for."""
    names = encoded.columns
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            known = np.asarray(ids.is_valid())
            counts = np.where(known, np.asarray(ids.value_lengths().fill_null(0)), 0).astype(np.int64)
            texts = shared.value.decode(np.asarray(ids.flatten()), counts)
            column = pa.array([t if k else None for t, k in zip(texts, known.tolist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, "decoded"])

    return encoded.mapInArrow(run, b.schema(encoded, "decoded string"))


def digests(docs: DataFrame, model: Model) -> DataFrame:
    """Each document encoded and decoded again: doc_id, n_tokens, n_byte_tokens, round_trip, and SHA-256 digests of
    its ids (as little-endian 32-bit numbers) and of the decoded text; a null text has null digests."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, n_byte_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch, most=PIECE_BYTES):
                texts = piece["text"].to_pylist()
                ids, counts = shared.value.encode(texts)
                again = shared.value.decode(ids, counts)
                ends = np.cumsum(counts)
                spelt = np.r_[0, np.cumsum(shared.value.kinds[ids] == BYTE)]
                sums = [
                    (_sha(ids[e - n : e].astype("<i4").tobytes()), _sha(a.encode())) if t is not None else (None, None)
                    for t, a, e, n in zip(texts, again, ends.tolist(), counts.tolist())
                ]
                columns = [
                    piece["doc_id"],
                    pa.array(counts),
                    pa.array(spelt[ends] - spelt[ends - counts]),
                    pa.array([x for x, _ in sums], pa.string()),
                    pa.array([x for _, x in sums], pa.string()),
                    pa.array([t is None or t == a for t, a in zip(texts, again)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return b.text_rows(docs).mapInArrow(run, schema)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
