"""Byte-level BPE encoding and decoding with a contiguous rank array.

A text is cut into words by the split pattern of byte-level vocabularies; each word is encoded on its own. A short
word lies in two contiguous arrays: its parts (one byte each at first), and the rank of the merge of each part with
the next. The array is scanned for its least rank, leftmost first; the boundary between those two parts is deleted,
and the ranks beside the new part are looked up again, until no merge is left. The scans of all new words of a block
run together, one row a word. A word of more than `SHORT` bytes would be scanned too often; its ranks lie in a heap,
with the same result. Words that were met before are looked up.

Special tokens of the file are found in the text first, as the file's own library does by default; a special
token's text becomes its id.

Edge cases: a null text is encoded as an empty one, with no ids; texts are whole, whatever their length; decoding
joins the bytes of all ids and replaces what is not UTF-8; ids without a token, and null ones, give nothing;
repeated rows stay rows of their own; other columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from plantflow.llm import blocks as b
from plantflow.llm import learn

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# How byte-level vocabularies of this family cut a text into words (fixed by the vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters and numbers younger than Unicode 16, which such libraries take for neither (fixed values; first and last).
YOUNGER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
SHORT = 128
KNOWN = 1 << 19
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in set(shown)]
    letters = {x: chr(x) for x in shown} | {x: chr(256 + i) for i, x in enumerate(hidden)}
    return [letters[x] for x in range(256)]


class Vocabulary:
    """Ids of bytes, merges as sorted pair keys with their ranks, the bytes of each id, and special tokens."""

    def __init__(self, data: bytes):
        held = json.loads(data)
        model, before = held["model"], held["pre_tokenizer"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        if model["type"] != "BPE" or any(model.get(k) for k in plain) or model.get("ignore_merges") or held.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("words are cut in another way")
        odd = [t for t in held["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd:
            raise ValueError(f"special tokens with conditions: {odd}")
        letters = byte_letters()
        code = {letter: x for x, letter in enumerate(letters)}
        ids = model["vocab"]
        self.byte_ids = np.array([ids[x] for x in letters], np.int32)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([ids[x] for x, _ in merges], np.int64)
        right = np.array([ids[y] for _, y in merges], np.int64)
        self.merged = np.array([ids[x + y] for x, y in merges], np.int32)
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int32)

        surface = {i: bytes(code[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        surface |= {i: token.encode() for token, i in self.special.items()}
        size = max(surface) + 1
        held_bytes = [surface.get(i, b"") for i in range(size)]
        self.sizes = np.array([len(x) for x in held_bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.surface = np.frombuffer(b"".join(held_bytes), np.uint8)
        self.numerals = [str(i) for i in range(size)]
        self._forget()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("slots", "flat", "ends", "pairs", "split", "careful", "younger", "marks")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        """Start the table of known words again."""
        self.slots: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.pairs: dict[int, int] | None = None
        self.split = regex.compile(SPLIT)
        younger = "".join(rf"\U{a:08x}-\U{z:08x}" for a, z in YOUNGER)
        self.younger = regex.compile(f"[{younger}]")
        older = SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{younger}]]")
        older = older.replace(r"?\p{L}", rf"?[\p{{L}}--[{younger}]]").replace(r"?\p{N}", rf"?[\p{{N}}--[{younger}]]")
        self.careful = regex.compile(older, regex.V1)
        longest = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None

    # ---- encoding

    def words(self, text: str) -> list[str]:
        split = self.split if text.isascii() or not self.younger.search(text) else self.careful
        if self.marks is None or not any(mark in text for mark in self.special):
            return split.findall(text)
        out = []
        for i, piece in enumerate(self.marks.split(text)):
            out += [piece] if i % 2 else split.findall(piece)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        if len(self.slots) > KNOWN:
            self._forget()
        found = [self.words(t) if t else [] for t in texts]
        every = list(chain.from_iterable(found))
        self._learn(list(set(every) - self.slots.keys()))
        owners = np.repeat(np.arange(len(found)), [len(w) for w in found])
        slots = np.fromiter(map(self.slots.__getitem__, every), np.int64, len(every))
        starts, ends = self.ends[slots], self.ends[slots + 1]
        ids = self.flat[_spread(starts, ends - starts)]
        return ids, np.bincount(owners, weights=ends - starts, minlength=len(found)).astype(np.int64)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        held = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(x) for x in held])
        parts: list[np.ndarray | None] = [None] * len(words)
        for w, word in enumerate(words):
            if word in self.special:
                parts[w] = np.array([self.special[word]], np.int32)
            elif size[w] > SHORT:
                parts[w] = self._long(held[w])
        low = 0
        for high in (4, 8, 12, 16, 24, 32, 64, SHORT):  # words of about one length share an array
            at = [int(i) for i in np.flatnonzero((size > low) & (size <= high)) if parts[i] is None]
            low = high
            if at:
                for i, ids in zip(at, self._short([held[i] for i in at], size[at], high)):
                    parts[i] = ids
        base = len(self.slots)
        self.slots.update(zip(words, range(base, base + len(words))))
        self.flat = np.concatenate([self.flat, *parts])
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum([len(p) for p in parts])]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; NONE if there is no merge, or no part (below zero)."""
        if not len(self.keys):
            return np.full(left.shape, NONE)
        key = (left.astype(np.int64) << 32) | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[place] == key) & (left >= 0) & (right >= 0), self.ranks[place], NONE)

    def _short(self, words: list[bytes], size: np.ndarray, width: int) -> list[np.ndarray]:
        """Parts of words of at most `width` bytes: rows of parts, and of ranks of neighbours."""
        count = len(words)
        line = np.frombuffer(b"".join(words), np.uint8)
        parts = np.full((count, width + 1), -1, np.int32)
        parts[np.repeat(np.arange(count), size), _spread(np.zeros(count, np.int64), size)] = self.byte_ids[line]
        ranks = np.full((count, width + 1), NONE)
        ranks[:, :width] = self._rank(parts[:, :-1], parts[:, 1:])
        row, column = np.arange(count), np.arange(width)
        out: list[np.ndarray] = [None] * count  # type: ignore[list-item]
        while len(row):
            place = ranks.argmin(1)
            every = np.arange(len(row))
            least = ranks[every, place]
            done = least == NONE
            for i in np.flatnonzero(done).tolist():
                out[row[i]] = parts[i, : size[i]]
            live = ~done
            row, place, least, size = row[live], place[live], least[live], size[live] - 1
            parts, ranks, every = parts[live], ranks[live], np.arange(len(row))
            # delete the boundary: everything behind it moves one place to the left
            source = column + (column > place[:, None])
            ranked = column + (column >= place[:, None])
            parts[:, :width] = np.take_along_axis(parts, source, 1)
            ranks[:, :width] = np.take_along_axis(ranks, ranked, 1)
            parts[every, place] = self.merged[least]
            # the ranks of the new part with its neighbours
            ranks[every, place] = self._rank(parts[every, place], parts[every, place + 1])
            inner = np.flatnonzero(place > 0)
            ranks[inner, place[inner] - 1] = self._rank(parts[inner, place[inner] - 1], parts[inner, place[inner]])
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """The same merges in the same order, from a heap of (rank, place)."""
        line = self.byte_ids[np.frombuffer(word, np.uint8)]
        parts, count = line.tolist(), len(line)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        first = self._rank(line[:-1], line[1:])
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NONE]
        ranks = first.tolist() + [int(NONE)]
        heapq.heapify(heap)
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        pair, none = self.pairs, int(NONE)

        def refresh(i: int) -> None:
            j = after[i]
            ranks[i] = pair.get((parts[i] << 32) | parts[j], none) if j < count else none
            if ranks[i] != none:
                heapq.heappush(heap, (ranks[i], i))

        while heap:
            rank, i = heapq.heappop(heap)
            if ranks[i] != rank or parts[i] < 0:
                continue
            j = after[i]
            parts[i], parts[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            ranks[j] = none
            if after[i] < count:
                before[after[i]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return np.array([p for p in parts if p >= 0], np.int32)

    # ---- decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        ids = np.asarray(ids, np.int64)
        known = (ids >= 0) & (ids < len(self.sizes))
        sizes = np.where(known, self.sizes[np.where(known, ids, 0)], 0)
        data = self.surface[_spread(self.starts[np.where(known, ids, 0)], sizes)].tobytes()
        running = np.r_[0, np.cumsum(sizes)]
        ends = np.cumsum(counts)
        return [data[low:high].decode("utf-8", "replace") for low, high in zip(running[ends - counts].tolist(), running[ends].tolist())]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each start, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


# ---- the operators --------------------------------------------------------------------------------


def load(spark: SparkSession, path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary at a path that Spark can read."""
    return Vocabulary(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))


def encode(docs: DataFrame, vocabulary: Vocabulary, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and ids, and in a struct `row` the columns named in `carried`."""
    rows = b.text_rows(docs, *carried)
    names = rows.columns
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                ids, counts = shared.value.encode(piece["text"].to_pylist())
                column = b.list_column(ids, np.r_[0, np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays([*(piece[n] for n in names), column], [*names, "ids"])

    return rows.mapInArrow(run, b.schema(rows, "ids array<int>"))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The frame with a column `decoded`: the text that its `ids` stand for."""
    names = encoded.columns
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            known = np.asarray(ids.is_valid())
            counts = np.where(known, np.asarray(ids.value_lengths().fill_null(0)), 0).astype(np.int64)
            texts = shared.value.decode(np.asarray(ids.flatten().fill_null(-1)), counts)
            column = pa.array([t if k else None for t, k in zip(texts, known.tolist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, "decoded"])

    return encoded.mapInArrow(run, b.schema(encoded, "decoded string"))


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each document encoded and decoded again: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas),
    decoded_sha256 (of the decoded text in UTF-8) and round_trip."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch):
                texts = [t or "" for t in piece["text"].to_pylist()]
                ids, counts = shared.value.encode(texts)
                again = shared.value.decode(ids, counts)
                numerals = list(map(shared.value.numerals.__getitem__, ids.tolist()))
                ends = np.cumsum(counts).tolist()
                columns = [
                    piece["doc_id"],
                    pa.array(counts),
                    pa.array([_sha(",".join(numerals[e - n : e])) for e, n in zip(ends, counts.tolist())], pa.string()),
                    pa.array([_sha(a) for a in again], pa.string()),
                    pa.array([t == a for t, a in zip(texts, again)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return b.text_rows(docs).mapInArrow(run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
