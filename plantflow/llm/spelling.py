"""Grouping of spelling variants with blocked Gram matrices of letter counts.

Words are runs of Latin letters of all texts, counted in Spark: every task counts its own words, the counts are
added up by word. Two words are near if one inserted, deleted or replaced code point makes one the other.

One edit changes the letter counts by a vector of squared length one (inserted, deleted) or two (replaced). For a
block of words of length n and n + 1, the NumPy product of its letter-count matrix with itself (a Gram matrix) gives
the squared distances of all pairs of the block at once; pairs at most two apart are kept and then verified edit by
edit on their code points.

Blocks are dealt so that no pair is lost: an edit leaves either the first half of the shorter word or the rest of it
in place, so words meet at (n, first half) and at (n, rest), as the shorter word (length n) or the longer one
(n + 1); a pair that meets at both counts at the first. Small groups share a block of up to `BLOCK` words. A group of
more than `TILE` words (a beginning that very many words share) is dealt into tiles, and each pair of tiles is a
group of its own. What leaves a task is a row a word: how many near words it has there, and the best of them.

A word's form is its near word of the largest count, if that is at least twice the word's own; forms are followed to
their end by doubling steps, each a join.

Edge cases: a null text has no words; a row without doc_id is hashed as if the id were empty; repeated rows count
each; words that the hash shortens count as what is left of them, even if that is another word; × and ÷ are letters
here, since they lie in the range; texts and words of any length are taken whole; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantflow.llm import blocks as b
from plantflow.session import durable

CHANGED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
BLOCK = 256
CELLS = 4 << 20  # code points of a block of small groups
TILE = 4_096
PART_ROWS = 50_000
HELD_WORDS = 400_000


# ---- counting -------------------------------------------------------------------------------------


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of a text in UTF-8; A-Z lower-cased."""
    line = np.frombuffer(text.lower(), np.uint8).copy()
    lead = line == 0xC3
    letter = ((line >= 0x61) & (line <= 0x7A)) | lead
    letter[1:] |= lead[:-1]
    line[~letter] = 0x20
    return line.tobytes().split()


def altered(prefix: int, run: bytes) -> bytes:
    """The run, or what is left of it where the CRC-32 of `<doc_id>:<run>` says so; `prefix` is that of `<doc_id>:`."""
    code = zlib.crc32(run, prefix)
    if code % CHANGED:
        return run
    letters = run.decode()
    at = code % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def occurrences(docs: DataFrame) -> DataFrame:
    """word and n of each task: how often it met the word. A word may come from several tasks."""

    def rows(counts: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in counts.items() if len(w) >= LEAST_LENGTH and len(w.decode()) >= LEAST_LENGTH}
        words = pa.array(list(kept), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.large_binary())):
                data = text.as_py()
                if not data:
                    continue
                prefix = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
                for word, n in Counter(runs(data)).items():
                    counts[word if zlib.crc32(word, prefix) % CHANGED else altered(prefix, word)] += n
                if len(counts) > HELD_WORDS:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return b.text_rows(docs).mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n: words of enough code points that occur often enough."""
    return occurrences(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---- pairs ----------------------------------------------------------------------------------------


def meetings(words: DataFrame) -> DataFrame:
    """Every word at the four places where it may meet a near one: side (0 first half, 1 rest), size (length of the
    shorter words there) and the text they share."""
    size = F.length("word")
    at = []
    for shorter in (size, size - 1):  # as the shorter word, as the longer
        half = F.floor(shorter / 2).cast("int")
        rest = shorter - half
        at.append(F.struct(F.lit(0).alias("side"), shorter.alias("size"), F.substring("word", F.lit(1), half).alias("shared")))
        at.append(F.struct(F.lit(1).alias("side"), shorter.alias("size"), F.substring("word", size - rest + 1, rest).alias("shared")))
    return words.select("word", "n", F.explode(F.array(*at)).alias("m")).select("word", "n", "m.*")


def dealt(words: DataFrame) -> DataFrame:
    """The meetings in parts, each group of a part whole: `part`, `owner` (the group), and `tile`, the tile of a large
    group that the row stands for there (0 elsewhere). Groups of one length of word are left out."""
    met = durable(meetings(words))
    key = ["side", "size", "shared"]
    groups = met.groupBy(*key).agg(F.count("*").alias("rows"), F.min(F.length("word")).alias("low"))
    # a pair needs a word of the shorter length, and another one
    groups = groups.where((F.col("rows") > 1) & (F.col("low") == F.col("size")))
    groups = durable(groups.select(*key, "rows", F.ceil(F.col("rows") / TILE).cast("int").alias("tiles")))
    total = groups.agg(F.sum(F.col("rows") * F.col("tiles"))).first()[0] or 0
    parts = max(8, -(-total // PART_ROWS))
    met = met.join(groups, key)
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    pair = F.transform(other, lambda x: F.struct(F.least(own, x).alias("a"), F.greatest(own, x).alias("b")))
    met = met.select("word", "n", *key, own.alias("tile"), F.explode(pair).alias("pair"))
    # two tiles of one large group make a group of their own; each tile also meets itself
    owner = F.xxhash64(*key, "pair.a", "pair.b")
    placed = met.select("word", "n", "side", "size", "tile", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), owner.alias("owner"))
    return placed.withColumn("part", F.pmod(F.xxhash64("owner"), F.lit(parts)).cast("int"))


def letters_of(words: list[str]) -> np.ndarray:
    """Code points, one row a word, 0 behind its end."""
    size = max(map(len, words))
    line = np.frombuffer("".join(w.ljust(size, "\0") for w in words).encode("utf-32-le"), np.uint32)
    return line.reshape(len(words), size)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each word holds each letter; letters beyond the Latin ones share columns, which loses no near pair."""
    column = np.where(letters <= 0x7A, letters.astype(np.int64) - 0x61, 26 + letters.astype(np.int64) % 64) % 90
    row, place = np.nonzero(letters)
    counts = np.bincount(row * 90 + column[row, place], minlength=len(letters) * 90).reshape(-1, 90)
    return counts.astype(np.float32 if letters.shape[1] < 2_000 else np.float64)  # products are exact


def one_edit(short: np.ndarray, long: np.ndarray, size: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether one edit makes each row of `short` (of `size` code points) the row of `long` (as many or one more)."""
    width = min(short.shape[1], long.shape[1])
    place = np.arange(width)
    inside = place < size[:, None]
    unlike = (short[:, :width] != long[:, :width]) & inside
    replaced = ~longer & (unlike.sum(1) == 1)
    # one more: alike up to the first difference, and alike from there on if the longer one skips a letter
    first = np.where(unlike.any(1), unlike.argmax(1), size)
    shifted = np.zeros((len(short), width), np.uint32)
    shifted[:, : long.shape[1] - 1] = long[:, 1 : width + 1]
    behind = (short[:, :width] != shifted) & inside & (place >= first[:, None])
    return replaced | (longer & ~behind.any(1))


def near_pairs(words: list[str], owner: np.ndarray, side: np.ndarray, size: np.ndarray, apart: np.ndarray, tile: np.ndarray):
    """Places (left, right) of near words that meet in a group; rows sorted by (size, owner).

    `apart` marks rows of a group of two tiles, whose rows of one tile meet elsewhere.
    """
    left, right = [], []
    length = np.array([len(w) for w in words])
    group_ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) + 1 if len(words) else np.zeros(0, np.int64)
    low = g = 0
    while low < len(words):
        # one group, and as many more whole groups as fit a block
        g += 1
        while g < len(group_ends) and group_ends[g] - low <= BLOCK and (group_ends[g] - low) * (size[group_ends[g] - 1] + 1) <= CELLS:
            g += 1
        high = int(group_ends[g - 1])
        for i in range(low, high, BLOCK):
            own = letters_of(words[i : min(i + BLOCK, high)])
            held = letter_counts(own)
            for j in range(i, high, BLOCK):
                other = own if i == j else letters_of(words[j : min(j + BLOCK, high)])
                with_held = held if i == j else letter_counts(other)
                distance = (held * held).sum(1)[:, None] + (with_held * with_held).sum(1) - 2 * (held @ with_held.T)
                x, y = np.nonzero(distance <= 2)
                meet = (x + i < y + j) & (owner[x + i] == owner[y + j]) & ~(apart[x + i] & (tile[x + i] == tile[y + j]))
                meet &= (length[x + i] == size[x + i]) | (length[y + j] == size[y + j])
                for turned in (False, True):  # the shorter word first
                    pick = meet & ((length[x + i] > length[y + j]) == turned)
                    a, b_ = (y[pick], x[pick]) if turned else (x[pick], y[pick])
                    one, two, at, to = (other, own, j, i) if turned else (own, other, i, j)
                    same = one_edit(one[a], two[b_], length[a + at], length[b_ + to] > length[a + at])
                    # what shares the first half as well is counted there
                    width = min(one.shape[1], two.shape[1])
                    half = np.arange(width) < (length[a + at] // 2)[:, None]
                    same &= (side[a + at] == 0) | ((one[a][:, :width] != two[b_][:, :width]) & half).any(1)
                    left.append(a[same] + at)
                    right.append(b_[same] + to)
        low = high
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _near(table: pa.Table) -> pa.Table:
    """Of each word of a part: how many near words it has there, and of those the one of largest n, then smallest."""
    own = np.asarray(table["owner"])
    order = np.lexsort((own, np.asarray(table["size"])))
    table = table.take(pa.array(order))
    words = table["word"].to_pylist()
    column = {n: np.asarray(table[n]) for n in ("n", "owner", "side", "size", "tile", "a", "b")}
    left, right = near_pairs(
        words, column["owner"], column["side"], column["size"], column["a"] != column["b"], column["tile"]
    )
    ranks = {w: i for i, w in enumerate(sorted(set(words)))}  # code-point order
    names = list(ranks)
    rank = np.array([ranks[w] for w in words], np.int64)
    one, two = rank[np.r_[left, right]], np.r_[right, left]
    order = np.lexsort((rank[two], -column["n"][two], one))
    one, two = one[order], two[order]
    word, bounds = b.slices(one)
    best = two[bounds[:-1]]
    return pa.table(
        {
            "word": pa.array([names[i] for i in word.tolist()], pa.string()),
            "n_near": pa.array(np.diff(bounds)),
            "form": pa.array([words[i] for i in best.tolist()], pa.string()),
            "form_n": pa.array(column["n"][best].astype(np.int64)),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and its near word of largest n (`best`, `best_n`; ties: the smallest), for words that have any."""
    found = dealt(words).groupBy("part").applyInArrow(_near, "word string, n_near long, form string, form_n long")
    first = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
    return merged.select("word", "n_near", F.col("b.form").alias("best"), F.col("b.form_n").alias("best_n"))


# ---- forms ----------------------------------------------------------------------------------------


def last_forms(forms: DataFrame) -> DataFrame:
    """word and root: of rows (word, form), the form at the end of each word's chain; chains have no cycles.

    Every step joins each word's furthest form so far with that form's own, which doubles the way.
    """
    here = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        there = here.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = here.join(there, "root", "left")
        further = durable(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        here = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return here


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (see above)."""
    words = durable(vocabulary(docs))
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= 2 * F.col("n")
    named = durable(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    roots = last_forms(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
