"""BPE against its library, ranked search and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from plantflow.llm import bpe, lexical, spelling

# ---- BPE ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(bpe.VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.VOCABULARY)


rng = random.Random(7)
ODD = [
    "", " ", "\n\n a\n", "<|endoftext|>a <|endoftext|>  b", "<|endoftext|><|endoftext|", "don't 'S we'll it's", "x1²½Ⅷ٣ 12345",
    "a" * 700, " " * 400 + "x", "ab" * 5_000, "é" * 300, "\x1c\x1d x\x85y z　q᠎ w​ ﻿", "日本語 テキスト 😀👩‍👩‍👧", "\x00\x7f",
    "".join(rng.choice("abcdefghij") for _ in range(9_000)), "".join(chr(rng.randrange(0x20, 0x2000)) for _ in range(3_000)),
    "".join(chr(first) + "a1!" for first, _ in bpe.YOUNGER),
]


def test_ids_equal_the_library(vocabulary, library, texts):
    given = [t or "" for _, t in texts] + ODD
    ids, counts = vocabulary.encode(given)
    want = [e.ids for e in library.encode_batch(given, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert vocabulary.decode(ids, counts) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_short_and_long_words_give_one_result(vocabulary):
    words = [("".join(rng.choice("thein ra") for _ in range(n))).encode() for n in range(1, 120)]
    short = vocabulary._short(words, np.array([len(w) for w in words]), 128)
    assert [x.tolist() for x in short] == [vocabulary._long(w).tolist() for w in words]


def test_every_character_is_cut_as_by_the_library(vocabulary):
    cut = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for code in [*range(0x3000), *range(0xFE00, 0x11000), *(x for pair in bpe.YOUNGER for x in pair)]:
        text = f"a{chr(code)}1{chr(code)}!{chr(code)} b"
        assert [len(w) for w in vocabulary.words(text)] == [z - a for _, (a, z) in cut.pre_tokenize_str(text)], hex(code)


def test_known_words_are_forgotten(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 3)
    want, _ = vocabulary.encode(["one two three four", "five"])
    again, _ = vocabulary.encode(["one two three four", "five"])
    assert want.tolist() == again.tolist() and len(vocabulary.slots) == 5


def test_bpe_frames(spark, docs, nothing, vocabulary, library, texts, rows):
    encoded = bpe.encode(docs, vocabulary, carried=("row",))
    decoded = bpe.decode(encoded, vocabulary)
    assert decoded.columns == ["doc_id", "text", "row", "ids", "decoded"]
    assert all(r.decoded == (r.text or "") and r.row.row == 7 for r in decoded.collect())
    want = []
    for k, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        again = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), again)]
        want.append((k, len(ids), *digests, True))
    assert rows(bpe.digests(docs, vocabulary)) == sorted(want, key=repr)
    assert bpe.digests(nothing, vocabulary).collect() == bpe.encode(nothing, vocabulary).collect() == []
    broken = spark.createDataFrame([(None,), ([],), ([None, -5, 10**9, 33],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(broken, vocabulary).collect()] == [None, "", "B"]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(open(bpe.VOCABULARY.replace("byte_bpe_50k", "word_bpe_49k"), "rb").read())


# ---- search ---------------------------------------------------------------------------------------


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def ranked(texts, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in texts]
    size = [sum(c.values()) for _, c in held]
    documents, total = sum(n > 0 for n in size), sum(size)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for (doc, counts), n in zip(held, size):
            score = 0
            for t in set(terms(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * counts[t] // (1000 * counts[t] + 8 * (10 + 90 * n * documents // total)))
            if score:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if gone else doc, -s) for r, (s, gone, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard, block", [(1 << 14, 300), (4 << 20, 1 << 20)])
def test_search(spark, docs, texts, sf_dir, rows, shard, block, monkeypatch):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items += [(1, "Of THE the"), (None, "the of and"), (70, None), (71, ""), (72, "zzzunheard"), (73, " ,.; "), (items[0]), (74, "ÉÉ é a")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)).withColumn("doc_id", F.lit(0))
    monkeypatch.setattr(lexical.index, "__defaults__", (shard,))
    assert rows(lexical.search(docs.repartition(3), frame, 10, block)) == ranked(texts, items)


def test_search_of_copies_and_nothing(spark, nothing, docs, rows):
    copies = [(i, "alpha beta gamma") for i in range(400, 0, -1)] + [(i, "beta " * (i % 7) + "delta") for i in range(500, 900)]
    items = [(1, "alpha"), (2, "beta delta"), (3, "delta beta gamma alpha")]
    ask = spark.createDataFrame(items, "item_id long, text string")
    given = spark.createDataFrame(copies, "doc_id long, text string")
    assert rows(lexical.search(given, ask)) == ranked(copies, items)
    assert lexical.search(nothing, ask).collect() == lexical.search(given, ask.limit(0)).collect() == []
    assert lexical.search(docs.select("doc_id", F.lit(None).cast("string").alias("text")), ask).collect() == []


def test_long_lists_are_skipped():
    """Windows without a document that may be among the best are not added up."""
    size = 64 * 200
    lengths = np.full(size, 50)
    often = np.arange(0, size, 2)
    counts = np.ones(len(often), np.int64)
    counts[:20] = 40
    rare = np.array([6, 8])
    row = {
        "docs": list(range(size)), "lengths": lengths, "terms": np.array([0, 1]), "held": np.array([len(often), 2]),
        "places": np.r_[often, rare], "counts": np.r_[counts, [3, 3]],
    }
    shard = lexical.Shard(row, np.array([700, 9000]), size, 50 * size)
    top, skipped = lexical.Top(2), []
    shard.best(np.array([0, 1]), top, skipped)
    bound = shard.windows(0)[1]
    assert [d for _, d in top.held] == [6, 8]
    assert (bound < top.floor).sum() + len(skipped) >= 199


# ---- spelling -------------------------------------------------------------------------------------


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(texts):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "a" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [] for w in counts}
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    for size, words in by_size.items():
        for a in words:
            near[a] += [b for b in words if edits(a, b)]
            for b in by_size.get(size + 1, []):
                if edits(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def misspelt():
    """A few words with many variants, chains of counts, one beginning that very many words share, odd letters."""
    out = []
    base = ["receive", "separate", "definitely", "àéîõü", "straße×", "aaaaa", "abababab", "Occurrence"]
    for word in base:
        for n in (1, 3, 6, 13, 27):
            letters = list(word)
            if n < 27:
                letters[rng.randrange(len(letters))] = rng.choice("abcdeé")
            if n in (3, 6):
                letters.insert(rng.randrange(len(letters)), rng.choice("xyz"))
            out += ["".join(letters)] * n * 3
    out += [f"commonbeginning{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'q' * (i % 3)}" for i in range(900)] * 3
    out += ["x" * 3_000, "x" * 2_999 + "y", "x" * 2_999] * 3
    rng.shuffle(out)
    return [(i if i % 11 else None, " ".join(out[i * 20 : i * 20 + 20]) + ("." if i % 2 else "")) for i in range(len(out) // 20 + 1)]


@pytest.mark.parametrize("tile, part, block", [(4_096, 50_000, 256), (50, 300, 16)])
def test_spelling(spark, misspelt, docs, texts, rows, monkeypatch, tile, part, block):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "PART_ROWS", part)
    monkeypatch.setattr(spelling, "BLOCK", block)
    given = misspelt + texts
    frame = spark.createDataFrame(given, "doc_id long, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(0))
    want = grouped(given)
    got = spelling.variants(frame.repartition(3)).select("word", "form", "root", "n", "n_near", "form_n")
    assert rows(got) == want
    assert sum(w[1] is not None for w in want) > 30 and any(w[1] and w[1] != w[2] for w in want)


def test_blocks_of_letter_counts_keep_all_near_pairs(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 32)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.choice((6, 7)))) for _ in range(700)})
    ones = np.zeros(len(words), np.int64)
    met = []
    for side in (0, 1):
        keys = {w: w[:3] if side == 0 else w[-3:] for w in words}
        order = sorted(words, key=lambda w: keys[w])
        names = sorted(set(keys.values()))
        owner = np.array([names.index(keys[w]) for w in order])
        left, right = spelling.near_pairs(order, owner, ones + side, ones + 6, ones > 1, ones)
        met += [tuple(sorted((order[a], order[c]))) for a, c in zip(left, right)]
    want = {(a, c) for a in words for c in words if a < c and edits(a, c) and min(len(a), len(c)) == 6}
    assert len(met) == len(set(met)) and set(met) == want


def test_no_words(nothing, spark):
    assert spelling.variants(nothing).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, ""), (3, "a b 12 ...")], "doc_id long, text string")).collect() == []
