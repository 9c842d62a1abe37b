"""Substring, suffix-array and near dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from plantflow.llm import blocks, simhash, substring_dedup, suffix_dedup


def first_places(texts, size, key):
    """Smallest (doc_id, place) of every window."""
    first = {}
    for k, t in texts:
        for i, w in key(k, t, size):
            if w not in first or (k, i) < first[w]:
                first[w] = (k, i)
    return first


def by_words(k, t, size):
    words = (t or "").encode().split()
    return [(i, tuple(words[i : i + size])) for i in range(len(words) - size + 1)] if k is not None else []


def by_bytes(k, t, size):
    data = (t or "").encode()
    return [(i, data[i : i + size]) for i in range(len(data) - size + 1)] if k is not None else []


def test_cover_holds_every_difference():
    cover, period = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(x - y) % period for x in cover for y in cover} == set(range(period))


@pytest.mark.parametrize("window", [50, 25])
def test_substring_dedup(docs, texts, rows, window):
    first = first_places(texts, window, by_words)
    want = []
    for k, t in texts:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for i, w in by_words(k, t, window):
            if first[w][0] < k:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want.append((k, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    found = substring_dedup.dedup(docs, window)
    assert rows(found.select("doc_id", "n_words", "n_removed", "kept_sha256")) == sorted(want, key=repr)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found.collect())
    assert sum(w[2] for w in want) > 1000


def test_window_must_exceed_the_period(docs):
    with pytest.raises(ValueError):
        substring_dedup.dedup(docs, substring_dedup.PERIOD)


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_suffix_dedup(docs, texts, rows, hot):
    first = first_places(texts, 100, by_bytes)
    want = []
    for k, t in texts:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i, w in by_bytes(k, t, 100):
            if first[w] < (k, i):
                gone[i : i + 100] = b"\1" * 100
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        want.append((k, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert rows(suffix_dedup.dedup(docs, texts=False, hot_runs=hot)) == sorted(want, key=repr)


def test_suffix_dedup_carries_columns(docs):
    found = suffix_dedup.dedup(docs, carried=("bucket", "row")).collect()
    assert all(r.row.bucket == 7 and r.row.row == 7 for r in found)
    assert all(r.kept_text == (r.text or "") for r in found if r.n_removed == 0)


def test_dedup_of_nothing(nothing):
    assert substring_dedup.dedup(nothing).collect() == []
    assert suffix_dedup.dedup(nothing).collect() == []
    assert simhash.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_longest_previous_factor(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab") for _ in range(300)) + "abab" * 20
    data = np.frombuffer(text.encode(), np.uint8)
    length = 17
    starts = np.arange(len(data) - length + 1)
    order, common = suffix_dedup.suffix_order(data, starts, length)
    windows = [text[i : i + length] for i in starts]
    assert [windows[i] for i in order] == sorted(windows)
    factor = np.zeros(len(starts), int)
    factor[order] = suffix_dedup.longest_previous_factor(order, common)

    def shared(i, j):
        n = 0
        while n < length and text[i + n] == text[j + n]:
            n += 1
        return n

    assert factor.tolist() == [max((shared(i, j) for j in range(i)), default=0) for i in range(len(starts))]


def test_words_are_cut_alike_in_slices(monkeypatch, texts):
    whole = [t or "" for _, t in texts][-6:]
    buffer = np.frombuffer("".join(whole).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in whole])]
    plain = blocks.Words(buffer, offsets)
    monkeypatch.setattr(blocks, "SLICE_BYTES", 57)
    sliced = blocks.Words(buffer, offsets)
    assert plain.counts.tolist() == [len(t.split()) for t in whole] == sliced.counts.tolist()
    assert (plain.digests == sliced.digests).all()


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    digests = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if sum(d >> i & 1 for d in digests) * 2 > len(digests))


def linked(prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    label = np.arange(len(prints))
    while True:
        new = np.array([label[own].min() for own in near])
        if (new == label).all():
            return label
        label = new


def test_simhash(docs, texts, rows):
    prints = np.array([slow_fingerprint(t) for _, t in texts], np.uint64)
    label = linked(prints)
    want = []
    for i, (k, _) in enumerate(texts):
        ids = [texts[j][0] for j in np.flatnonzero(label == label[i]) if texts[j][0] is not None]
        want.append((k, f"{int(prints[i]):016x}", min(ids) if ids else None))
    assert rows(simhash.near_duplicates(docs)) == sorted(want, key=repr)


@pytest.mark.parametrize("leaf", [60, 500])
def test_links_across_leaves(spark, leaf):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    parts = [rng.integers(0, 2**63, 600, dtype=np.uint64)]
    for c in centres:
        own = np.full(40, c)
        for _ in range(3):
            own = own ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64))
        parts.append(own)
    prints = np.unique(np.concatenate(parts))
    label = linked(prints)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fingerprint long")
    classes = dict(simhash.link_classes(spark, frame, leaf=leaf).collect())
    found = [classes.get(int(x), int(x)) for x in prints.view(np.int64)]
    assert len(set(zip(found, label))) == len(set(found)) == len(set(label))


def test_components_of_a_chain(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100, 90), (95, 100)]
    frame = spark.createDataFrame(edges, "fingerprint long, root long")
    found = dict(simhash.join_components(frame).collect())
    assert found == {**{i: 0 for i in range(1, 61)}, 100: 90, 95: 90}
