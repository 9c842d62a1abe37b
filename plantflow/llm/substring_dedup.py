"""Substring dedup over words, with difference-cover anchors.

A window is `WINDOW` consecutive words. D is a difference cover modulo `PERIOD`: for any two positions
there is a shift below PERIOD that brings both onto cover positions. So two equal windows, wherever they
start, share an *anchor*: the WINDOW - PERIOD + 1 words that start at some cover position of both. Anchors
are therefore hashed at cover positions only (|D| of PERIOD words), and a window none of whose anchors
occurs in a second document cannot repeat. The remaining windows are extended to their full width and
compared by 128-bit digests, which names for each of them the smallest document it starts in.

Data flow: texts are dealt to buckets once (that exchange is read three times); anchors go by digest to
parts and come back as "seen elsewhere"; full windows go by digest to parts and come back as "starts in a
smaller document". A bucket sends a digest once, so a passage that every document holds costs at most one
entry per bucket. No pair of documents is ever formed.

Edge cases: a null or empty text has no words and stays as it is; a row without doc_id has no order, so it
neither removes nor loses words; rows with the same doc_id do not remove each other's words; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantflow.llm import blocks as b

WINDOW = 50
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # every residue modulo 21 is a difference of two of these

SENT = "part int, bucket int, once array<long>, many array<long>"
SEEN = "bucket int, anchors array<long>"
WIDE = "part int, bucket int, high array<long>, low array<long>, first array<long>"
FOUND = "bucket int, high array<long>, low array<long>"
RESULT = "doc_id long, text string, n_words long, n_removed long, kept_text string, kept_sha256 string"


class _Block:
    """The words of one bucket, their anchors and windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window = table, window
        self.ids, self.present = b.ids_of(table["doc_id"])
        buffer, offsets = b.text_buffer(table["text"])
        self.words = b.Words(buffer, offsets)
        self.anchor = window - PERIOD + 1
        w = self.words
        self.doc = self.ids[w.text]
        fits = self.present[w.text] & (w.counts[w.text] >= window)
        left = w.counts[w.text] - w.place
        self.opens = np.flatnonzero(fits & (left >= window))  # words at which a window starts
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        self.covered = np.flatnonzero(fits & (left >= self.anchor) & cover[w.place % PERIOD])

    def anchors(self) -> np.ndarray:
        return b.Rolling(self.words.digests, b.BASES[1]).spans(self.covered, self.covered + self.anchor)

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = b.Rolling(self.words.digests, b.BASES[2]).spans(at, at + self.window)
        low = b.Rolling(b.mixed(self.words.digests, 0x5851F42D4C957F2D), b.BASES[3]).spans(at, at + self.window)
        return high, low


def _groups(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order by 128-bit digest and the first place of each digest in it."""
    order = np.lexsort((low, high))
    h, l = high[order], low[order]
    return order, np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (l[1:] != l[:-1])]) if len(h) else np.zeros(0, np.int64)


def _send_anchors(parts: int, window: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(table, window)
        digest = block.anchors()
        doc = block.doc[block.covered]
        order = np.argsort(digest)
        digest, doc = digest[order], doc[order]
        kept, bounds = b.slices(digest)
        many = np.zeros(len(kept), bool)
        if len(kept):
            many = np.minimum.reduceat(doc, bounds[:-1]) != np.maximum.reduceat(doc, bounds[:-1])
        part = b.part_of(kept, parts)
        names, cuts = b.slices(part)
        once = np.r_[0, np.cumsum(~many)]
        twice = np.r_[0, np.cumsum(many)]
        return pa.table(
            {
                "part": pa.array(names, pa.int32()),
                "bucket": pa.array(np.full(len(names), key[0].as_py()), pa.int32()),
                "once": b.list_column(b.signed(kept[~many]), once[cuts]),
                "many": b.list_column(b.signed(kept[many]), twice[cuts]),
            }
        )

    return send


def _match_anchors(table: pa.Table) -> pa.Table:
    """Per part: anchors that start in more than one document, back to the buckets that have them."""
    once, once_sizes = b.lists(table["once"])
    many, many_sizes = b.lists(table["many"])
    buckets = np.asarray(table["bucket"])
    digest = np.r_[once, many]
    bucket = np.r_[np.repeat(buckets, once_sizes), np.repeat(buckets, many_sizes)]
    repeated = np.r_[np.zeros(len(once), bool), np.ones(len(many), bool)]
    order = np.argsort(digest)
    digest, bucket, repeated = digest[order], bucket[order], repeated[order]
    _, bounds = b.slices(digest)
    sizes = np.diff(bounds)
    shared = (sizes > 1) | (np.logical_or.reduceat(repeated, bounds[:-1]) if len(sizes) else np.zeros(0, bool))
    keep = np.repeat(shared, sizes)
    digest, bucket = digest[keep], bucket[keep]
    order = np.argsort(bucket, kind="stable")
    names, cuts = b.slices(bucket[order])
    return pa.table({"bucket": pa.array(names, pa.int32()), "anchors": b.list_column(digest[order], cuts)})


def _send_windows(parts: int, window: int):
    def send(key: tuple, table: pa.Table, seen: pa.Table) -> pa.Table:
        block = _Block(table, window)
        w = block.words
        shared = np.isin(block.anchors(), b.unsigned(b.lists(seen["anchors"])[0]))
        hit = block.covered[shared]
        near = b.sum_ranges(len(w.starts), np.maximum(hit - PERIOD + 1, w.first[w.text[hit]]), hit + 1)
        at = block.opens[near[block.opens]]
        high, low = block.digests(at)
        order, first = _groups(high, low)
        doc = block.doc[at][order]
        smallest = np.minimum.reduceat(doc, first) if len(first) else doc
        high, low = high[order][first], low[order][first]
        names, cuts = b.slices(b.part_of(high, parts))
        return pa.table(
            {
                "part": pa.array(names, pa.int32()),
                "bucket": pa.array(np.full(len(names), key[0].as_py()), pa.int32()),
                "high": b.list_column(b.signed(high), cuts),
                "low": b.list_column(b.signed(low), cuts),
                "first": b.list_column(smallest, cuts),
            }
        )

    return send


def _match_windows(table: pa.Table) -> pa.Table:
    """Per part: windows that start in a smaller document than any of the bucket's."""
    high, sizes = b.lists(table["high"])
    low, first = b.lists(table["low"])[0], b.lists(table["first"])[0]
    bucket = np.repeat(np.asarray(table["bucket"]), sizes)
    order, start = _groups(high, low)
    first = first[order]
    smallest = np.repeat(np.minimum.reduceat(first, start) if len(start) else first, np.diff(np.r_[start, len(first)]))
    keep = order[first > smallest]
    keep = keep[np.argsort(bucket[keep], kind="stable")]
    names, cuts = b.slices(bucket[keep])
    return pa.table(
        {
            "bucket": pa.array(names, pa.int32()),
            "high": b.list_column(high[keep], cuts),
            "low": b.list_column(low[keep], cuts),
        }
    )


def _remove(window: int):
    def remove(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        block = _Block(table, window)
        w = block.words
        high, low = block.digests(block.opens)
        far_high, far_low = (b.unsigned(b.lists(found[name])[0]) for name in ("high", "low"))
        order, first = _groups(np.r_[high, far_high], np.r_[low, far_low])
        # a digest sent back stands for a document smaller than all of this bucket
        doc = np.r_[block.doc[block.opens], np.full(len(far_high), np.iinfo(np.int64).min)][order]
        smallest = np.repeat(np.minimum.reduceat(doc, first) if len(first) else doc, np.diff(np.r_[first, len(doc)]))
        later = order[doc > smallest]
        at = block.opens[later]
        gone = b.sum_ranges(len(w.starts), at, at + window)
        removed = np.bincount(w.text[gone], minlength=len(block.ids)).astype(np.int64)
        kept = []
        for i, text in enumerate(table["text"].to_pylist()):
            own = (text or "").encode().split()
            if removed[i]:
                own = compress(own, (~gone[w.first[i] : w.first[i] + w.counts[i]]).tolist())
            kept.append(b" ".join(own))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "text": table["text"],
                "n_words": pa.array(w.counts),
                "n_removed": pa.array(removed),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            }
        )

    return remove


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document with the words left after removal, their number and digest.

    A word goes if a window over it also starts in a document with a smaller doc_id; windows are judged on
    the texts as given.
    """
    if window <= PERIOD:
        raise ValueError(f"a window must be longer than the period {PERIOD}")
    docs = b.text_rows(docs)
    buckets = b.bucket_count(docs)
    texts = b.bucketed(docs, buckets)
    seen = (
        texts.groupBy("bucket").applyInArrow(_send_anchors(buckets, window), SENT)
        .groupBy("part").applyInArrow(_match_anchors, SEEN)
    )
    found = (
        texts.groupBy("bucket").cogroup(seen.groupBy("bucket")).applyInArrow(_send_windows(buckets, window), WIDE)
        .groupBy("part").applyInArrow(_match_windows, FOUND)
    )
    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_remove(window), RESULT)
