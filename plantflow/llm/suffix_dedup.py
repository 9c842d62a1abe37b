"""Suffix-array dedup over bytes, with longest-previous-factor arrays.

A byte goes if a `LENGTH`-byte string over it also starts earlier: in a document with a smaller doc_id, or
earlier in the same one. In suffix order, the longest earlier match of a position (its longest previous
factor) is with the nearest place above or below that holds a smaller position; if that match reaches
LENGTH, the string at the position is a copy. The first copy always stays.

To build suffix arrays of bounded size in many tasks, windows of LENGTH bytes that may be equal must meet.
Each window belongs to the smallest digest of its GRAM-byte strings, its *minimizer*; neighbouring windows
with the same one form a run, about a third of LENGTH long, cut by content and hence alike in all copies.
Equal windows have equal minimizers, so:

1. buckets send the minimizers they have to parts, and learn which of them occur in several runs;
2. the texts of those runs, each distinct text once per bucket with its first place, meet by minimizer;
   a part sorts the suffixes of its runs and answers with the windows that have an earlier copy;
3. buckets remove what those windows cover.

A minimizer with more than `HOT_RUNS` different runs (the edges of a passage that a great many documents
share) would be too much for one suffix array. The windows of its runs go by their own 128-bit digest to
parts all over the cluster instead, which finds the first place of each of them just as exactly.

Edge cases: null or empty text has no bytes; a row without doc_id has no place in the order, so it neither
removes nor loses bytes; rows with one doc_id and the same start count as the same place; other columns
are ignored. If a removed range begins or ends inside a character, `kept_text` leaves out the broken
character, while `n_removed` and `kept_sha256` refer to the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantflow.llm import blocks as b

LENGTH = 100
GRAM = 32
HOT_RUNS = 1000

SENT = "part int, bucket int, minimizer array<long>, runs array<int>"
SEEN = "bucket int, minimizer array<long>, hot array<long>"
WIDE = (
    "part int, bucket int, row array<int>, doc array<long>, start array<long>, size array<int>, text binary, "
    "high array<long>, low array<long>, hot array<long>"
)
FOUND = "bucket int, row array<int>, start array<long>, size array<int>, hot array<long>"
DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
RESULT = DIGESTS + ", text string, kept_text string"


# ---- suffix order ---------------------------------------------------------------------------------


STRIDE = 5  # bytes compared at once, beside a group number of 24 bits


def suffix_order(buffer: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places `starts` comes at each rank in the order of the `length` bytes there, and the
    common prefix with the rank before.

    A few bytes at a time; only places that are still tied go on.
    """
    padded = np.concatenate([buffer, np.zeros(STRIDE, np.uint8)])
    bytes_at = np.zeros(len(buffer), b.U64)
    for i in range(STRIDE):
        bytes_at |= padded[i : i + len(buffer)].astype(b.U64) << b.U64(8 * (STRIDE - 1 - i))
    order = np.arange(len(starts))
    common = np.full(len(starts), length, np.int32)
    group = np.zeros(len(starts), b.U64)  # of each active rank: ranks that tie share one
    active = np.arange(len(starts))
    for depth in range(0, length, STRIDE):
        key = bytes_at[starts[order[active]] + depth]
        short = depth + STRIDE - length
        if short > 0:
            key >>= b.U64(8 * short)
            key <<= b.U64(8 * short)
        key |= group << b.U64(8 * STRIDE)
        within = np.argsort(key)
        order[active], key = order[active[within]], key[within]
        differ = key[1:] ^ key[:-1]
        split = np.r_[True, differ != 0]
        same = np.flatnonzero(split[1:] & (differ >> b.U64(8 * STRIDE) == 0))
        bits = differ[same]
        common[active[same + 1]] = depth + sum((bits >> b.U64(8 * (STRIDE - i))) == 0 for i in range(1, STRIDE))
        tied = ~split
        tied[:-1] |= ~split[1:]
        active = active[tied]
        if not len(active):
            break
        group = np.cumsum(split[tied]).astype(b.U64)
        if int(group[-1]) >> 24:
            raise ValueError("too many suffixes for one part")
    common[:1] = 0
    return order, common


def _previous_smaller(place: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Common prefix with the nearest smaller place above each; 0 where there is none of `least` bytes."""
    above, shared = np.arange(len(place)) - 1, common.copy()
    shared[:1] = 0
    active = np.flatnonzero(shared >= least)
    active = active[place[above[active]] >= place[active]]
    while len(active):
        over = above[active]
        shared[active] = np.minimum(shared[active], shared[over])
        above[active] = above[over]
        active = active[(above[active] >= 0) & (shared[active] >= least)]
        active = active[place[above[active]] >= place[active]]
    shared[(above < 0) | (shared < least)] = 0
    return shared


def longest_previous_factor(place: np.ndarray, common: np.ndarray, least: int = 1) -> np.ndarray:
    """For places in suffix order: the longest match with an earlier place, if it has `least` bytes, else 0."""
    before = _previous_smaller(place, common, least)
    mirrored = np.r_[0, common[:0:-1]].astype(common.dtype) if len(common) else common
    return np.maximum(before, _previous_smaller(place[::-1], mirrored, least)[::-1])


# ---- one bucket -----------------------------------------------------------------------------------


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours: prefix and suffix minima of blocks of that width."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(b.U64).max, b.U64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).reshape(-1)
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


class _Block:
    """The texts of one bucket as runs of windows."""

    def __init__(self, table: pa.Table, length: int):
        # the same order in every phase, so that a row's place here names it
        self.table, self.length = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]), length
        table = self.table
        self.ids, self.present = b.ids_of(table["doc_id"])
        self.buffer, self.offsets = b.text_buffer(table["text"])
        gram = min(GRAM, length)
        starts, sizes, keys, highs, lows = [], [], [], [], []
        for low in range(0, len(self.buffer), b.SLICE_BYTES):
            high = min(low + b.SLICE_BYTES, len(self.buffer))
            piece = self.buffer[low : high + length - 1]
            values = b.BYTE_VALUES[piece]
            grams = b.Rolling(values, b.BASES[0]).windows(gram)
            minimum = _sliding_min(grams, length - gram + 1)
            if not len(minimum):
                continue
            good = ~self._no_window(low, low + len(minimum))
            leaves = grams[: len(minimum)] == minimum
            begins = good & np.r_[True, ~good[:-1] | leaves[:-1] | (minimum[1:] != minimum[:-1])]
            at = np.flatnonzero(begins)
            size = np.bincount(np.cumsum(begins)[good] - 1, minlength=len(at))
            end = at + size + length - 1
            starts.append(at + low)
            sizes.append(size)
            keys.append(b.mixed(minimum[at]))  # minima are small numbers: spread them over all parts again
            highs.append(b.Rolling(values, b.BASES[1]).spans(at, end))
            lows.append(b.Rolling(values, b.BASES[2]).spans(at, end))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.at, self.size, self.minimizer = join(starts, np.int64), join(sizes, np.int64), join(keys, b.U64)
        self.high, self.low = join(highs, b.U64), join(lows, b.U64)
        self.row = np.searchsorted(self.offsets, self.at, "right") - 1
        self.doc, self.start = self.ids[self.row], self.at - self.offsets[self.row]

    def _no_window(self, low: int, high: int) -> np.ndarray:
        """Places in low..high at which no window starts: the last bytes of a text, and texts without id."""
        first, last = self.offsets[:-1], self.offsets[1:]
        barred = np.where(self.present, np.maximum(first, last - self.length + 1), first)
        near = (last > low) & (barred < high)
        return b.sum_ranges(high - low, np.clip(barred[near] - low, 0, None), np.clip(last[near] - low, None, high - low))

    def distinct(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs `among`, ordered by minimizer, text and place; where a text begins; which have an earlier one of their text."""
        order = among[np.lexsort((self.start[among], self.doc[among], self.low[among], self.high[among], self.minimizer[among]))]
        first = self._begins(order, (self.minimizer, self.high, self.low))
        leader = np.repeat(order[first], np.diff(np.r_[first, len(order)]))
        return order, first, (self.doc[order] != self.doc[leader]) | (self.start[order] != self.start[leader])

    def _begins(self, order: np.ndarray, keys: tuple) -> np.ndarray:
        if not len(order):
            return np.zeros(0, np.int64)
        other = np.zeros(len(order) - 1, bool)
        for key in keys:
            own = key[order]
            other |= own[1:] != own[:-1]
        return np.flatnonzero(np.r_[True, other])

    def windows(self, runs: np.ndarray) -> np.ndarray:
        """Places of all windows of the runs."""
        return _spread(self.at[runs], self.size[runs])

    def window_digests(self, runs: np.ndarray) -> tuple[np.ndarray, ...]:
        """All windows of the runs, and whether an earlier one here equals them."""
        at = self.windows(runs)
        text = np.searchsorted(self.offsets, at, "right") - 1
        doc, start = self.ids[text], at - self.offsets[text]
        sizes = self.size[runs] + self.length - 1
        own, begin = self.buffer[_spread(self.at[runs], sizes)], np.cumsum(sizes) - sizes
        local = _spread(begin, self.size[runs])
        values = b.BYTE_VALUES[own]
        high = b.Rolling(values, b.BASES[1]).spans(local, local + self.length)
        low = b.Rolling(values, b.BASES[2]).spans(local, local + self.length)
        return at, high, low, text, doc, start, _first_places(high, low, doc, start)[2]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each start, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _first_places(high: np.ndarray, low: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by digest and place; the first of each digest; which entries have an earlier one of the same digest."""
    order = np.lexsort((start, doc, low, high))
    h, l = high[order], low[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (l[1:] != l[:-1])]) if len(order) else np.zeros(0, np.int64)
    leader = np.repeat(order[first], np.diff(np.r_[first, len(order)]))
    later = np.zeros(len(order), bool)
    later[order] = (doc[order] != doc[leader]) | (start[order] != start[leader])
    return order, first, later


def _send_minimizers(parts: int, length: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(table, length)
        order, first, _ = block.distinct(np.arange(len(block.at)))
        texts = block.minimizer[order[first]]
        names, bounds = b.slices(texts)
        runs = np.diff(bounds)
        total = np.diff(b.slices(block.minimizer[order])[1])
        runs = np.where(total > runs, -runs, runs).astype(np.int32)  # negative: a text occurs twice here
        part, cuts = b.slices(b.part_of(names, parts))
        return pa.table(
            {
                "part": pa.array(part, pa.int32()),
                "bucket": pa.array(np.full(len(part), key[0].as_py()), pa.int32()),
                "minimizer": b.list_column(b.signed(names), cuts),
                "runs": b.list_column(runs, cuts),
            }
        )

    return send


def _match_minimizers(hot_runs: int):
    def match(table: pa.Table) -> pa.Table:
        """Per part: minimizers of more than one run, back to the buckets that have them."""
        value, sizes = b.lists(table["minimizer"])
        runs = b.lists(table["runs"])[0].astype(np.int64)
        bucket = np.repeat(np.asarray(table["bucket"]), sizes)
        order = np.argsort(value, kind="stable")
        value, runs, bucket = value[order], runs[order], bucket[order]
        _, bounds = b.slices(value)
        count = np.diff(bounds)
        total = np.add.reduceat(np.abs(runs), bounds[:-1]) if len(count) else count
        twice = np.logical_or.reduceat(runs < 0, bounds[:-1]) if len(count) else count > 0
        shared, hot = np.repeat((total > 1) | twice, count), np.repeat(total > hot_runs, count)
        order = np.argsort(bucket[shared], kind="stable")
        value, hot = value[shared][order], hot[shared][order]
        names, cuts = b.slices(bucket[shared][order])
        hots = np.r_[0, np.cumsum(hot)][cuts]
        colds = np.r_[0, np.cumsum(~hot)][cuts]
        return pa.table(
            {
                "bucket": pa.array(names, pa.int32()),
                "minimizer": b.list_column(value[~hot], colds),
                "hot": b.list_column(value[hot], hots),
            }
        )

    return match


def _send_runs(parts: int, length: int):
    def send(key: tuple, table: pa.Table, seen: pa.Table) -> pa.Table:
        block = _Block(table, length)
        bucket = key[0].as_py()
        plain, hot = (b.unsigned(b.lists(seen[name])[0]) for name in ("minimizer", "hot"))
        order, _, later = block.distinct(np.flatnonzero(np.isin(block.minimizer, plain)))
        runs = order[~later]
        part, cuts = b.slices(b.part_of(block.minimizer[runs], parts))
        rows = []
        for i, name in enumerate(part):
            own = runs[cuts[i] : cuts[i + 1]]
            text = block.buffer[_spread(block.at[own], block.size[own] + length - 1)].tobytes()
            rows.append((name, bucket, block.row[own], block.doc[own], block.start[own], block.size[own], text, [], [], []))
        if len(hot):
            found = block.window_digests(np.flatnonzero(np.isin(block.minimizer, hot)))
            _, high, low, row, doc, start, again = found
            keep = np.flatnonzero(~again)
            keep = keep[np.argsort(high[keep])]
            part, cuts = b.slices(b.part_of(high[keep], parts))
            for i, name in enumerate(part):
                own = keep[cuts[i] : cuts[i + 1]]
                rows.append((name, bucket, row[own], doc[own], start[own], [], b"", b.signed(high[own]), b.signed(low[own]), []))
            rows.append((bucket % parts, bucket, [], [], [], [], b"", [], [], b.signed(hot)))
        return _rows_table(rows, _WIDE)

    return send


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_WIDE = pa.schema(
    [("part", pa.int32()), ("bucket", pa.int32()), ("row", _INTS), ("doc", _LONGS), ("start", _LONGS), ("size", _INTS)]
    + [("text", pa.binary()), ("high", _LONGS), ("low", _LONGS), ("hot", _LONGS)]
)
_FOUND = pa.schema([("bucket", pa.int32()), ("row", _INTS), ("start", _LONGS), ("size", _INTS), ("hot", _LONGS)])


def _rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _match_runs(length: int):
    def match(table: pa.Table) -> pa.Table:
        """Per part: windows with an earlier copy, as ranges, back to the buckets that sent them."""
        bucket = np.asarray(table["bucket"])
        size, runs = b.lists(table["size"])
        size = size.astype(np.int64)
        doc, entries = b.lists(table["doc"])
        row, start = b.lists(table["row"])[0], b.lists(table["start"])[0]
        high, digests = b.lists(table["high"])
        low = b.lists(table["low"])[0]
        by_text = np.repeat(runs > 0, entries)
        parts = []
        if len(size):
            texts = np.frombuffer(b"".join(table["text"].to_pylist()), np.uint8)
            run, shift, count = _earlier_copies(texts, doc[by_text], start[by_text], size, length)
            parts.append((np.repeat(bucket, runs)[run], row[by_text][run], start[by_text][run] + shift, count))
        if len(high):
            own = np.flatnonzero(~by_text)
            later = np.flatnonzero(_first_places(b.unsigned(high), b.unsigned(low), doc[own], start[own])[2])
            own = own[later]
            parts.append((np.repeat(bucket, digests)[later], row[own], start[own], np.ones(len(own), np.int64)))
        rows = []
        if parts:
            to, row, start, size = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(to, kind="stable")
            names, cuts = b.slices(to[order])
            for i, name in enumerate(names):
                own = order[cuts[i] : cuts[i + 1]]
                rows.append((name, row[own], start[own], size[own], []))
        hot, sizes = b.lists(table["hot"])
        ends = np.cumsum(sizes)
        rows += [(bucket[i], [], [], [], hot[ends[i] - sizes[i] : ends[i]]) for i in np.flatnonzero(sizes)]
        return _rows_table(rows, _FOUND)

    return match


def _earlier_copies(texts: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, length: int):
    """Windows of the given runs (texts one after the other) with an earlier copy among them: run, first window, number."""
    whole = size + length - 1
    begin = np.cumsum(whole) - whole
    values = b.BYTE_VALUES[texts]
    high = b.Rolling(values, b.BASES[1]).spans(begin, begin + whole)
    low = b.Rolling(values, b.BASES[2]).spans(begin, begin + whole)
    order, first, later = _first_places(high, low, doc, start)
    # a run whose whole text stands earlier is a copy throughout; the others enter the suffix array once
    leader = np.empty(len(order), np.int64)
    leader[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
    chosen = order[first]
    rank_of = np.lexsort((start[chosen], doc[chosen]))
    chosen = chosen[rank_of]
    named = np.empty(len(first), np.int64)
    named[rank_of] = np.arange(len(first))
    leader = named[leader]
    place = _spread(begin[chosen], size[chosen])
    of = np.repeat(np.arange(len(chosen)), size[chosen])
    rank = np.arange(len(place))
    after = (doc[chosen][1:] == doc[chosen][:-1]) & (start[chosen][1:] < start[chosen][:-1] + size[chosen][:-1])
    if after.any():  # rows with one doc_id: windows may share a place
        own_doc, own_start = doc[chosen][of], _spread(start[chosen], size[chosen])
        by_place = np.lexsort((own_start, own_doc))
        fresh = np.r_[True, (np.diff(own_doc[by_place]) != 0) | (np.diff(own_start[by_place]) != 0)]
        rank[by_place] = np.cumsum(fresh)
    window, common = suffix_order(texts, place, length)
    factor = np.zeros(len(place), np.int32)
    factor[window] = longest_previous_factor(rank[window], common, length)
    copied = factor >= length
    opens = np.flatnonzero(copied & np.r_[True, ~copied[:-1] | (of[1:] != of[:-1])][: len(copied)])
    shuts = np.flatnonzero(copied & np.r_[~copied[1:] | (of[1:] != of[:-1]), True][: len(copied)]) + 1
    ranges = of[opens]
    # runs with the leader's text at the leader's own place (repeated rows) get its ranges too
    same = np.flatnonzero(~later)
    by_leader = np.argsort(leader[same], kind="stable")
    same = same[by_leader]
    low_at, high_at = np.searchsorted(leader[same], ranges), np.searchsorted(leader[same], ranges, "right")
    times = high_at - low_at
    who = same[_spread(low_at, times)]
    shift, spans = np.repeat(opens, times), np.repeat(shuts - opens, times)
    shift = shift - np.repeat((np.cumsum(size[chosen]) - size[chosen])[ranges], times)
    copies = np.flatnonzero(later)
    return np.r_[copies, who], np.r_[np.zeros(len(copies), np.int64), shift], np.r_[size[copies], spans]


def _remove(length: int, texts: bool):
    def remove(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        block = _Block(table, length)
        order, _, later = block.distinct(np.arange(len(block.at)))
        copies = order[later]
        starts, sizes = [block.at[copies]], [block.size[copies]]
        hot = b.unsigned(b.lists(found["hot"])[0])
        if len(hot):
            at, *_, again = block.window_digests(np.flatnonzero(np.isin(block.minimizer, hot)))
            starts.append(at[again])
            sizes.append(np.ones(int(again.sum()), np.int64))
        row, start, size = (b.lists(found[name])[0].astype(np.int64) for name in ("row", "start", "size"))
        starts.append(block.offsets[row] + start)
        sizes.append(size)
        start, size = np.concatenate(starts), np.concatenate(sizes)
        gone = b.sum_ranges(len(block.buffer), start, start + size + length - 1)
        running = np.r_[0, np.cumsum(gone)]
        first, last = block.offsets[:-1], block.offsets[1:]
        removed = running[last] - running[first]
        opens = gone.copy()
        if len(gone):
            opens[1:] &= ~gone[:-1]
            edges = first[first < len(gone)]
            opens[edges] = gone[edges]
        spans = np.r_[0, np.cumsum(opens)]
        kept = []
        for i, (low, high) in enumerate(zip(first.tolist(), last.tolist())):
            own = block.buffer[low:high]
            kept.append((own[~gone[low:high]] if removed[i] else own).tobytes())
        out = {
            "doc_id": block.table["doc_id"],
            "n_bytes": pa.array(last - first),
            "n_removed": pa.array(removed),
            "n_spans": pa.array(spans[last] - spans[first]),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        if texts:
            out["text"] = block.table["text"]
            out["kept_text"] = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
        if "row" in block.table.column_names:
            out["row"] = block.table["row"]
        return pa.table(out)

    return remove


def dedup(
    docs: DataFrame, length: int = LENGTH, texts: bool = True, carried: tuple[str, ...] = (), hot_runs: int = HOT_RUNS
) -> DataFrame:
    """Each document's counts and digest after removal; with `texts` its text before and after; and in a
    struct `row` the columns named in `carried`."""
    docs = b.text_rows(docs, *carried)
    buckets = b.bucket_count(docs)
    dealt = b.bucketed(docs, buckets)
    seen = (
        dealt.groupBy("bucket").applyInArrow(_send_minimizers(buckets, length), SENT)
        .groupBy("part").applyInArrow(_match_minimizers(hot_runs), SEEN)
    )
    found = (
        dealt.groupBy("bucket").cogroup(seen.groupBy("bucket")).applyInArrow(_send_runs(buckets, length), WIDE)
        .groupBy("part").applyInArrow(_match_runs(length), FOUND)
    )
    result = b.schema(None, RESULT if texts else DIGESTS)
    if carried:
        result = result.add(docs.schema["row"])
    return dealt.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_remove(length, texts), result)
