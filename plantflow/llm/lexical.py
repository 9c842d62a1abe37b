"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time evaluation.

Documents are indexed where they lie: a shard is a bounded piece of a batch with the posting lists (places and
counts) of the terms asked for, so a frequent term is never gathered anywhere and no posting is shuffled. The
shards are a table in the shared folder; the counts that weights need (documents, their lengths, documents a
term) are sums over it.

A query meets a shard in two ways. Its short lists are added up term at a time into accumulators; these are then
one more iterator, with a bound for every window of `WINDOW` documents, beside the long lists, whose bound in a
window comes from the largest count and the smallest length there. Windows are walked in document order; one whose
bounds add up to less than the k-th best score so far is skipped, in the others the long lists are added largest
bound first, until what is left cannot lift any document to that score. The k-th best score is carried from shard
to shard of a task, and each task gives at most k rows a query, which one ranking merges.

Terms are maximal runs of ASCII letters, ASCII digits and characters beyond ASCII, A-Z lower-cased. Equality of
terms is that of a 64-bit digest and the length. Scores are integers (see `shard_scores`, `weights`).

Edge cases: a null text has no terms; documents without terms count nowhere; a query without terms, or whose terms
no document holds, has no rows; rows of queries alike in id and text count once, rows of one id and unlike texts
each get their ranks; repeated documents are ranked each; among equal scores the smaller doc_id is first, and a
document without id last; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plantflow.llm import blocks as b
from plantflow.llm import learn
from plantflow.session import new_folder, stored

SHARD_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20  # text of the queries of one block
WINDOW = 64
SHORT = 16  # a list is short if it holds at most one of so many documents of the shard

# Bytes between terms, and what each byte counts as in a digest: A-Z as a-z.
BETWEEN = np.zeros(256, bool)
BETWEEN[:0x80] = True
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    BETWEEN[ord(_low) : ord(_high) + 1] = False
VALUES = b.BYTE_VALUES.copy()
VALUES[0x41:0x5B] = VALUES[0x61:0x7B]


class Queries:
    """A block of queries: the sorted terms of all, and the terms of each."""

    def __init__(self, texts: list[str]):
        words = b.Words(*b.text_buffer(pa.array(texts, pa.string())), BETWEEN, VALUES)
        self.digests, first, term = np.unique(words.digests, return_index=True, return_inverse=True)
        self.sizes = (words.ends - words.starts)[first]
        bounds = np.cumsum(words.counts)
        self.terms = [np.unique(part) for part in np.split(term, bounds[:-1])]

    def terms_of(self, words: b.Words) -> tuple[np.ndarray, np.ndarray]:
        """Place and term of each word that is one of the terms."""
        if not len(self.digests):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.digests, words.digests), len(self.digests) - 1)
        same = (self.digests[at] == words.digests) & (self.sizes[at] == words.ends - words.starts)
        return np.flatnonzero(same), at[same]


def index(docs: DataFrame, queries: Queries, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row a shard: its documents and their numbers of terms; the terms of `queries` it holds, how many documents
    hold each, and for each of these the document's place in the shard and the term's count."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)  # at most BLOCK_BYTES of text
    schema = (
        "docs array<long>, lengths array<long>, filled long, length long, "
        "terms array<int>, held array<int>, places array<int>, counts array<int>"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for piece in learn.pieces(batch, most=shard_bytes):
                words = b.Words(*b.text_buffer(piece["text"]), BETWEEN, VALUES)
                at, term = shared.value.terms_of(words)
                key, count = np.unique(term * piece.num_rows + words.text[at], return_counts=True)
                term, place = key // max(1, piece.num_rows), key % max(1, piece.num_rows)
                term, bounds = b.slices(term)
                one = np.array([0, len(bounds) - 1])
                whole = np.array([0, piece.num_rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array(whole, pa.int32()), piece["doc_id"]),
                        b.list_column(words.counts, whole),
                        pa.array([int((words.counts > 0).sum())]),
                        pa.array([int(words.counts.sum())]),
                        b.list_column(term.astype(np.int32), one),
                        b.list_column(np.diff(bounds).astype(np.int32), one),
                        b.list_column(place.astype(np.int32), np.array([0, len(place)])),
                        b.list_column(count.astype(np.int32), np.array([0, len(place)])),
                    ],
                    names,
                )

    return b.text_rows(docs).mapInArrow(run, schema)


def weights(documents: int, held: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of each term; 0 for a term that no document holds."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) if df else 0 for df in held.tolist()], np.int64)


def shard_scores(weight, count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term adds to a document: w * ((10^9 tf) div (1000 tf + 8 m))."""
    return weight * ((1_000_000_000 * count) // (1000 * count + 8 * norm))


def norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m = 10 + ((90 n N) div L)."""
    if 90 * int(lengths.max(initial=0)) * documents >= 2**63:
        return np.array([10 + 90 * n * documents // max(1, total) for n in lengths.tolist()], np.int64)
    return 10 + (90 * lengths * documents) // max(1, total)


class Shard:
    """Posting lists of a shard, with windows."""

    def __init__(self, row: dict, weight: np.ndarray, documents: int, total: int):
        self.docs = row["docs"]
        self.size = len(self.docs)
        self.norm = norms(row["lengths"], documents, total)
        self.weight = weight
        self.count, self.place = row["counts"].astype(np.int64), row["places"].astype(np.int64)
        ends = np.r_[0, np.cumsum(row["held"].astype(np.int64))]
        self.span = {int(t): (int(low), int(high)) for t, low, high in zip(row["terms"], ends, ends[1:])}
        self.edges = np.arange(0, self.size + WINDOW, WINDOW)
        self.least = np.minimum.reduceat(self.norm, self.edges[:-1]) if self.size else np.zeros(0, np.int64)
        self.long: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def windows(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window's postings of a long list begin, and the most that the term adds there."""
        if term not in self.long:
            low, high = self.span[term]
            at = low + np.searchsorted(self.place[low:high], self.edges)
            most = np.zeros(len(self.edges) - 1, np.int64)
            some = np.flatnonzero(at[1:] > at[:-1])
            most[some] = np.maximum.reduceat(self.count[low:high], at[some] - low) if len(some) else 0
            bound = np.where(most > 0, shard_scores(self.weight[term], np.maximum(most, 1), self.least), 0)
            self.long[term] = at, bound
        return self.long[term]

    def best(self, terms: np.ndarray, top: "Top", skipped: list[int] | None = None) -> None:
        """Give `top` all documents of the shard that may be among the best."""
        own = [t for t in terms.tolist() if t in self.span and self.weight[t] > 0]
        if not own:
            return
        length = {t: self.span[t][1] - self.span[t][0] for t in own}
        short = [t for t in own if length[t] * SHORT <= self.size]
        summed = np.zeros(len(self.edges[:-1]) * WINDOW, np.int64)
        for t in short:  # term at a time
            low, high = self.span[t]
            summed[self.place[low:high]] += shard_scores(self.weight[t], self.count[low:high], self.norm[self.place[low:high]])
        lists = [(t, *self.windows(t)) for t in own if t not in set(short)]
        bound = summed.reshape(-1, WINDOW).max(1) + sum(most for _, _, most in lists)
        for w in np.flatnonzero(bound >= max(1, top.floor)).tolist():  # document at a time
            if bound[w] < top.floor:
                continue
            base = w * WINDOW
            score = summed[base : base + WINDOW].copy()
            there = sorted(((int(most[w]), t, at) for t, at, most in lists if most[w]), key=lambda x: (-x[0], x[1]))
            left = sum(x[0] for x in there)
            for most, t, at in there:
                if score.max() + left < top.floor:
                    break
                low, high = at[w], at[w + 1]
                place = self.place[low:high]
                score[place - base] += shard_scores(self.weight[t], self.count[low:high], self.norm[place])
                left -= most
            else:
                at = np.flatnonzero(score >= max(1, top.floor))
                top.add([(int(score[i]), self.docs[base + i]) for i in at.tolist()])
                continue
            if skipped is not None:
                skipped.append(w)


class Top:
    """The k best (score, doc_id) so far and the score that a further one must reach."""

    def __init__(self, k: int):
        self.k, self.held, self.floor = k, [], 1

    def add(self, found: list[tuple[int, int | None]]) -> None:
        if not found:
            return
        self.held = sorted(self.held + found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[: self.k]
        if len(self.held) == self.k:
            self.floor = max(1, self.held[-1][0])


def _arrays(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        row = {n: batch[n][i].values for n in ("lengths", "terms", "held", "places", "counts")}
        yield {n: np.asarray(v) for n, v in row.items()} | {"docs": batch["docs"][i].values.to_pylist()}


def _block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """query (place in the block), doc_id, score: of each task the k best documents of each query."""
    queries = Queries([text for _, text in items])
    shards = stored(index(docs, queries), "shards")
    documents, total = shards.agg(F.coalesce(F.sum("filled"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    each = shards.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).groupBy("t.terms").agg(F.sum("t.held").alias("held"))
    held = np.zeros(len(queries.digests), np.int64)
    for row in each.collect():  # at most the terms of a block
        held[row.terms] = row.held
    sent = docs.sparkSession.sparkContext.broadcast((queries.terms, weights(documents, held)))

    def run(batches):
        terms, weight = sent.value
        tops = [Top(k) for _ in terms]
        for batch in batches:
            for row in _arrays(batch):
                shard = Shard(row, weight, documents, total)
                for own, top in zip(terms, tops):
                    shard.best(own, top)
        rows = [(q, doc, score) for q, top in enumerate(tops) for score, doc in top.held]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return shards.mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every query, from blocks of queries.

    Each block's rows are written to the shared folder before the next block is taken.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where("text IS NOT NULL").distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    path = new_folder(spark, "ranked")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    schema = "item_id long, rank int, doc_id long, score long"
    for number in range(blocks):
        own = [(r.item_id, r.text) for r in numbered.where(F.col("block") == number).collect()]
        if not own:
            continue
        ranked = _block(docs, own, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(own)], "query long, item_id long")
        ranked.join(names, "query").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    if not blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
