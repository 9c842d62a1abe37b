"""Similarity search over text chunks and dense vectors, and cited answers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from plantflow import wording
from plantflow.config import MIN_SCORE, TOP_K
from plantflow.functions import columns as fn
from plantflow.operators import pivots as pv, skew, text as tx
from plantflow.operators.postings import DIGITS, MARGIN, Postings
from plantflow.session import broadcast_rows, durable, new_folder, spread, stored
from plantflow.sources.buckets import MAX_BUCKETS, bucket_keys, open_bucketed, write_bucketed
from plantflow.sources.sinks import path_exists

SHARD_ROWS = 4_096  # chunks of a shard, about
QUERY_BLOCK = 1_000  # questions handed to a task at once
EVEN_SHARDS = 256
FEW_TERMS = 256  # so many terms are pushed into the scan of the lists
FEW_SHARDS = 1_000  # so many shards into the scan of the chunks
PIVOTS = 64  # groups a block of vectors is parted into
PIVOT_SAMPLE = 2_048  # vectors they are chosen from
VECTOR_ROWS = 8_192  # vectors grouped and scored at once
NAMES = -1  # the row of a shard that holds the ids of its chunks
_LISTS = "shard int, number int, places array<int>, weights array<double>, most double, names array<string>"


@dataclass(frozen=True)
class Index:
    """A text index of two bucketed tables: chunks by shard, and posting lists by shard and term.

    A shard is a hash of the chunk id. Its lists are built, kept and searched in one place: both tables are bucketed
    by shard, so neither building nor searching moves chunks or lists. Rows of `lists` are one term of one shard:
    places (the chunk's rank by id in its shard), weights, and the largest weight. They lie in the order of terms, in
    small pages, so that a question reads only the pages of its own terms.
    """

    chunks: DataFrame
    lists: DataFrame
    vocabulary: DataFrame
    stop_words: tuple[str, ...] = ()
    pattern: str | None = None
    buckets: int = 1

    def save(self, path: str) -> None:
        spark = self.chunks.sparkSession
        _write_chunks(self.chunks, f"{path}/chunks", self.buckets, True)
        _write_lists(self.lists, f"{path}/lists", self.buckets)
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        row = [(list(self.stop_words), self.pattern, self.buckets)]
        settings = spark.createDataFrame(row, "stop_words array<string>, pattern string, buckets int")
        settings.write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Index:
        if not path_exists(spark, f"{path}/settings"):
            raise FileNotFoundError(f"no index at {path}: build it first")
        settings = spark.read.parquet(f"{path}/settings").first()
        buckets = settings["buckets"]
        return Index(
            open_bucketed(spark, f"{path}/chunks", "shard", buckets, ["chunk_id"]),
            open_bucketed(spark, f"{path}/lists", "shard", buckets, ["number"]),
            spark.read.parquet(f"{path}/vocabulary"),
            tuple(settings["stop_words"]),
            settings["pattern"],
            buckets,
        )

    @property
    def postings(self) -> DataFrame:
        """`(chunk_id, term, weight)`, one row a posting."""
        names = self.lists.filter(F.col("number") == NAMES).select("shard", F.col("names").alias("_names"))
        pairs = self.lists.filter(F.col("number") != NAMES).select(
            "shard", "number", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("weights").alias("weight")))
        )
        named = pairs.join(names, "shard").select(F.get("_names", "place").alias("chunk_id"), "number", "weight")
        return named.join(self.vocabulary.select("number", "term"), "number").select("chunk_id", "term", "weight")


@dataclass(frozen=True)
class Chunked:
    """Text that is asked a few questions once: chunks where their pages lie, and the vocabulary; no lists.

    Found are the same chunks, with the same scores, as by an `Index` of the same pages. One reading of the chunks weighs
    them against all questions of a block, which costs less than dealing them to shards and writing their lists.
    """

    chunks: DataFrame
    vocabulary: DataFrame
    stop_words: tuple[str, ...] = ()
    pattern: str | None = None


def chunked(
    pages: DataFrame, stop_words: Sequence[str] = (), max_features: int = tx.MAX_FEATURES, pattern: str | None = None
) -> Chunked:
    """Chunk the pages and fit the vocabulary; nothing is dealt out."""
    chunks = stored(tx.chunk_pages(pages), "chunks")
    return Chunked(chunks, _numbered(chunks, stop_words, max_features, pattern), tuple(stop_words), pattern)


def _numbered(chunks: DataFrame, stop_words: Sequence[str], max_features: int, pattern: str | None) -> DataFrame:
    fitted = tx.fit_vocabulary(chunks, "text", max_features, stop_words, pattern)
    return durable(fitted.withColumn("number", F.row_number().over(W.orderBy("term")) - 1))  # at most `max_features` rows


def _write_chunks(chunks: DataFrame, path: str, buckets: int, placed: bool) -> DataFrame:
    return write_bucketed(chunks, path, "shard", buckets, ["chunk_id"], placed)


def _write_lists(lists: DataFrame, path: str, buckets: int) -> DataFrame:
    """Lists are always made, or read, where their shard lies; small pages let a scan skip other terms."""
    return write_bucketed(lists, path, "shard", buckets, ["number"], True, {"parquet.page.row.count.limit": "128"})


def build_index(
    pages: DataFrame,
    stop_words: Sequence[str] = (),
    max_features: int = tx.MAX_FEATURES,
    pattern: str | None = None,
    shard_rows: int = SHARD_ROWS,
) -> Index:
    """Chunk the pages and weigh their terms.

    The chunks are dealt to their shards once, when they are written. The vocabulary and the lists are made from that
    table where it lies.
    """
    spark = pages.sparkSession
    size = pages.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = tx.CHUNK_WORDS - tx.CHUNK_OVERLAP
    shards = max(1, -(-size // (6 * words * shard_rows)))  # a word and its blank take about 6 bytes
    shard = F.pmod(F.xxhash64("chunk_id"), F.lit(shards)).cast("int")
    buckets = min(shards, MAX_BUCKETS)
    if shards <= EVEN_SHARDS:  # few shards would fill the buckets unevenly
        keys = bucket_keys(spark, buckets)
        shard = F.get(F.lit(keys), F.pmod(shard, F.lit(len(keys))))
    chunks = _write_chunks(tx.chunk_pages(pages).withColumn("shard", shard), new_folder(spark, "chunks"), buckets, False)

    vocab = _numbered(chunks, stop_words, max_features, pattern)
    known = tx.Vocabulary.of(vocab)
    if known is None:
        raise ValueError(f"an index takes a vocabulary of at most {broadcast_rows(spark)} terms")
    stop = pa.array(list(stop_words), pa.string())
    tokens = tx.uncut("text", pattern).alias("tokens")
    made = chunks.select("shard", "chunk_id", tokens).groupBy("shard").applyInArrow(_lists(known, stop, pattern), _LISTS)
    return Index(chunks, _write_lists(made, new_folder(spark, "lists"), buckets), vocab, tuple(stop_words), pattern, buckets)


def _lists(known: tx.Vocabulary, stop: pa.Array, pattern: str | None):
    """The posting lists of a shard, and its row of names."""
    schema = pa.schema(
        [("shard", pa.int32()), ("number", pa.int32()), ("places", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64())),
         ("most", pa.float64()), ("names", pa.list_(pa.string()))]
    )

    def lists(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        ids = table["chunk_id"].combine_chunks()
        order = pc.sort_indices(ids)  # places are ranks by id; the tokens stay where they are
        names = ids.take(order).to_pylist()
        rank = np.empty(len(ids), np.int64)
        rank[np.asarray(order)] = np.arange(len(ids))
        slices = [piece["tokens"] for batch in table.to_batches() for piece in tx.pieces(batch, pattern)]
        parts = [known.weights(tokens, stop) for tokens in slices]
        begin = np.cumsum([0, *map(len, slices)])[:-1]
        place = np.concatenate([rank[row + low] for (row, _, _), low in zip(parts, begin)])
        number = np.concatenate([n for _, n, _ in parts])
        weight = np.concatenate([w for _, _, w in parts])
        order = np.lexsort((place, number))
        place, number, weight = place[order], number[order], weight[order]
        first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]][: len(number)])
        bounds = pa.array(np.r_[first, len(number)].astype(np.int32))
        count = len(first)
        most = np.maximum.reduceat(weight, first) if count else np.zeros(0)
        own = pa.table(
            [
                pa.array(np.full(count, shard, np.int32)),
                pa.array(number[first].astype(np.int32)),
                pa.ListArray.from_arrays(bounds, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(bounds, pa.array(weight)),
                pa.array(most),
                pa.nulls(count, pa.list_(pa.string())),
            ],
            schema=schema,
        )
        head = {"shard": shard, "number": NAMES, "places": None, "weights": None, "most": None, "names": names}
        return pa.concat_tables([pa.Table.from_pylist([head], schema=schema), own])

    return lists


def blank_queries(queries: DataFrame) -> DataFrame:
    """Queries that cannot be asked, with the reason."""
    blank = F.col("question").isNull() | (F.size(fn.words("question")) <= 0)
    return queries.filter(blank).withColumn("error", F.lit("Query must be a non-empty string."))


def _top(scores: DataFrame, item: str, k: int) -> DataFrame:
    """Best `k` items per query; equal scores (to 9 digits) go by item. Ranks are cut before the shuffle."""
    best = W.partitionBy("query_id").orderBy(F.round("score", DIGITS).desc(), F.col(item))
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def similar_chunks(queries: DataFrame, index: Index | Chunked, top_k: int = TOP_K, min_score: float = MIN_SCORE) -> DataFrame:
    """`(query_id, shard, chunk_id, score, rank)`: cosine over shared terms, best `top_k`, then the score cut.

    Without shards (a `Chunked` text) there is no column `shard`.

    A query without any known term has no rows. Every shard is searched where it lies and gives at most `top_k`
    chunks a question; blocks of chunks that cannot be among them, or reach the score cut, are not scored (see
    `postings`). Questions are taken in blocks; the rows of each of several blocks are written before the next is
    taken.
    """
    spark = queries.sparkSession
    known = tx.Vocabulary.of(index.vocabulary)
    if known is None:
        raise ValueError(f"a search takes a vocabulary of at most {broadcast_rows(spark)} terms")
    asked = queries.filter(F.col("question").rlike(fn.NOT_BLANK)).select("query_id", "question")
    weights = tx.weigh(asked, known, "query_id", "question", index.stop_words, index.pattern)
    weights = durable(weights.filter(F.size("numbers") > 0).select("query_id", "numbers", "weights"))
    blocks = max(1, -(-weights.count() // QUERY_BLOCK))
    path = new_folder(spark, "similar") if blocks > 1 else None
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for i in range(blocks):
        own = weights.filter(block == i).toArrow().to_pydict()
        asked = [(np.array(n), np.array(w)) for n, w in zip(own["numbers"], own["weights"])]
        if isinstance(index, Index):
            places = _search_lists(spark, asked, index, top_k, min_score)
        else:
            places = _scan_chunks(spark, asked, index, known, top_k, min_score)
        names = T.StructType([T.StructField("query", T.IntegerType()), weights.schema["query_id"]])
        ids = spark.createDataFrame(list(enumerate(own["query_id"])), names)
        named = places.join(F.broadcast(ids), "query").drop("query")
        found = _top(named, "chunk_id", top_k).filter(F.col("score") >= min_score)
        if path is None:
            return found
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _search_lists(spark: SparkSession, asked: list, index: Index, top_k: int, min_score: float) -> DataFrame:
    """The best of every shard for a block of questions."""
    sent = spark.sparkContext.broadcast(asked)  # at most QUERY_BLOCK questions, or a few more

    def search(table: pa.Table) -> pa.Table:
        found = {"query": [], "chunk_id": [], "score": []}
        names, lists = shard_postings(table)
        for q, (numbers, weights) in enumerate(sent.value):
            places, scores, _ = lists.best(numbers, weights, top_k, min_score)
            found["query"] += [q] * len(places)
            found["chunk_id"] += [names[p] for p in places.tolist()]
            found["score"] += scores.tolist()
        shard = [table["shard"][0].as_py()] * len(found["query"])
        kinds = {"query": pa.int32(), "shard": pa.int32(), "chunk_id": pa.string(), "score": pa.float64()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in (found | {"shard": shard}).items()}).select(list(kinds))

    terms = sorted({int(n) for numbers, _ in asked for n in numbers})
    lists = index.lists
    if len(terms) <= FEW_TERMS:  # one comparison a term, so that the scan skips the pages of all others
        lists = lists.filter(reduce(Column.__or__, [F.col("number") == n for n in [NAMES, *terms]]))
    return lists.groupBy("shard").applyInArrow(search, "query int, shard int, chunk_id string, score double")


def _scan_chunks(spark: SparkSession, asked: list, text: Chunked, known: tx.Vocabulary, top_k: int, min_score: float) -> DataFrame:
    """The best of every task for a block of questions; a task holds its best chunks so far besides its batch."""
    sent = spark.sparkContext.broadcast((asked, known))  # at most QUERY_BLOCK questions, or a few more
    stop, pattern = pa.array(list(text.stop_words), pa.string()), text.pattern

    def search(batches):
        asked, known = sent.value
        wanted = np.zeros(max(1, len(known.terms)), bool)
        wanted[[n for numbers, _ in asked for n in numbers.tolist()]] = True
        best = [[] for _ in asked]
        for batch in batches:
            for piece in tx.pieces(batch, pattern):
                row, number, weight = known.weights(piece["tokens"], stop)
                own = wanted[number]
                row, number, weight = row[own], number[own], weight[own]
                for q, (numbers, weights) in enumerate(asked):
                    factor = np.zeros(len(wanted))
                    factor[numbers] = weights
                    score = np.bincount(row, factor[number] * weight, minlength=piece.num_rows)
                    floor = max(min_score, best[q][-1][2]) if len(best[q]) == top_k else min_score
                    new = np.flatnonzero((score > 0) & (score >= floor - MARGIN))
                    ids = piece["chunk_id"].take(pa.array(new)).to_pylist()
                    scores = score[new]
                    ranked = zip((-np.round(scores, DIGITS)).tolist(), ids, scores.tolist())
                    best[q] = sorted([*best[q], *ranked])[:top_k]
        rows = [(q, name, score) for q, found in enumerate(best) for _, name, score in found]
        kinds = {"query": pa.int32(), "chunk_id": pa.string(), "score": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))

    rows = spread(text.chunks.select("chunk_id", "text")).select("chunk_id", tx.uncut("text", pattern).alias("tokens"))
    return rows.mapInArrow(search, "query int, chunk_id string, score double")


def shard_postings(table: pa.Table) -> tuple[list[str], Postings]:
    """The chunk ids of a shard by place, and its posting lists; rows in any order."""
    table = table.sort_by("number").combine_chunks()
    names = table["names"][0].as_py()
    own = table.slice(1)
    places, weights = own["places"].combine_chunks(), own["weights"].combine_chunks()
    sizes = np.asarray(pc.list_value_length(places)).astype(np.int64)
    flat = [np.asarray(pc.list_flatten(x)) for x in (places, weights)]
    return names, Postings(np.asarray(own["number"]).astype(np.int64), np.r_[0, np.cumsum(sizes)], flat[0].astype(np.int64), flat[1], len(names))


def retrieve(queries: DataFrame, index: Index | Chunked, top_k: int = TOP_K, min_score: float = MIN_SCORE) -> DataFrame:
    """Ranked evidence with its source: `(query_id, rank, document, page, section, evidence, score)`.

    Texts come from the shards of the chunks found; if these are few, only their buckets are read.
    """
    found = skew.checked_broadcast(similar_chunks(queries, index, top_k, min_score))
    if isinstance(index, Chunked):
        sources = index.chunks.select("chunk_id", "document", "page", "section", F.col("text").alias("evidence"))
        met = sources.join(found, "chunk_id")
        return met.select("query_id", "rank", "document", "page", "section", "evidence", "score")
    shards = [r["shard"] for r in found.select("shard").distinct().limit(FEW_SHARDS + 1).collect()]
    chunks = index.chunks
    if len(shards) <= FEW_SHARDS:
        chunks = chunks.filter(F.col("shard").isin(shards))
    sources = chunks.select("shard", "chunk_id", "document", "page", "section", F.col("text").alias("evidence"))
    met = sources.join(found, ["shard", "chunk_id"])
    return met.select("query_id", "rank", "document", "page", "section", "evidence", "score")


def dense_search(
    queries: DataFrame, vectors: DataFrame, top_k: int = TOP_K, limit: int = QUERY_BLOCK, pivots: int = PIVOTS
) -> DataFrame:
    """Exact cosine top-k of dense vectors: `queries(query_id, vector)`, `vectors(item_id, vector)`.

    Returns `(query_id, item_id, score, rank)`, scores to 9 digits; equal ones go by item. Vectors are searched where they
    lie: each block of rows is grouped around pivots, groups that cannot hold one of a query's best are left out (see
    `pivots`), and only ranks up to `top_k` move. Pivots come from a bounded sample and change no result. Queries are
    taken in blocks of about `limit`; the rows of each of several blocks are written before the next is taken. A
    vector of zeros scores 0. Vectors that are NULL, hold NULL or non-finite components, or are of another length than
    the query take no part.
    """
    spark = queries.sparkSession
    queries = durable(_numbers(queries, "query_id"))
    items = _numbers(vectors, "item_id")
    lengths = [r["n"] for r in queries.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]
    total = items.count()
    share = min(1.0, PIVOT_SAMPLE / max(total, 1))
    drawn = items.sample(share, seed=11).limit(2 * PIVOT_SAMPLE).select("vector").toArrow()["vector"].to_pylist()
    parts = []
    for n in lengths:  # one, unless models are mixed
        centres = pv.spread_out(pv.unit_rows(np.array([v for v in drawn if len(v) == n]).reshape(-1, n)), pivots)
        asked = queries.filter(F.size("vector") == n)
        blocks = max(1, -(-asked.count() // limit))
        block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
        parts += [(asked.filter(block == i), n, centres) for i in range(blocks)]
    kinds = T.StructType([queries.schema["query_id"], items.schema["item_id"], T.StructField("score", T.DoubleType())])
    if not parts:
        return spark.createDataFrame([], kinds).withColumn("rank", F.lit(1))
    path = new_folder(spark, "dense") if len(parts) > 1 else None
    for asked, n, centres in parts:
        found = _dense_block(asked, items.filter(F.size("vector") == n), centres, top_k, n)
        if path is None:
            return found
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _numbers(vectors: DataFrame, key: str) -> DataFrame:
    """The vectors that have a direction or are all zeros, as doubles."""
    numbers = F.col("vector").cast("array<double>")
    sound = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(key, numbers.alias("vector")).filter(F.coalesce(sound, F.lit(False)) & (F.size("vector") > 0))


def _dense_block(queries: DataFrame, items: DataFrame, centres: np.ndarray, top_k: int, n: int) -> DataFrame:
    spark = queries.sparkSession
    own = queries.toArrow()  # a block, about `limit` queries
    vectors = pv.unit_rows(np.array(own["vector"].to_pylist(), np.float64).reshape(-1, n))
    sent = spark.sparkContext.broadcast((vectors, centres))

    def search(batches):
        nearest = pv.Nearest(*sent.value, top_k)
        for batch in batches:
            for low in range(0, batch.num_rows, VECTOR_ROWS):
                part = batch.slice(low, VECTOR_ROWS)
                rows = np.asarray(part["vector"].flatten()).reshape(-1, n)
                rank = np.empty(len(rows), np.int64)
                rank[np.asarray(pc.array_sort_indices(part["item_id"], null_placement="at_start"))] = np.arange(len(rows))
                query, row, score = nearest.best(pv.unit_rows(rows), rank)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query.astype(np.int32)), part["item_id"].take(pa.array(row)), pa.array(score)], ["query", "item_id", "score"]
                )

    schema = T.StructType([T.StructField("query", T.IntegerType()), items.schema["item_id"], T.StructField("score", T.DoubleType())])
    found = items.mapInArrow(search, schema)
    names = T.StructType([T.StructField("query", T.IntegerType()), queries.schema["query_id"]])
    ids = spark.createDataFrame(list(enumerate(own["query_id"].to_pylist())), names)
    every = W.partitionBy("query").orderBy(F.col("score").desc(), "item_id")  # by place, since ids may repeat
    best = found.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= top_k)
    return best.join(F.broadcast(ids), "query").select("query_id", "item_id", "score", "rank")


# --- answers --------------------------------------------------------------


def _cited(e: Column, first: bool) -> Column:
    place = F.concat(
        e["document"],
        F.when(e["section"].isNotNull(), F.concat(F.lit(" ("), e["section"], F.lit(")"))).otherwise(""),
        F.lit(", page "),
        e["page"].cast("string"),
    )
    stated = F.regexp_replace(e["evidence"], rf"^{fn.BLANK}+|{fn.BLANK}+$", "")
    if first:
        return F.concat(F.lit("Based on "), place, F.lit(": "), stated)
    return F.concat(F.lit("Additionally, "), place, F.lit(" states: "), stated)


def answers(queries: DataFrame, evidence: DataFrame) -> DataFrame:
    """One cited, extractive answer per query: `(…queries, answer, grounded, sources)`.

    Evidence is at most `top_k` rows per query. Without any, the answer is the
    fixed message and `grounded` is false.
    """
    record = F.struct(
        "rank", "document", "page", "section", "evidence", F.round("score", 4).alias("score")
    )
    listed = evidence.groupBy("query_id").agg(F.sort_array(F.collect_list(record)).alias("sources"))
    texts = F.transform("sources", lambda e: F.when(e["rank"] == 1, _cited(e, True)).otherwise(_cited(e, False)))
    return (
        queries.join(listed, "query_id", "left")
        .withColumn("answer", F.coalesce(F.array_join(texts, " "), F.lit(wording.NO_EVIDENCE)))
        .withColumn("grounded", F.col("sources").isNotNull())
    )


def with_and_without(answered: DataFrame) -> DataFrame:
    """The evidence-based answer beside the fixed answer that has no access to the pages."""
    return answered.withColumn("answer_without_evidence", F.lit(wording.WITHOUT_EVIDENCE))


def machine_context(record: DataFrame) -> Column:
    """A sentence from the optional findings `cv_prediction, cv_confidence, nlp_prediction, nlp_confidence`."""

    def part(template: str, prediction: str, confidence: str) -> Column:
        value = F.coalesce(F.col(confidence), F.lit(0.0))
        return F.when(F.col(prediction).isNotNull(), F.format_string(template, F.col(prediction), value))

    details = F.concat_ws(
        ", ",
        part("vision inspection = %s (confidence %.2f)", "cv_prediction", "cv_confidence"),
        part("latest maintenance-note classification = %s (confidence %.2f)", "nlp_prediction", "nlp_confidence"),
    )
    start = F.concat(F.lit("Machine "), F.col("machine_id"), F.lit(": "))
    return F.when(F.col("machine_id").isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(start, F.when(details == "", F.lit("no Stage III findings available.")).otherwise(details))
    )
