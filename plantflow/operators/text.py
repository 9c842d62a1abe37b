"""Term counts, TF-IDF weights and overlapping chunks of page text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from plantflow.config import CHUNK_OVERLAP, CHUNK_WORDS
from plantflow.functions import columns as fn
from plantflow.operators import skew
from plantflow.session import broadcast_rows, durable, spread

MAX_FEATURES = 4096
CELLS = 1 << 17  # hash cells of the first counting pass
PIECE_TOKENS = 1 << 18  # tokens counted at once: what a task holds besides its batch
TOKEN_BYTES = 6  # of a token and its blank, about


def english_stop_words(spark: SparkSession) -> list[str]:
    """Spark's own English stop list; pass any other list where results must follow it."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


# --- terms of a document ----------------------------------------------------
#
# A document is one row, and its terms are found, counted and weighed inside that row: Spark cuts the text into
# tokens, or lower-cases it where they are plain runs of ASCII letters, and Arrow batches are worked through by vector
# functions. No text is moved.


def _token_rows(docs: DataFrame, id_column: str, text: str, pattern: str | None) -> DataFrame:
    return spread(docs.select(id_column, text)).select(F.col(id_column).alias("id"), uncut(text, pattern).alias("tokens"))


_RUNS = re.compile(r"\[((?:[a-z]-[a-z]|[0-9]-[0-9]|[a-z0-9])+)\]\{(\d+),\}")


def uncut(text: Column | str, pattern: str | None) -> Column:
    """What tasks cut into the tokens of a text: lower-cased text if tokens are runs of ASCII letters, else the tokens."""
    if pattern and _RUNS.fullmatch(pattern):
        return F.lower(F.col(text) if isinstance(text, str) else text)
    return fn.tokens(text, pattern=pattern) if pattern else fn.tokens(text)


def cut(texts: pa.StringArray, pattern: str) -> pa.ListArray:
    """Tokens of texts by a pattern like `[a-z0-9]{2,}`: maximal runs of such letters, of a least length."""
    letters, least = _RUNS.fullmatch(pattern).groups()
    known, least = np.array([bool(re.match(f"[{letters}]", chr(b))) for b in range(256)]), max(1, int(least))
    texts = pc.fill_null(texts, "")
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = known[data]
    filled = bounds[:-1][np.diff(bounds) > 0]  # a run ends with its text
    inner = filled[1:]
    inner = inner[inside[inner - 1] & inside[inner]]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    edges = np.sort(np.r_[edges, inner, inner]) if len(inner) else edges
    begin, size = edges[::2], edges[1::2] - edges[::2]
    short = size < least
    left_out = np.repeat(begin[short], size[short])
    inside[left_out + np.arange(len(left_out)) - np.repeat(np.cumsum(size[short]) - size[short], size[short])] = False
    begin, size = begin[~short], size[~short]
    ends = np.r_[0, np.cumsum(size)].astype(np.int32)
    values = pa.StringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, bounds).astype(np.int32)), values)


def pieces(batch: pa.RecordBatch, pattern: str | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PIECE_TOKENS tokens, at least one row each; texts left `uncut` are cut here."""
    whole = pa.types.is_string(batch["tokens"].type)
    sizes = pc.binary_length(batch["tokens"]) if whole else batch["tokens"].value_lengths()
    ends = np.cumsum(np.asarray(pc.fill_null(sizes, 0)).astype(np.int64))
    most = PIECE_TOKENS * (TOKEN_BYTES if whole else 1)
    at = 0
    while at < batch.num_rows:
        begin = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, begin + most, "right")))
        piece = batch.slice(at, end - at)
        yield piece.set_column(piece.schema.get_field_index("tokens"), "tokens", cut(piece["tokens"], pattern)) if whole else piece
        at = end


def _unigrams(tokens: pa.ListArray, stop: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of all tokens of lists, stop words left out, and the word of each code (stop words included)."""
    sizes = np.asarray(pc.fill_null(tokens.value_lengths(), 0)).astype(np.int64)
    coded = tokens.flatten().dictionary_encode()
    row, code = np.repeat(np.arange(len(sizes)), sizes), np.asarray(coded.indices).astype(np.int64)
    if len(stop):
        kept = ~np.asarray(pc.is_in(coded.dictionary, value_set=stop))[code]
        row, code = row[kept], code[kept]
    return row, code, coded.dictionary


def _hashes(words: pa.StringArray) -> np.ndarray:
    """A number for each word (of an array that is no slice), the same in every task; overflow is wanted."""
    sizes = np.asarray(pc.binary_length(words)).astype(np.int64)
    ends = np.cumsum(sizes)
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8, int(sizes.sum())).astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x100000001B3, np.uint64))
    upto = np.r_[np.uint64(0), np.cumsum(letters * powers[place])]
    return upto[ends] - upto[ends - sizes]


class _Counted:
    """Uni- and bigrams of token lists as numbers: words by their code, pairs of codes behind them.

    Terms are sorted as plain numbers, and spelt out only where they are asked for.
    """

    def __init__(self, tokens: pa.ListArray, stop: pa.Array):
        self.rows = max(1, len(tokens))
        row, code, self.words = _unigrams(tokens, stop)
        self.width = max(1, len(self.words))
        self.code, same = code, row[:-1] == row[1:]
        # row and term of every occurrence; first and second word of every pair
        self.first, self.second = code[:-1][same], code[1:][same]
        self.row = np.r_[row, row[:-1][same]]
        self.term = np.r_[code, self.width * (1 + self.first) + self.second]

    def by_document(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of occurrences of every term of every document."""
        span = self.width * (self.width + 1)
        key, tf = np.unique(self.row * span + self.term, return_counts=True)
        row, term = np.divmod(key, span)
        return row, term, tf

    def totals(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, occurrences and documents with the term, of the chosen occurrences."""
        key, tf = np.unique(self.term[chosen] * self.rows + self.row[chosen], return_counts=True)
        term = key // self.rows
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
        total = np.add.reduceat(tf, first) if len(first) else tf
        return term[first], total, np.diff(np.r_[first, len(term)])

    def spelt(self, terms: np.ndarray) -> pa.Array:
        """The texts of some terms."""
        first, second = np.divmod(terms, self.width)
        single = first == 0
        names = self.words.take(pa.array(np.where(single, second, first - 1)))
        if single.all():
            return names
        behind = self.words.take(pa.array(second))
        return pc.if_else(pa.array(single), names, pc.binary_join_element_wise(names, behind, " "))

    def cells(self, cells: int) -> np.ndarray:
        """Hash cell of every occurrence."""
        word = _hashes(self.words)
        pair = word[self.first] * np.uint64(0x9E3779B97F4A7C15) + word[self.second] + np.uint64(1)
        mixed = np.r_[word[self.code], pair] * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)).astype(np.int64) % cells


def term_counts(docs: DataFrame, id_column: str, text: str = "text", stop_words: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """Uni- and bigram counts `(id, term, tf)` of every document."""
    rows = _token_rows(docs, id_column, text, pattern)
    stop = pa.array(list(stop_words), pa.string())
    schema = T.StructType([T.StructField(id_column, rows.schema["id"].dataType), *T.StructType.fromDDL("term string, tf long")])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, pattern):
                held = _Counted(piece["tokens"], stop)
                row, term, tf = held.by_document()
                yield pa.RecordBatch.from_arrays([piece["id"].take(pa.array(row)), held.spelt(term), pa.array(tf)], schema.names)

    return rows.mapInArrow(run, schema)


# --- vocabulary -----------------------------------------------------------
#
# The most frequent terms are found in two passes, so that the long tail of terms is never moved. The first adds up
# occurrences by hash cell, of which there is a fixed number; a cell's mass is at least the count of every term in it.
# The second counts exactly the terms of the heaviest cells. The k-th count found there is a floor of the true one;
# only if cells that were left out reach that floor are their terms counted as well. Exact at every size.


def _most_frequent(sketch: DataFrame, totals: Callable[[np.ndarray], DataFrame], k: int, cells: int) -> DataFrame:
    """`(term, total, df)` of the k terms of largest total; ties go to the alphabetically first.

    `sketch` has `(cell, mass)`; `totals(heavy)` counts all terms of the cells that are marked.
    """
    found = sketch.groupBy("cell").agg(F.sum("mass").alias("mass")).toArrow()  # at most `cells` rows
    mass = np.zeros(cells, np.int64)
    mass[np.asarray(found["cell"])] = np.asarray(found["mass"])

    def first(heavy: np.ndarray) -> DataFrame:
        return durable(totals(heavy).orderBy(F.col("total").desc(), "term").limit(k))

    heavy = mass >= max(1, np.partition(mass, -4 * k)[-4 * k] if 4 * k < cells else 1)
    best = first(heavy)
    reached, floor = best.agg(F.count(F.lit(1)), F.min("total")).first()
    needed = mass >= (floor if reached == k else 1)
    return first(needed) if (needed & ~heavy).any() else best


def _with_idf(best: DataFrame, documents: DataFrame) -> DataFrame:
    n = documents.agg(F.count(F.lit(1)).alias("n"))
    return best.withColumn("idf", F.log((1.0 + n.scalar()) / (1.0 + F.col("df"))) + 1.0)


def vocabulary(counts: DataFrame, documents: DataFrame, max_features: int = MAX_FEATURES, cells: int = CELLS) -> DataFrame:
    """The most frequent terms of `term_counts` with their smooth inverse document frequency: `(term, total, df, idf)`.

    Ties in the corpus count go to the alphabetically first term. `documents` has one row per fitted document.
    """
    placed = counts.select("term", "tf", F.pmod(F.xxhash64("term"), F.lit(cells)).cast("int").alias("cell"))

    def totals(heavy: np.ndarray) -> DataFrame:
        chosen = counts.sparkSession.createDataFrame(pa.table({"cell": np.flatnonzero(heavy).astype(np.int32)}))
        found = placed.join(F.broadcast(chosen), "cell", "left_semi").groupBy("term")  # at most `cells` numbers
        return found.agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))

    return _with_idf(_most_frequent(placed.withColumnRenamed("tf", "mass"), totals, max_features, cells), documents)


def fit_vocabulary(
    docs: DataFrame, text: str = "text", max_features: int = MAX_FEATURES, stop_words: Sequence[str] = (), pattern: str | None = None, cells: int = CELLS
) -> DataFrame:
    """The same vocabulary straight from texts, one row a document: terms outside heavy cells are never spelt out."""
    rows = _token_rows(docs, text, text, pattern).select("tokens")
    stop = pa.array(list(stop_words), pa.string())

    def add_up(batches):
        mass = np.zeros(cells, np.int64)
        for batch in batches:
            for piece in pieces(batch, pattern):
                mass += np.bincount(_Counted(piece["tokens"], stop).cells(cells), minlength=cells)
        some = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(mass[some])], ["cell", "mass"])

    def totals(heavy: np.ndarray) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(np.packbits(heavy))  # `cells` bits

        def count(batches):
            wanted = np.unpackbits(shared.value, count=cells).astype(bool)
            for batch in batches:
                for piece in pieces(batch, pattern):
                    held = _Counted(piece["tokens"], stop)
                    term, tf, df = held.totals(wanted[held.cells(cells)])
                    yield pa.RecordBatch.from_arrays([held.spelt(term), pa.array(tf), pa.array(df)], ["term", "tf", "df"])

        found = rows.mapInArrow(count, "term string, tf long, df long").groupBy("term")
        return found.agg(F.sum("tf").alias("total"), F.sum("df").alias("df"))

    return _with_idf(_most_frequent(rows.mapInArrow(add_up, "cell int, mass long"), totals, max_features, cells), docs)


# --- weights --------------------------------------------------------------


def tfidf(counts: DataFrame, vocab: DataFrame, id_column: str) -> DataFrame:
    """L2-normalised TF-IDF weights `(id, term, weight)` from counts, whatever the size of the vocabulary."""
    raw = counts.join(skew.checked_broadcast(vocab.select("term", "idf")), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_column)))
    return raw.select(id_column, "term", (F.col("_w") / norm).alias("weight"))


def tfidf_of(
    docs: DataFrame, vocab: DataFrame, id_column: str, text: str = "text", stop_words: Sequence[str] = (), pattern: str | None = None
) -> DataFrame:
    """The same weights straight from texts, worked out inside each document's row."""
    known = Vocabulary.of(vocab)
    if known is None:
        return tfidf(term_counts(docs, id_column, text, stop_words, pattern), vocab, id_column)
    rows = weigh(docs, known, id_column, text, stop_words, pattern)
    pairs = F.arrays_zip(F.col("terms").alias("term"), F.col("weights").alias("weight"))
    return rows.select(id_column, F.inline(pairs))


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary small enough to be handed to every task, its terms in order."""

    terms: pa.Array
    idf: np.ndarray
    words: pa.Array  # all texts that a term is, or is made of by a blank
    single: np.ndarray  # term number of a word, or -1
    pairs: np.ndarray  # pairs of words that are a term, as one number, in order
    paired: np.ndarray  # their term numbers

    @staticmethod
    def of(vocab: DataFrame) -> Vocabulary | None:
        """The vocabulary, or None if it has more terms than a task should hold."""
        limit = broadcast_rows(vocab.sparkSession)
        rows = vocab.select("term", "idf").limit(limit + 1).collect()
        if len(rows) > limit:
            return None
        rows = sorted((r["term"], r["idf"]) for r in rows)
        return Vocabulary.made([t for t, _ in rows], np.array([x for _, x in rows], np.float64))

    @staticmethod
    def made(terms: list[str], idf: np.ndarray) -> Vocabulary:
        halves = [(t[:i], t[i + 1 :], n) for n, t in enumerate(terms) for i, letter in enumerate(t) if letter == " "]
        words = sorted({*terms, *(w for a, b, _ in halves for w in (a, b))})
        at = {w: i for i, w in enumerate(words)}
        single = np.full(len(words), -1, np.int64)
        single[[at[t] for t in terms]] = np.arange(len(terms))
        found = sorted((at[a] * len(words) + at[b], n) for a, b, n in halves)
        pairs, paired = (np.array([x[i] for x in found], np.int64) for i in (0, 1))
        return Vocabulary(pa.array(terms, pa.string()), idf, pa.array(words, pa.string()), single, pairs, paired)

    def weights(self, tokens: pa.ListArray, stop: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term number and normalised weight of every known term of token lists, in order of row and number."""
        row, code, words = _unigrams(tokens, stop)
        word = np.asarray(pc.fill_null(pc.index_in(words, value_set=self.words), -1)).astype(np.int64)[code]
        alone = np.flatnonzero(word >= 0)
        alone = alone[self.single[word[alone]] >= 0]
        pair = np.flatnonzero((word[:-1] >= 0) & (word[1:] >= 0) & (row[:-1] == row[1:]))
        key = word[pair] * len(self.words) + word[pair + 1]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        met = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), bool)
        row = np.r_[row[alone], row[pair[met]]]
        number = np.r_[self.single[word[alone]], self.paired[at[met]]]
        width = max(1, len(self.terms))
        key, tf = np.unique(row * width + number, return_counts=True)
        row, number = key // width, key % width
        weight = tf * self.idf[number]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(tokens)))
        return row, number, weight / norm[row]


def weigh(
    docs: DataFrame, known: Vocabulary, id_column: str, text: str = "text", stop_words: Sequence[str] = (), pattern: str | None = None
) -> DataFrame:
    """`(id, numbers, terms, weights)`: the known terms of each document as arrays, in the order of the terms."""
    rows = _token_rows(docs, id_column, text, pattern)
    stop = pa.array(list(stop_words), pa.string())
    lists = T.StructType.fromDDL("numbers array<int>, terms array<string>, weights array<double>")
    schema = T.StructType([T.StructField(id_column, rows.schema["id"].dataType), *lists])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, pattern):
                row, number, weight = known.weights(piece["tokens"], stop)
                bounds = pa.array(np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32))
                held = [pa.array(number.astype(np.int32)), known.terms.take(pa.array(number)), pa.array(weight)]
                columns = [piece["id"], *(pa.ListArray.from_arrays(bounds, x) for x in held)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def dense_rows(
    docs: DataFrame, known: Vocabulary, id_column: str, text: str = "text", stop_words: Sequence[str] = (), pattern: str | None = None
) -> DataFrame:
    """`(id, features)`: one array of all weights per document over a short vocabulary (a classifier's input)."""
    rows = _token_rows(docs, id_column, text, pattern)
    stop, width = pa.array(list(stop_words), pa.string()), len(known.terms)
    schema = T.StructType([T.StructField(id_column, rows.schema["id"].dataType), *T.StructType.fromDDL("features array<double>")])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, pattern):
                row, number, weight = known.weights(piece["tokens"], stop)
                values = np.zeros((piece.num_rows, width))
                values[row, number] = weight
                bounds = pa.array((np.arange(piece.num_rows + 1) * width).astype(np.int32))
                arrays = pa.ListArray.from_arrays(bounds, pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([piece["id"], arrays], schema.names)

    return rows.mapInArrow(run, schema)


# --- chunks ---------------------------------------------------------------


# A heading stands at the start of a line, blanks in front of it aside. `str.split` and `str.rstrip` know the blanks of
# `fn.BLANK`.
_BLANK_IN_LINE = r"[\t\x0b\f\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
_HEADING = r"Section[ \t\x0b\f\r]+[0-9]+"
_BEFORE_HEADING = re.compile(rf"\n(?={_BLANK_IN_LINE}{_HEADING})")
_HEADING_LINE = re.compile(rf"{_BLANK_IN_LINE}({_HEADING}[^\n]*)")


def _chunks_of(text: str, size: int, overlap: int) -> Iterator[tuple[int, str | None, str, int]]:
    """Number, section, text and word count of the chunks of a page."""
    words, headings = [], []
    for part in _BEFORE_HEADING.split(text):
        if line := _HEADING_LINE.match(part):
            headings.append((len(words), line[1].rstrip()))
        words += part.split()
    above, section = 0, None
    for at in range(-(-max(0, len(words) - size) // (size - overlap)) + 1 if words else 0):
        start = at * (size - overlap)
        own = words[start : start + size]
        while above < len(headings) and headings[above][0] < start + len(own):
            section, above = headings[above][1], above + 1
        yield at + 1, section, " ".join(own), len(own)


def chunk_pages(pages: DataFrame, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Overlapping word windows per page, each with its nearest preceding section heading.

    `(document, page, chunk_no, chunk_id, section, text, word_count)`. A page is one row, and its chunks are made from
    that row alone: the text is cut before every heading line, the words of the parts are strung together, and only
    the finished chunks go on, about PIECE_TOKENS words at once. Work is proportional to the text, and nothing moves.
    """
    sound = F.when(F.is_valid_utf8("text"), F.col("text")).otherwise(F.get(F.split("text", "(?!)"), F.lit(0)))  # bad bytes replaced
    rows = spread(pages.select("document", "page", "text")).withColumn("text", sound)
    schema = T.StructType([*rows.schema.fields[:2], *T.StructType.fromDDL("chunk_no int, section string, text string, word_count int")])
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int32()]

    def run(batches):
        for batch in batches:
            row, made, held = [], [], 0
            for i, text in enumerate(batch["text"]):
                own = list(_chunks_of(text.as_py(), size, overlap)) if text.is_valid else []
                row += [i] * len(own)
                made += own
                held += sum(chunk[3] for chunk in own)
                if held > PIECE_TOKENS or (made and i == batch.num_rows - 1):
                    places = pa.array(row)
                    columns = [pa.array(values, kind) for values, kind in zip(zip(*made), kinds)]
                    yield pa.RecordBatch.from_arrays([batch["document"].take(places), batch["page"].take(places), *columns], schema.names)
                    row, made, held = [], [], 0

    number = F.concat_ws(":", "document", "page", "chunk_no")
    made = rows.mapInArrow(run, schema)
    return made.select("document", "page", "chunk_no", number.alias("chunk_id"), "section", "text", "word_count")


def ingestion_summary(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Distinct documents, usable pages and chunks."""
    n = chunks.agg(F.count(F.lit(1)).alias("n"))
    return pages.agg(
        F.sort_array(F.collect_set("document")).alias("documents_ingested"), F.count(F.lit(1)).alias("pages_extracted")
    ).withColumn("chunks_created", n.scalar())
