"""Queries: note cleaning, term weights, chunks, retrieval and cited answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow import wording
from plantflow.functions import columns as fn
from plantflow.operators import retrieve, text as tx
from plantflow.plans import sql_tables  # noqa: F401  (defines the common tables)
from plantflow.plans.registry import common, query, rounded
from plantflow.session import spread
from plantflow.sources import readers, star_inputs as inputs

# A short stop list and an ASCII token pattern that both engines read alike.
STOP = ["the", "of", "and", "in", "on", "that", "de", "la", "der", "die"]
TOKEN = "[a-z0-9]{2,}"

_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
_CLEAN = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _terms(source: str, id_column: str, text: str, stop: bool) -> str:
    found = f"regexp_extract_all(lower({text}), '{TOKEN}')"
    if stop:
        found = f"list_filter({found}, lambda t: NOT list_contains({_STOP_SQL}, t))"
    return f"""
SELECT {id_column}, term, count(*) AS tf FROM (
  SELECT {id_column}, unnest(list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
  FROM (SELECT {id_column}, {found} AS toks FROM {source})) GROUP BY {id_column}, term"""


def _vocabulary(counts: str, documents: str, limit: int) -> str:
    return f"""
SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df, ln((1.0::DOUBLE + (SELECT count(*) FROM {documents})) / (1.0::DOUBLE + count(*))) + 1.0 AS idf
FROM {counts} GROUP BY term ORDER BY total DESC, term LIMIT {limit}"""


def _weights(counts: str, vocab: str, id_column: str) -> str:
    return f"""
SELECT {id_column}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id_column})) AS weight
FROM (SELECT c.{id_column}, c.term, c.tf * v.idf AS w FROM {counts} c JOIN {vocab} v ON c.term = v.term)"""


common("notes", f"SELECT doc_id, {_CLEAN} AS note FROM documents")
common("note_terms", _terms("notes", "doc_id", "note", True), ("notes",))
common("note_vocabulary", _vocabulary("note_terms", "notes", 200), ("note_terms", "notes"))
common("note_weights", _weights("note_terms", "note_vocabulary", "doc_id"), ("note_terms", "note_vocabulary"))
common(
    "page_lines",
    f"""
SELECT document, page, i, lines[i] AS line FROM (
  SELECT document, page, list_filter(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(s, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda s: s <> '') AS lines FROM page_text
), unnest(range(1, len(lines) + 1)) AS l(i)""",
    ("page_text",),
)
common(
    "page_words",
    f"""
SELECT document, page, i, word, row_number() OVER (PARTITION BY document, page ORDER BY i, j) - 1 AS pos, count(*) OVER (PARTITION BY document, page) AS n FROM (
  SELECT document, page, i, j, ws[j] AS word FROM (
    SELECT *, list_filter(regexp_split_to_array(line, '{_BLANK}+'), lambda x: x <> '') AS ws FROM page_lines), unnest(range(1, len(ws) + 1)) AS w(j))""",
    ("page_lines",),
)
common(
    "chunk_words",
    """
SELECT s.document, s.page, s.c + 1 AS chunk_no, string_agg(w.word, ' ' ORDER BY w.pos) AS text, count(*) AS word_count, max(w.i) AS last_line FROM (
  SELECT document, page, c FROM (SELECT DISTINCT document, page, n FROM page_words), unnest(range(0, 1 + CAST(greatest(0, ceil((n - 90) / 70.0)) AS BIGINT))) AS t(c)) s
JOIN page_words w ON w.document = s.document AND w.page = s.page AND w.pos BETWEEN s.c * 70 AND s.c * 70 + 89 GROUP BY s.document, s.page, s.c""",
    ("page_words",),
)
common(
    "chunks",
    r"""
SELECT c.document, c.page, c.chunk_no, c.document || ':' || c.page || ':' || c.chunk_no AS chunk_id, any_value(c.text) AS text, any_value(c.word_count) AS word_count,
  arg_max(h.line, h.i) AS section
FROM chunk_words c LEFT JOIN (SELECT * FROM page_lines WHERE regexp_matches(line, '(?s)^Section\s+\d+[:\-]?\s*.*$')) h ON h.document = c.document AND h.page = c.page AND h.i <= c.last_line
GROUP BY c.document, c.page, c.chunk_no""",
    ("chunk_words", "page_lines"),
)
common("chunk_terms", _terms("chunks", "chunk_id", "text", True), ("chunks",))
common("chunk_vocabulary", _vocabulary("chunk_terms", "chunks", tx.MAX_FEATURES), ("chunk_terms", "chunks"))
common("chunk_weights", _weights("chunk_terms", "chunk_vocabulary", "chunk_id"), ("chunk_terms", "chunk_vocabulary"))
common("asked", "SELECT item_id AS query_id, text AS question FROM benchmark")
common("asked_terms", _terms("asked", "query_id", "question", True), ("asked",))
common("asked_weights", _weights("asked_terms", "chunk_vocabulary", "query_id"), ("asked_terms", "chunk_vocabulary"))
CUT = 0.4


def _evidence(cut: float) -> str:
    return f"""
SELECT query_id, rank, c.document, c.page, c.section, c.text AS evidence, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM (
    SELECT a.query_id, w.chunk_id, sum(a.weight * w.weight) AS score FROM asked_weights a JOIN chunk_weights w ON a.term = w.term GROUP BY a.query_id, w.chunk_id)) s
JOIN chunks c USING (chunk_id) WHERE rank <= 4 AND score >= {cut}"""


for _name, _cut in (("evidence", CUT), ("evidence_by_default", retrieve.MIN_SCORE)):
    common(_name, _evidence(_cut), ("asked_weights", "chunk_weights", "chunks"))


def _notes(spark, sf_dir):
    return spread(inputs.table(spark, sf_dir, "documents")).select("doc_id", fn.clean_text("text").alias("note"))


def _index(spark, sf_dir) -> retrieve.Index:
    pages = readers.usable_pages(inputs.pages(spark, sf_dir))
    return retrieve.build_index(pages, STOP, pattern=TOKEN)


def _chunked(spark, sf_dir) -> retrieve.Chunked:
    pages = readers.usable_pages(inputs.pages(spark, sf_dir))
    return retrieve.chunked(pages, STOP, pattern=TOKEN)


def _questions(spark, sf_dir):
    return inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


@query("clean_text", "SELECT doc_id, length(note) AS chars, md5(note) AS digest FROM notes", ("notes",))
def clean_text(spark, sf_dir):
    return _notes(spark, sf_dir).select("doc_id", F.length("note").cast("bigint").alias("chars"), F.md5(F.col("note").cast("binary")).alias("digest"))


@query("term_counts", "SELECT doc_id, term, tf FROM note_terms", ("note_terms",))
def term_counts(spark, sf_dir):
    """Uni- and bigram counts of whole documents."""
    return tx.term_counts(_notes(spark, sf_dir), "doc_id", "note", STOP, TOKEN)


@query("vocabulary", "SELECT term, total, df, round(idf, 6) AS idf FROM note_vocabulary", ("note_vocabulary",))
def vocabulary(spark, sf_dir):
    notes = _notes(spark, sf_dir)
    return rounded(tx.fit_vocabulary(notes, "note", 200, STOP, TOKEN))


@query("tfidf", "SELECT doc_id, term, round(weight, 6) AS weight FROM note_weights", ("note_weights",))
def tfidf(spark, sf_dir):
    """Normalised TF-IDF weights over the 200 most frequent terms."""
    notes = _notes(spark, sf_dir)
    vocab = tx.fit_vocabulary(notes, "note", 200, STOP, TOKEN)
    return rounded(tx.tfidf_of(notes, vocab, "doc_id", "note", STOP, TOKEN))


@query(
    "tfidf_transform",
    "SELECT item_id, term, round(weight, 6) AS weight FROM ("
    + _weights("(" + _terms("(SELECT item_id, " + _CLEAN + " AS note FROM benchmark)", "item_id", "note", True) + ")", "note_vocabulary", "item_id")
    + ")",
    ("note_vocabulary",),
)
def tfidf_transform(spark, sf_dir):
    """Weights of new texts under a vocabulary fitted on others."""
    notes = _notes(spark, sf_dir)
    vocab = tx.fit_vocabulary(notes, "note", 200, STOP, TOKEN)  # fitted on notes only
    items = inputs.table(spark, sf_dir, "benchmark").select("item_id", fn.clean_text("text").alias("note"))
    return rounded(tx.tfidf(tx.term_counts(items, "item_id", "note", STOP, TOKEN), vocab, "item_id"))


@query("usable_pages", rf"SELECT document, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS chars FROM page_text WHERE NOT regexp_full_match(text, '{_BLANK}*') GROUP BY document", ("page_text",))
def usable_pages(spark, sf_dir):
    pages = readers.usable_pages(inputs.pages(spark, sf_dir))
    return pages.groupBy("document").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("chars"))


@query("page_chunks", "SELECT document, page, chunk_no, chunk_id, section, md5(text) AS digest, word_count FROM chunks", ("chunks",))
def page_chunks(spark, sf_dir):
    """Windows of 90 words with 20 words of overlap and their section headings."""
    chunks = tx.chunk_pages(inputs.pages(spark, sf_dir))
    return chunks.withColumn("digest", F.md5(F.col("text").cast("binary"))).drop("text")


@query(
    "ingestion_summary",
    "SELECT array_to_string(list_sort(list(DISTINCT document)), ',') AS documents_ingested, count(DISTINCT page) AS pages_extracted, (SELECT count(*) FROM chunks) AS chunks_created FROM page_words",
    ("chunks", "page_words"),
)
def ingestion_summary(spark, sf_dir):
    pages = readers.usable_pages(inputs.pages(spark, sf_dir))
    summary = tx.ingestion_summary(pages, tx.chunk_pages(pages))
    return summary.withColumn("documents_ingested", F.array_join("documents_ingested", ","))


@query("normalised_postings", "SELECT chunk_id, count(*) AS terms, round(sqrt(sum(weight * weight)), 6) AS norm, round(sum(weight), 6) AS total FROM chunk_weights GROUP BY chunk_id", ("chunk_weights",))
def normalised_postings(spark, sf_dir):
    """Every indexed chunk has weights of length 1."""
    postings = _index(spark, sf_dir).postings
    return rounded(
        postings.groupBy("chunk_id").agg(
            F.count(F.lit(1)).alias("terms"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"), F.sum("weight").alias("total")
        )
    )


@query(
    "retrieve_evidence",
    "SELECT query_id, rank, document, page, section, md5(evidence) AS digest, round(score, 6) AS score FROM evidence",
    ("evidence",),
)
def retrieve_evidence(spark, sf_dir):
    """The four most similar chunks of every benchmark item, cut by score afterwards."""
    found = retrieve.retrieve(_questions(spark, sf_dir), _index(spark, sf_dir), min_score=CUT)
    return rounded(found.withColumn("digest", F.md5(F.col("evidence").cast("binary"))).drop("evidence"))


_TEXT = "document || coalesce(' (' || section || ')', '') || ', page ' || page"


@query(
    "cited_answers",
    f"""
SELECT q.query_id, md5(coalesce(a.answer, '{wording.NO_EVIDENCE}')) AS digest, a.answer IS NOT NULL AS grounded, coalesce(n, 0) AS sources
FROM asked q LEFT JOIN (
  SELECT query_id, count(*) AS n, string_agg(CASE WHEN rank = 1 THEN 'Based on ' || {_TEXT} || ': ' || evidence ELSE 'Additionally, ' || {_TEXT} || ' states: ' || evidence END, ' ' ORDER BY rank) AS answer
  FROM evidence GROUP BY query_id) a ON a.query_id = q.query_id""",
    ("asked", "evidence"),
)
def cited_answers(spark, sf_dir):
    """One extractive answer per benchmark item, or the fixed message."""
    questions = _questions(spark, sf_dir)
    answered = retrieve.answers(questions, retrieve.retrieve(questions, _index(spark, sf_dir), min_score=CUT))
    return answered.select(
        "query_id",
        F.md5(F.col("answer").cast("binary")).alias("digest"),
        "grounded",
        F.coalesce(F.size("sources"), F.lit(0)).cast("bigint").alias("sources"),
    )


@query(
    "answer_comparison",
    f"SELECT CASE WHEN e.query_id IS NULL THEN 'no evidence' ELSE 'evidence' END AS kind, count(*) AS questions, any_value('{wording.WITHOUT_EVIDENCE.replace(chr(39), chr(39) * 2)}') AS answer_without_evidence FROM asked a LEFT JOIN (SELECT DISTINCT query_id FROM evidence) e USING (query_id) GROUP BY 1",
    ("asked", "evidence"),
)
def answer_comparison(spark, sf_dir):
    """Answers with evidence beside the fixed one without."""
    questions = _questions(spark, sf_dir)
    answered = retrieve.answers(questions, retrieve.retrieve(questions, _index(spark, sf_dir), min_score=CUT))
    both = retrieve.with_and_without(answered)
    return both.groupBy(F.when(F.col("grounded"), "evidence").otherwise("no evidence").alias("kind")).agg(
        F.count(F.lit(1)).alias("questions"), F.first("answer_without_evidence").alias("answer_without_evidence")
    )


@query(
    "dense_search",
    """
WITH v AS (SELECT vec_id AS item_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vector FROM embeddings),
parts AS (SELECT label, p, avg(vector[p]) AS x FROM v, unnest(range(1, 65)) AS r(p) GROUP BY label, p),
q AS (SELECT label AS query_id, list(x ORDER BY p) AS vector FROM parts GROUP BY label)
SELECT query_id, item_id, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
    SELECT q.query_id, v.item_id, list_cosine_similarity(v.vector, q.vector) AS score FROM v, q)) WHERE rank <= 4""",
)
def dense_search(spark, sf_dir):
    """The four vectors closest to the mean vector of each label."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("p", "x")).groupBy("label", "p").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = parts.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("p", "x"))), lambda e: e["x"]).alias("vector")
    )
    items = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return rounded(retrieve.dense_search(means, items))
