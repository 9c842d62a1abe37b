"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plantflow.llm import (
    bpe,
    decontaminate,
    language,
    lexical,
    pieces,
    quality,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    topk,
    toxicity,
    url_filter,
)

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def add(job: Job) -> Job:
        QUERIES[name] = job
        if sql is not None:
            SQL[name] = sql
        return job

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
    win AS (
      SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
      FROM w, unnest(range(1, greatest(len(ws) - 48, 1))) AS u(i) WHERE len(ws) >= 50),
    first AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
    gone AS (
      SELECT DISTINCT win.doc_id, win.i + k AS p
      FROM win JOIN first USING (h), unnest(range(0, 50)) AS v(k) WHERE first.d < win.doc_id),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
    kept AS (
      SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.p) AS t
      FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
    SELECT w.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words,
      (coalesce(len(ws), 0) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(
    "op3_suffix_dedup",
    """
    WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
    win AS (
      SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS h
      FROM t, unnest(range(0, greatest(len(x) // 2 - 99, 0))) AS u(i)),
    ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM win),
    runs AS (
      SELECT doc_id, i, CASE WHEN i - lag(i) OVER w <= 100 THEN 0 ELSE 1 END AS opens
      FROM ranked WHERE r > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM runs),
    spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS z FROM numbered GROUP BY doc_id, k),
    edges AS (
      SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM spans),
    pieces AS (
      SELECT e.doc_id, string_agg(substr(x, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head,
        max(z) AS tail, sum(z - a) AS gone, count(*) AS n
      FROM edges e JOIN t USING (doc_id) GROUP BY e.doc_id)
    SELECT t.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
      coalesce(n, 0)::BIGINT AS n_spans,
      sha256(unhex(CASE WHEN gone IS NULL THEN x ELSE head || substr(x, 2 * tail + 1) END)) AS kept_sha256
    FROM t LEFT JOIN pieces USING (doc_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), texts=False)


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


@query(
    "op2_url_filter",
    """
    WITH p AS (
      SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    s AS (
      SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
      FROM p),
    m AS (
      SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
      FROM s)
    SELECT page_id, host, path, rule,
      CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM m
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


@query(
    "op6_exact_topk",
    """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.r, q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v AS q JOIN v ON len(q.e) = len(v.e) AND q.r <> v.r WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.load(spark))


@query("op11_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.load(spark))


@query(
    "op12_lexical_search",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
      FROM documents),
    q AS (
      SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    w AS (
      SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
    m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(ts) * n_docs) // n_terms) AS m FROM d, total WHERE len(ts) > 0),
    scored AS (
      SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM (SELECT q, item_id, unnest(ts) AS term FROM q) JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r)
      GROUP BY q, item_id, r, doc_id),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


@query(
    "op13_spelling_variants",
    r"""
    WITH RECURSIVE crc AS (
      SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
      FROM (SELECT unnest(range(256)) AS n)),
    runs AS (
      SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
    counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
    bytes AS (
      SELECT run, n, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS bs
      FROM (SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS x FROM counted)),
    hashed AS (
      SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, bs), lambda c, x:
        xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
      FROM bytes, crc),
    changed AS (
      SELECT n, CASE WHEN h % 97 <> 0 THEN run
        ELSE substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) END AS word
      FROM hashed),
    words AS (
      SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cut AS (
      SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
      SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
      UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
    best AS (
      SELECT near.word, count(*)::BIGINT AS n_near, arg_max(other, (o.n, -o.place)) AS other, max(o.n) AS other_n
      FROM near JOIN (SELECT *, row_number() OVER (ORDER BY word) AS place FROM words) o ON o.word = near.other
      GROUP BY near.word),
    named AS (
      SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
        CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
      FROM words LEFT JOIN best USING (word)),
    chain AS (
      SELECT word, word AS at FROM named
      UNION ALL SELECT chain.word, named.form FROM chain JOIN named ON named.word = chain.at WHERE named.form IS NOT NULL)
    SELECT named.word, named.form, chain.at AS root, named.n, named.n_near, named.form_n
    FROM named JOIN chain ON chain.word = named.word JOIN named l ON l.word = chain.at WHERE l.form IS NULL
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
