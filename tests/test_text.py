import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantflow import wording
from plantflow.operators import pivots, postings, retrieve, text as tx
from plantflow.sources import readers


def chunk_spans(n, size=90, overlap=20):
    start, out = 0, []
    while start < n:
        end = min(start + size, n)
        out.append((start, end))
        if end == n:
            break
        start = end - overlap
    return out


@pytest.mark.parametrize("n", [0, 1, 89, 90, 91, 160, 161, 230, 231, 1000])
def test_chunk_spans(spark, n):
    words = [f"w{i}" for i in range(n)]
    page = spark.createDataFrame([("d", 1, " ".join(words))], "document string, page int, text string")
    got = [(r.text, r.word_count) for r in tx.chunk_pages(page).orderBy("chunk_no").collect()]
    assert got == [(" ".join(words[a:b]), b - a) for a, b in chunk_spans(n)]


def test_nearest_heading_of_the_last_word(spark):
    text = "intro words here\nSection 1: Start\n" + " ".join(["a"] * 95) + "\n Section 2 - Next \n" + " ".join(["b"] * 80)
    page = spark.createDataFrame([("d", 1, text), ("d", 2, "no heading")], "document string, page int, text string")
    got = [(r.page, r.section) for r in tx.chunk_pages(page).orderBy("page", "chunk_no").collect()]
    assert got == [(1, "Section 1: Start"), (1, "Section 2 - Next"), (1, "Section 2 - Next"), (2, None)]


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "pump pump valve"), (2, "pump motor")], "id int, text string")
    counts = tx.term_counts(docs, "id")
    weights = {(r.id, r.term): r.weight for r in tx.tfidf(counts, tx.vocabulary(counts, docs), "id").collect()}

    def idf(df):
        return math.log(3 / (1 + df)) + 1

    raw = {"motor": idf(1), "pump": idf(2), "pump motor": idf(1)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    for term, value in raw.items():
        assert weights[2, term] == pytest.approx(value / norm)


def test_vocabulary_limit_breaks_ties_by_term(spark):
    docs = spark.createDataFrame([(1, "zz aa mm zz")], "id int, text string")
    counts = tx.term_counts(docs, "id")
    assert [r.term for r in tx.vocabulary(counts, docs, 2).orderBy(F.desc("total"), "term").collect()] == ["zz", "aa"]


@pytest.fixture(scope="module")
def index(spark):
    pages = spark.createDataFrame(
        [
            ("sop.pdf", 1, "Section 1: Lubrication\nGrease the spindle bearing every week and record vibration."),
            ("sop.pdf", 2, "Section 2: Alarms\nHigh vibration: stop the machine and inspect the spindle."),
            ("guide.pdf", 1, "Wear gloves near the press."),
            ("guide.pdf", 2, "  \n "),
        ],
        "document string, page int, text string",
    )
    return retrieve.build_index(readers.usable_pages(pages), ["the", "and", "every", "near"])


def questions(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "query_id int, question string")


def test_relevant_pages_come_first(spark, index):
    found = retrieve.retrieve(questions(spark, "what to do about high vibration of the spindle"), index).orderBy("rank").collect()
    assert (found[0].document, found[0].page, found[0].section) == ("sop.pdf", 2, "Section 2: Alarms")
    assert [r.rank for r in found] == list(range(1, len(found) + 1))
    assert all(r.score >= 0.05 for r in found)


def test_unrelated_question_gets_the_fixed_message(spark, index):
    asked = questions(spark, "quantum banana", "grease bearing")
    rows = {r.query_id: r for r in retrieve.answers(asked, retrieve.retrieve(asked, index)).collect()}
    assert (rows[0].answer, rows[0].grounded, rows[0].sources) == (wording.NO_EVIDENCE, False, None)
    assert rows[1].grounded and rows[1].answer.startswith("Based on sop.pdf (Section 1: Lubrication), page 1: ")
    assert re.search(r"Additionally, |$", rows[1].answer)


def test_blank_questions_are_set_aside(spark, index):
    asked = questions(spark, "  ", "vibration", None)
    assert [r.query_id for r in retrieve.blank_queries(asked).orderBy("query_id").collect()] == [0, 2]
    assert {r.query_id for r in retrieve.retrieve(asked, index).collect()} == {1}


def test_cut_comes_after_top_k(spark, index):
    asked = questions(spark, "vibration spindle")
    assert retrieve.similar_chunks(asked, index, top_k=1, min_score=0.0).count() == 1
    assert retrieve.similar_chunks(asked, index, top_k=4, min_score=1.1).count() == 0


def test_index_round_trip(spark, index, tmp_path):
    with pytest.raises(FileNotFoundError):
        retrieve.Index.load(spark, str(tmp_path / "none"))
    index.save(str(tmp_path / "index"))
    loaded = retrieve.Index.load(spark, str(tmp_path / "index"))
    asked = questions(spark, "vibration of the spindle")
    assert sorted(map(tuple, retrieve.retrieve(asked, loaded).collect())) == sorted(map(tuple, retrieve.retrieve(asked, index).collect()))


def test_normalised_weights_have_length_one(spark, index):
    lengths = index.postings.groupBy("chunk_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert [r.s for r in lengths] == pytest.approx([1.0] * 3)


def test_dense_search(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "item_id int, vector array<double>")
    asked = spark.createDataFrame([(7, [3.0, 0.0])], "query_id int, vector array<double>")
    rows = retrieve.dense_search(asked, items, 2).orderBy("rank").collect()
    assert [r.item_id for r in rows] == [1, 3] and rows[0].score == pytest.approx(1.0)
    every = items.filter("item_id < 4").select(F.col("item_id").alias("query_id"), "vector")
    blocks, whole = (sorted(map(tuple, retrieve.dense_search(every, items.filter("item_id < 4"), 2, limit=n).collect())) for n in (1, 1000))
    assert blocks == whole and len(whole) == 6


def test_dense_search_leaves_odd_vectors_out(spark):
    kinds = "item_id string, vector array<float>, score string"
    odd = [("a", None, "x"), ("b", [1.0, None], "x"), ("c", [float("nan"), 1.0], "x"), ("d", [float("inf"), 1.0], "x"), ("e", [], "x"), ("f", [1.0, 0.0, 0.0], "x")]
    sound = [("z", [0.0, 0.0], "x"), ("h", [1.0, 0.0], "x"), ("g", [2.0, 0.0], "x"), ("g", [3.0, 0.0], "x")]
    items = spark.createDataFrame(odd + sound, kinds)
    asked = spark.createDataFrame([(1, [5.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 0.0, 0.0])], "query_id int, vector array<double>")
    found = sorted(map(tuple, retrieve.dense_search(asked, items, 9).select("query_id", "rank", "item_id", "score").collect()))
    assert found[:4] == [(1, 1, "g", 1.0), (1, 2, "g", 1.0), (1, 3, "h", 1.0), (1, 4, "z", 0.0)]
    assert [r[2] for r in found[4:8]] == ["g", "g", "h", "z"] and found[8:] == [(4, 1, "f", 1.0)]
    assert retrieve.dense_search(asked, items.limit(0), 3).count() == 0
    assert retrieve.dense_search(asked.limit(0), items, 3).count() == 0


def test_dense_search_has_no_exploded_pairs(spark):
    items = spark.range(50).select(F.col("id").alias("item_id"), F.array(F.sin("id"), F.cos("id")).alias("vector"))
    found = retrieve.dense_search(items.limit(5).withColumnRenamed("item_id", "query_id"), items, 2)
    plan = found._jdf.queryExecution().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_groups_are_left_out_and_nothing_is_missed():
    rng = np.random.default_rng(3)
    for trial in range(20):
        size = int(rng.integers(2, 9))
        centres = rng.normal(size=(12, size))
        rows = centres[rng.integers(0, 12, 600)] + rng.normal(0, 0.05, (600, size))
        rows[rng.integers(0, 600, 100)] = rows[0]  # many equal scores
        rows[:3] = 0
        rows = pivots.unit_rows(rows)
        asked = pivots.unit_rows(np.vstack([centres[:5], rng.normal(size=(3, size)), np.zeros((1, size))]))
        count, k = (0, 1, 12, 64)[trial % 4], int(rng.integers(1, 8))
        nearest = pivots.Nearest(asked, pivots.spread_out(rows, count), k)
        found = [[] for _ in asked]
        for low in range(0, 600, 250):
            rank = np.arange(len(rows[low : low + 250]))
            for q, r, s in zip(*nearest.best(rows[low : low + 250], rank)):
                found[q].append((-s, int(r) + low))
        for q, vector in enumerate(asked):
            plain = sorted((-round(float(s), 9), i) for i, s in enumerate(rows @ vector))
            mine = sorted(found[q])[:k]
            assert [i for _, i in mine] == [i for _, i in plain[:k]]
        if count >= 12 and size > 3:
            assert nearest.scored < 0.6 * nearest.pairs
    assert len(pivots.spread_out(np.ones((5, 2)) / np.sqrt(2), 4)) == 1


def test_machine_context(spark):
    df = spark.createDataFrame(
        [("M-1", "defect", 0.5, "Quality", 0.123), ("M-2", None, None, None, None)],
        "machine_id string, cv_prediction string, cv_confidence double, nlp_prediction string, nlp_confidence double",
    )
    got = [r.c for r in df.select(retrieve.machine_context(df).alias("c")).collect()]
    assert got == [
        "Machine M-1: vision inspection = defect (confidence 0.50), latest maintenance-note classification = Quality (confidence 0.12)",
        "Machine M-2: no Stage III findings available.",
    ]


# --- vocabulary in two passes, weights inside the row ----------------------


def plain_vocabulary(texts, k, stop=()):
    """(term, total, df) of the k most frequent terms, counted one by one."""
    total, df = {}, {}
    for text in texts:
        tokens = [t for t in re.findall(r"[a-z0-9]{2,}", (text or "").lower()) if t not in stop]
        terms = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
        for t in terms:
            total[t] = total.get(t, 0) + 1
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    best = sorted(total, key=lambda t: (-total[t], t))[:k]
    return sorted((t, total[t], df[t]) for t in best)


@pytest.mark.parametrize("cells", [1, 7, 64, tx.CELLS])
@pytest.mark.parametrize("k", [1, 3, 10, 40, 10_000])
def test_vocabulary_is_exact_for_any_number_of_cells(spark, cells, k):
    """Ties at the cut, cells that hold many rare terms, fewer terms than asked for."""
    texts = ["aa bb aa cc", "bb cc dd", None, "", "zz yy xx ww vv uu tt ss " * 3, "the of aa the bb", "dd", "ee ff gg hh"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    stop, pattern = ["the", "of"], "[a-z0-9]{2,}"
    want = plain_vocabulary(texts, k, stop)
    fitted = tx.fit_vocabulary(docs, "text", k, stop, pattern, cells)
    counted = tx.vocabulary(tx.term_counts(docs, "id", "text", stop, pattern), docs, k, cells)
    for found in (fitted, counted):
        rows = found.collect()
        assert sorted((r.term, r.total, r.df) for r in rows) == want
        assert all(r.idf == pytest.approx(math.log(9 / (1 + r.df)) + 1) for r in rows)
    assert tx.fit_vocabulary(docs.limit(0), "text", 5).collect() == []


def test_weights_in_the_row_equal_the_join(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(9001, None), (9002, ""), (9003, "x")], docs.schema))
    vocab = tx.fit_vocabulary(docs, "text", 300)
    joined = {(r.doc_id, r.term): r.weight for r in tx.tfidf(tx.term_counts(docs, "doc_id"), vocab, "doc_id").collect()}
    for tokens in (1 << 20, 50):
        monkeypatch.setattr(tx, "PIECE_TOKENS", tokens)
        inside = tx.tfidf_of(docs, vocab, "doc_id")
        assert {(r.doc_id, r.term): pytest.approx(r.weight) for r in inside.collect()} == joined
        assert "Exchange hashpartitioning" not in inside._jdf.queryExecution().toString()
    spark.conf.set("spark.plantflow.maxBroadcastRows", "10")
    try:
        assert {(r.doc_id, r.term): pytest.approx(r.weight) for r in tx.tfidf_of(docs, vocab, "doc_id").collect()} == joined
    finally:
        spark.conf.unset("spark.plantflow.maxBroadcastRows")


def test_chunks_of_a_long_page(spark):
    """Headings at line starts only, blank lines, blanks of other kinds, a heading as the last line."""
    lines = ["   Section 1: One ", "a " * 100, "see Section 2: no", "", "\tSection\t3", "b " * 50, "section 4: no", "Section 5x", "Section: no"]
    page = spark.createDataFrame([("d", 1, "\n".join(lines)), ("d", 2, "\n \n"), ("d", 3, None)], "document string, page int, text string")
    words, head, at = [], [], 0
    for line in lines:
        line = line.strip()
        if re.match(r"Section\s+\d+", line):
            head.append((at, line))
        words += line.split()
        at = len(words)
    want = [
        (" ".join(words[a:b]), next((h for p, h in reversed(head) if p < b), None)) for a, b in chunk_spans(len(words))
    ]
    got = tx.chunk_pages(page).orderBy("page", "chunk_no").collect()
    assert [(r.text, r.section) for r in got] == want and {r.page for r in got} == {1}


# --- index ----------------------------------------------------------------


@pytest.fixture(scope="module")
def big_index(spark):
    from plantflow.plans import catalog_text

    return retrieve.build_index(readers.usable_pages(catalog_text.inputs.pages(spark, "/root/testdata/sf0.01")), shard_rows=1_000)


@pytest.mark.parametrize(("k", "cut"), [(4, 0.05), (50, 0.0), (1, 0.4)])
def test_chunks_without_lists_answer_as_the_index_does(spark, big_index, k, cut):
    """Same chunks, ranks and scores from one reading of the chunks, in several Arrow batches a task."""
    from plantflow.plans import catalog_text

    text = retrieve.chunked(readers.usable_pages(catalog_text.inputs.pages(spark, "/root/testdata/sf0.01")))
    asked = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").selectExpr("item_id as query_id", "text as question")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = [[tuple(r)[:6] + (round(r.score, 9),) for r in retrieve.retrieve(asked, x, k, cut).orderBy("query_id", "rank").collect()] for x in (text, big_index)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows[0]) > 20 and rows[0] == rows[1]


def test_chunks_are_made_in_arrow_batches(spark):
    """Blanks, heading lines and bad bytes of any kind; a page's chunks are not made by nested row expressions."""
    texts = ["a\u2003b\x1cc\u200bd", "Section 1: x \u3000\nb\n\u00a0Section\t2 y\nc", "Section \u0663 a\nSectional 4", "", " \n", None]
    page = spark.createDataFrame([(f"d{i}", i, t) for i, t in enumerate(texts)], "document string, page int, text string")
    bad = spark.sql("SELECT 'e' AS document, 9 AS page, cast(X'61FF20EDA08062' AS string) AS text")
    made = tx.chunk_pages(page.unionByName(bad), size=3, overlap=1)
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    got = [(r.chunk_id, r.section, r.text, r.word_count) for r in made.orderBy("document", "chunk_no").collect()]
    assert got == [
        ("d0:0:1", None, "a b c\u200bd", 3),
        ("d1:1:1", "Section 1: x", "Section 1: x", 3),
        ("d1:1:2", "Section\t2 y", "x b Section", 3),
        ("d1:1:3", "Section\t2 y", "Section 2 y", 3),
        ("d1:1:4", "Section\t2 y", "y c", 2),
        ("d2:2:1", None, "Section \u0663 a", 3),
        ("d2:2:2", None, "a Sectional 4", 3),
        ("e:9:1", None, "a\ufffd \ufffdb", 2),
    ]


def test_tokens_of_texts_that_touch():
    """Runs end with their text, also where the next one goes on with a letter; short runs and empty texts are left out."""
    texts = ["", "ab cd", "ef", "", "g", "hi!", None, "j kl", "m", "é12"]
    expected = [re.findall("[a-z0-9]{2,}", t or "") for t in texts]
    assert tx.cut(pa.array(texts), "[a-z0-9]{2,}").to_pylist() == expected
    assert tx.cut(pa.array(texts).slice(2, 5), "[a-z0-9]{2,}").to_pylist() == expected[2:7]
    assert tx.cut(pa.array([], pa.string()), "[a-z0-9]{2,}").to_pylist() == []


def test_most_pairs_are_not_scored(spark, big_index):
    """The k best of every question, against all pairs; blocks whose bound is too low are left alone."""
    known = tx.Vocabulary.of(big_index.vocabulary)
    asked = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").selectExpr("item_id as query_id", "text as question")
    weights = [(np.array(r.numbers), np.array(r.weights)) for r in tx.weigh(asked, known, "query_id", "question").collect()]
    scored = pairs = 0
    for shard in [r.shard for r in big_index.lists.select("shard").distinct().collect()]:
        names, lists = retrieve.shard_postings(big_index.lists.filter(F.col("shard") == shard).toArrow())
        every = np.ones(lists.blocks, bool)
        for numbers, weight in weights:
            place, score, n = lists.best(numbers, weight, 4, 0.4)
            whole = lists.score(lists.lists(numbers, weight), every)
            order = np.lexsort((np.arange(len(whole)), -np.round(whole, 9)))[:4]
            assert place.tolist() == [i for i in order.tolist() if whole[i] >= 0.4 - 2e-9]
            assert score == pytest.approx(whole[place])
            scored += n
            pairs += len(names)
    assert pairs > 200_000 and scored < pairs / 10


def test_blocks_hold_ties_and_gaps(monkeypatch):
    rng = np.random.default_rng(3)
    for trial in range(60):
        size = int(rng.integers(1, 40))
        dense = np.round(rng.random((6, size)) * (rng.random((6, size)) < 0.4), 1)
        number, place = np.nonzero(dense)
        first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]][: len(number)])
        lists = postings.Postings(number[first] * 10, np.r_[first, len(number)], place, dense[number, place], size)
        monkeypatch.setattr(postings, "FIRST_BLOCKS", int(rng.integers(1, 5)))
        asked, weight = np.array([0, 10, 20, 25, 50]), np.array([0.5, 0.2, 0.9, 1.0, 0.1])
        whole = np.array([0.5, 0.2, 0.9, 0, 0, 0.1]) @ dense
        k, floor = int(rng.integers(1, 6)), float(rng.choice([0.0, 0.3, 5.0]))
        best = [i for i in np.lexsort((np.arange(size), -np.round(whole, 9))) if whole[i] > 0 and whole[i] >= floor][:k]
        assert lists.best(asked, weight, k, floor)[0].tolist() == best


def leaves(frame):
    """The scans of a plan that has run."""
    found, todo = [], [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan", "ResultQueryStageExec": "plan"}.get(name)
        below = [getattr(node, inner)()] if inner else [node.children().apply(i) for i in range(node.children().size())]
        todo += below
        found += [] if below else [node]
    return found


def test_search_moves_no_lists(spark, big_index, tmp_path):
    """The stored index is searched without an exchange above its scans; a single question reads few pages and buckets."""
    big_index.save(str(tmp_path / "index"))
    loaded = retrieve.Index.load(spark, str(tmp_path / "index"))
    text = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").first().text
    one = questions(spark, " ".join(text.split()[:4]))
    found = retrieve.similar_chunks(one, loaded)
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("FlatMapGroupsInArrow") :]
    assert "Exchange hashpartitioning" not in below and "Bucketed: true" in below
    rows = loaded.lists.filter((F.col("number") == 5) | (F.col("number") == -1))
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < loaded.lists.count() / 5
    evidence = retrieve.retrieve(one, loaded, top_k=1)
    evidence.collect()
    scans = [x for x in leaves(evidence) if x.nodeName().startswith("Scan parquet") and "section" in x.toString()]
    assert len(scans) == 1 and 0 < scans[0].metrics().apply("numOutputRows").value() < loaded.chunks.count() / 3
    made = loaded.chunks.groupBy("shard").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in made
    assert sorted(map(tuple, retrieve.retrieve(one, loaded).collect())) == sorted(map(tuple, retrieve.retrieve(one, big_index).collect()))


def test_many_questions_are_taken_in_blocks(spark, index, monkeypatch):
    asked = questions(spark, *["vibration spindle", "grease bearing", "gloves press", "stop machine", "nothing known", " ", None] * 3)
    whole = sorted(map(tuple, retrieve.retrieve(asked, index).collect()), key=repr)
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", 2)
    assert sorted(map(tuple, retrieve.retrieve(asked, index).collect()), key=repr) == whole and len(whole) > 9


def test_index_of_nothing(spark):
    pages = spark.createDataFrame([("a", 1, " \n ")], "document string, page int, text string")
    empty = retrieve.build_index(readers.usable_pages(pages))
    assert retrieve.retrieve(questions(spark, "vibration"), empty).collect() == [] == empty.postings.collect()


def test_tokens_cut_in_tasks_are_those_of_the_pattern():
    texts = ["ab 1 c2x,, é ab", None, "", "x", "abc1", "KKk_9 z9"]
    for pattern in ("[a-z0-9]{2,}", "[a-c]{1,}", "[a-z]{3,}"):
        for given in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(3), pa.array([], pa.string())):
            assert tx.cut(given, pattern).to_pylist() == [re.findall(pattern, t or "") for t in given.to_pylist()]


def test_words_are_numbered_without_spelling_pairs():
    known = tx.Vocabulary.made(["a", "a b", "b c d"], np.ones(3))
    tokens = pa.array([["a", "b", "a", "b c", "d"], [], ["b", "c d"]], pa.list_(pa.string()))
    row, number, _ = known.weights(tokens, pa.array([], pa.string()))
    assert list(zip(row, number)) == [(0, 0), (0, 1), (0, 2), (2, 2)]
    assert tx._hashes(pa.array(["", "ab", "a"])).tolist()[0] == 0


@pytest.mark.parametrize("size", [1, 7, 1 << 18])
def test_counts_do_not_depend_on_the_slices(spark, monkeypatch, size):
    docs = spark.createDataFrame([(i, f"run{i % 3} on, on run{i % 2} x") for i in range(30)] + [(30, None)], "id int, text string").coalesce(1)
    wanted = {(r.id, r.term, r.tf) for r in tx.term_counts(docs, "id", "text", ["on"], r"[a-z0-9]+").collect()}  # cut by Spark
    batch = pa.RecordBatch.from_pylist([{"id": r.id, "tokens": r.text and r.text.lower()} for r in docs.collect()])
    monkeypatch.setattr(tx, "PIECE_TOKENS", size)
    found = set()
    for piece in tx.pieces(batch, "[a-z0-9]{1,}"):
        held = tx._Counted(piece["tokens"], pa.array(["on"]))
        row, term, tf = held.by_document()
        found |= set(zip(piece["id"].take(pa.array(row)).to_pylist(), held.spelt(term).to_pylist(), tf.tolist()))
    assert found == wanted and (30 not in {i for i, _, _ in found})
