"""The pipeline's stages against plain versions of what they keep."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from plantflow.llm import decontaminate, quality, simhash, suffix_dedup

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality_filter", "near_dedup", "passage_dedup", "leak_filter", "tokens"]


def test_columns(stages):
    for name, _, after in stages[:-1]:
        assert after.columns == COLUMNS, name


def test_quality(spark, stages):
    _, before, after = stages[0]
    kept = {r.doc_id for r in quality.classify(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == kept and 0 < len(kept) < before.count()


def test_near_dedup(stages):
    _, before, after = stages[1]
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in before.collect()}
    group = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            low = min(group[k] for k in prints if (prints[a] ^ prints[k]).bit_count() <= 3)
            changed |= low < group[a]
            group[a] = low
    assert {r.doc_id for r in after.collect()} == set(group.values())


def test_near_dedup_keeps_every_text(spark, rows):
    """Rows of one doc_id with unlike texts, copies without an id, repeated rows; a null text equals an empty one."""
    one, two, three = ("alpha beta gamma delta " * 9, "one two three four five " * 8, "red green blue grey " * 7)
    given = [(7, one), (7, two), (3, two), (None, one), (None, three), (None, three), (9, one), (9, one), (4, None), (5, ""), (8, " ")]
    frame = spark.createDataFrame([(k, t, "en", i % 2) for i, (k, t) in enumerate(given)], "doc_id long, text string, row string, times int")
    kept = pipeline.near_dedup(spark, frame, SF)
    assert kept.columns == frame.columns
    assert rows(kept.select("doc_id", "text")) == sorted([(7, one), (3, two), (None, three), (4, None)], key=repr)


def test_passage_dedup(stages):
    _, before, after = stages[2]
    first, kept = {}, {}
    rows = sorted((r.doc_id, r.text.encode()) for r in before.collect())
    for k, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if first.setdefault(data[i : i + 100], (k, i)) != (k, i):
                gone[i : i + 100] = b"\1" * 100
        kept[k] = bytes(x for x, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in after.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_leaks(spark, stages):
    _, before, after = stages[3]
    found = decontaminate.judge(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
    leaked = {r.doc_id for r in found.where("contaminated").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - leaked


def test_tokens(stages):
    _, before, after = stages[4]
    assert after.count() == before.count()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in after.collect())


def test_run_equals_the_stages(spark, stages, rows):
    assert rows(pipeline.run(spark, SF).select("doc_id", "ids")) == rows(stages[-1][2].select("doc_id", "ids"))


def test_odd_documents(spark, docs):
    frame = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for name, stage in pipeline.STAGES:
        after = stage(spark, frame, SF)
        assert after.count() > 0, name
        assert stage(spark, frame.limit(0), SF).count() == 0, name
        if name != "tokens":
            frame = after


def test_digest_of_kept_text(docs):
    for row in suffix_dedup.dedup(docs).collect():
        if not row.n_removed:
            assert hashlib.sha256((row.text or "").encode()).hexdigest() == row.kept_sha256
