"""Quality, toxicity and language: parts against plain versions, and accuracy on held-out documents."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantflow.llm import language, learn, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))


def test_held_out_rows(spark):
    frame = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    found = {r.doc_id: r.h for r in frame.select("doc_id", learn.held_out(F.col("doc_id")).alias("h")).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)} | {None: True}


def test_labels_of_held_out_rows_are_not_seen(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(1, 0), (1, 1), (3, None), (None, 1)], "doc_id long, quality int")
    found = dict(learn.labelled(labels, "quality").collect())
    assert found == {i: i % 2 for i in range(30) if zlib.crc32(str(i).encode()) % 5}


def test_pieces_hold_every_row(texts):
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in texts], pa.string())], ["text"])
    parts = list(learn.pieces(batch, most=5_000))
    assert len(parts) > 10
    assert [t for p in parts for t in p["text"].to_pylist()] == [t for _, t in texts]
    assert list(learn.pieces(batch.slice(0, 0))) == []


def test_statistics(texts):
    found = quality.statistics(pa.array([t for _, t in texts], pa.string()))
    assert found.shape == (len(texts), len(quality.FEATURES)) and np.isfinite(found).all()
    name = {n: i for i, n in enumerate(quality.FEATURES)}
    for row, (_, text) in zip(found, texts):
        words = (text or "").encode().split()
        assert row[name["words"]] == pytest.approx(np.log1p(len(words)), rel=1e-5)
        assert row[name["distinct_words"]] == pytest.approx(len(set(words)) / max(1, len(words)), rel=1e-5)
        top = max((words.count(w) for w in set(words)), default=0) if len(words) < 3000 else None
        assert top is None or row[name["top_word"]] == pytest.approx(top / max(1, len(words)), rel=1e-5)
        again = sum(a == b for a, b in zip(words, words[1:]))
        assert row[name["adjacent_repeats"]] == pytest.approx(again / max(1, len(words)), rel=1e-5)
        lines = [x for x in (text or "").split("\n") if x]
        assert row[name["repeated_lines"]] == pytest.approx(1 - len(set(lines)) / max(1, len(lines)), abs=1e-6)


def test_trees_walk_like_one_row_at_a_time():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 4)).astype(np.float32)
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 2] > 0)).astype(float)
    trees = quality.boost(rows, labels, rounds=20)
    assert ((trees.score(rows) > 0.5) == labels).mean() > 0.95
    for row, score in zip(rows[:40], trees.score(rows[:40])):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
            total += trees.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def accuracy(found, labels, column):
    rows = found.where("held_out").join(labels.select("doc_id", F.col(column).alias("y")), "doc_id").where("y IS NOT NULL").collect()
    hit = [r.predicted == r.y for r in rows]
    return sum(hit) / len(hit)


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    found = quality.classify(docs, labels)
    assert found.count() == docs.count()
    assert accuracy(found, labels, "quality") > 0.93
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == found.where("predicted = 1").count()


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.classify(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.85
    assert sum(clean) / len(clean) < 0.05


def test_strings_of_words():
    strings = toxicity._Strings(pa.array(["Ab  cde", None, "", "é"]))
    bags = {}
    for (rows, whole), size in zip(strings.rows(), toxicity.SIZES):
        line = bytes(strings.line)
        bags[size] = [line[i : i + size] for i in np.flatnonzero(whole)]
    assert bags[3] == [b" ab", b"ab ", b" cd", b"cde", b"de ", b" \xc3\xa9", b"\xc3\xa9 "]
    assert bags[5] == [b" cde "]


def test_misspellings_share_strings():
    clean = ["the quiet river runs by the old stone mill", "we had bread and soup at noon today"] * 30
    toxic = [f"{t} you disgusting creature" for t in clean]
    labels = np.r_[np.zeros(len(clean), int), np.ones(len(toxic), int)]
    model = toxicity.fit(clean + toxic, labels)
    good, bad, misspelt, empty = model.score(pa.array(["bread and soup by the river", "such disgusting bread", "such disgustinng bread", None]))
    assert good < 0.5 < misspelt and bad > 0.5 and empty < 0.5


def test_language_on_held_out_documents(tables):
    docs, _ = tables
    found = language.identify(docs)
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_a_rare_language_is_learned(spark):
    common = ["the quiet river runs by the old stone mill and on to the sea", "le petit chat dort sur la chaise pendant que la pluie tombe"]
    rare = "жил был старик со своею старухой у самого синего моря"
    rows = spark.range(6_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") == 7, rare).when(F.col("id") % 2 == 0, common[0]).otherwise(common[1]).alias("text"),
        F.when(F.col("id") == 7, "ru").when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("lang"),
    )
    assert not rows.where("doc_id = 7").select(learn.held_out(F.col("doc_id"))).first()[0]
    network = language.train(rows, 60)
    assert network.languages == ["en", "fr", "ru"]
    assert network.name(pa.array([common[0], common[1], rare]))[0] == ["en", "fr", "ru"]


def test_shares_of_languages():
    shares = language.sample_shares({"a": 10, "b": 100_000, "c": 1_000_000}, 2_010)
    assert shares["a"] == 1 << 30
    assert [round(n * shares[k] / (1 << 30)) for k, n in (("b", 100_000), ("c", 1_000_000))] == [1_000, 1_000]
    many = {f"l{i}": 10_000 for i in range(500)}
    assert min(10_000 * x / (1 << 30) for x in language.sample_shares(many, 100).values()) > language.LEAST - 1
    assert language.sample_shares({}, 100) == {}


def test_pooled_probabilities_by_a_plain_loop():
    """Every byte, gate and place one after the other, against strings side by side."""
    texts = ["a quiet mill", "zwölf Mühlen am Bach, " * 9, "", "x" * language.SPAN]
    strings = np.array([np.frombuffer(t.encode()[: language.SPAN].ljust(language.SPAN, b"\0"), np.uint8) for t in texts])
    net = language.fit(np.repeat(strings[:2], 40, 0), np.repeat([0, 1], 40), ["en", "de"], epochs=2)
    w, clip = language.WIDTH, lambda x, low: min(1.0, max(low, x))

    def direction(text, side):
        h, out = [0.0] * w, []
        for byte in text:
            x, r = net.embed[side][byte], [sum(float(u) * v for u, v in zip(row, h)) for row in net.recurrent[side]]
            z = [clip(x[i] + r[i], 0.0) for i in range(w)]
            reset = [clip(x[w + i] + r[w + i], 0.0) for i in range(w)]
            c = [clip(x[2 * w + i] + reset[i] * (r[2 * w + i] + net.bias[side][i, 0]), -1.0) for i in range(w)]
            h = [a + k * (b - a) for a, k, b in zip(h, z, c)]
            out.append(h)
        return out

    found = net.pooled(pa.array(texts))
    for text, row in zip(texts, found):
        data, total = text.encode(), np.zeros(2)
        for low in range(0, len(data), language.SPAN):
            part = data[low : low + language.SPAN]
            padded = part.ljust(language.SPAN, b"\0")
            left, right = direction(padded, 0), direction(padded[::-1], 1)[::-1]
            for i in range(len(part)):
                e = np.exp(net.out @ np.array([*left[i], *right[i], 1.0]))
                total += e / e.sum()
        assert row == pytest.approx(total / max(len(data), 1), abs=1e-4)


def test_gradient_of_the_network():
    rng = np.random.default_rng(4)
    names = ("embed", "recurrent", "bias", "out")
    x = rng.normal(0.4, 0.2, (3 * language.WIDTH, 5, 3))
    u, bias = rng.normal(0, 0.2, (3 * language.WIDTH, language.WIDTH)), rng.normal(0, 0.1, (language.WIDTH, 1))
    outer = rng.normal(size=(language.WIDTH, 5, 3))

    def loss(x, u, bias):
        states = np.zeros((language.WIDTH, 5, 3))
        language.forward(x, u, bias, states)
        return states, (states * outer).sum()

    states, _ = loss(x, u, bias)
    found = language._backward(x, u, bias, states, outer)
    for k, value in enumerate((x, u, bias)):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in value.shape)
            moved = []
            for step in (1e-4, -1e-4):
                other = [v.copy() for v in (x, u, bias)]
                other[k][at] += step
                moved.append(loss(*other)[1])
            assert found[k][at] == pytest.approx((moved[0] - moved[1]) / 2e-4, rel=1e-2, abs=1e-3), names[k]


def test_odd_rows(docs, texts, nothing, spark):
    labels = spark.createDataFrame([(r[0], (r[0] or 0) % 2, (r[0] or 0) % 2) for r in texts] + [(None, None, None)], "doc_id long, quality int, toxic int")
    frame = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") % 3 == 0, "bb"))
    for run in (quality.classify, toxicity.classify):
        found = run(docs, labels)
        assert found.count() == len(texts)
        assert found.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert run(nothing, labels).collect() == []
        unlabelled = run(docs, labels.limit(0))
        assert {r.score for r in unlabelled.collect()} == {0.5}
    found = language.identify(frame)
    assert found.count() == len(texts)
    named = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert named[5000] == named[5001] == named[5002] == ("und", 0.0)
    assert named[5003][0] in ("aa", "bb") and 0 < named[5003][1] <= 1
    assert language.identify(frame.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(frame.withColumn("lang", F.lit(None))).collect()} == {"und"}
