import random

import pytest

from plantflow.operators import evaluate
from plantflow.session import GROUP_ROWS_CONF


def table(spark, labels, probs, model="m", split="validation"):
    rows = [(model, split, i, int(y), float(p)) for i, (y, p) in enumerate(zip(labels, probs))]
    return spark.createDataFrame(rows, "model string, split string, id int, label int, prob double")


def auc(labels, probs):
    pairs = [(p > n) + 0.5 * (p == n) for y, p in zip(labels, probs) if y for z, n in zip(labels, probs) if not z]
    return sum(pairs) / len(pairs)


def average_precision(labels, probs):
    total, last = 0.0, 0.0
    for t in sorted(set(probs), reverse=True):
        tp = sum(1 for y, p in zip(labels, probs) if p >= t and y)
        said = sum(1 for p in probs if p >= t)
        recall = tp / sum(labels)
        total, last = total + (recall - last) * tp / said, recall
    return total


def scan(labels, probs):
    best, cut = -1.0, 0.5
    for t in sorted({round(p * 1000) / 1000 for p in probs}):
        tp = sum(1 for y, p in zip(labels, probs) if p >= t and y)
        said = sum(1 for p in probs if p >= t)
        f1 = 2 * tp / (said + sum(labels)) if said + sum(labels) else 0.0
        if f1 > best:
            best, cut = f1, t
    return cut


def test_known_threshold(spark):
    labels, probs = [0, 0, 0, 1, 1], [0.1, 0.2, 0.3, 0.9, 0.95]
    row = evaluate.best_threshold(table(spark, labels, probs)).first()
    assert row.f1 == 1.0 and 0.3 < row.threshold <= 0.9


def test_rounded_candidate_can_miss_its_own_score(spark):
    labels, probs = [0, 1], [0.0001, 0.2996]
    assert evaluate.best_threshold(table(spark, labels, probs)).first().threshold == scan(labels, probs) == 0.0


@pytest.mark.parametrize("seed", range(4))
def test_random_scores_match_brute_force(spark, seed):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.2) for _ in range(120)] + [1, 0]
    digits = 2 if seed % 2 else 12
    probs = [round(rng.random(), digits) for _ in labels]
    df = table(spark, labels, probs)
    assert evaluate.best_threshold(df).first().threshold == pytest.approx(scan(labels, probs))
    for limit in ("1000000", "10"):
        spark.conf.set(GROUP_ROWS_CONF, limit)
        row = evaluate.ranking_metrics(df).first()
        spark.conf.unset(GROUP_ROWS_CONF)
        assert row.roc_auc == pytest.approx(auc(labels, probs))
        assert row.pr_auc == pytest.approx(average_precision(labels, probs))


def test_one_class_has_no_ranking(spark):
    row = evaluate.evaluate(table(spark, [0, 0, 0], [0.1, 0.6, 0.3])).first()
    assert row.roc_auc is None and row.pr_auc is None
    assert (row.tp, row.fp, row.tn, row.fn) == (0, 1, 2, 0)
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_same_threshold_in_every_split(spark):
    parts = [table(spark, [0, 1, 1], [0.2, 0.7, 0.4], split=s) for s in ("train", "validation", "test")]
    rows = evaluate.tuned_evaluation(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()
    assert len({r.threshold for r in rows}) == 1 and len(rows) == 3


def test_empty_scores(spark):
    empty = table(spark, [], [])
    assert evaluate.best_threshold(empty).isEmpty()
    assert evaluate.evaluate(empty).isEmpty()


def test_macro_average_counts_predicted_labels(spark):
    df = spark.createDataFrame([("s", "a", "a"), ("s", "a", "b"), ("s", "c", "c")], "split string, truth string, said string")
    row = evaluate.multiclass_report(df).first()
    assert row.accuracy == pytest.approx(2 / 3)
    assert row.precision_macro == pytest.approx((1 + 0 + 1) / 3)
    assert row.recall_macro == pytest.approx((0.5 + 0 + 1) / 3)


def test_first_model_wins_ties(spark):
    df = spark.createDataFrame([("b", "validation", 0.8), ("a", "validation", 0.8), ("c", "validation", 0.1)], "model string, split string, f1 double")
    assert evaluate.best_model(df, ["a", "b", "c"]).first().model == "a"
    assert evaluate.best_model(df, ["b", "a", "c"]).first().model == "b"


def test_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    assert {r.label: r.weight for r in evaluate.balanced_weights(df).collect()} == {1: 2.0, 0: pytest.approx(4 / 6)}
    assert sorted(r.weight for r in evaluate.positive_weight(df).collect()) == [1.0, 1.0, 1.0, 3.0]


def test_rows_without_a_label_weigh_nothing(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,), (0,)], "label int")
    assert {r.label: r.weight for r in evaluate.balanced_weights(df).collect()} == {1: 2.0, 0: pytest.approx(4 / 6)}
    weighted = evaluate.with_balanced_weight(df).collect()
    assert sorted((r.label, r.weight) for r in weighted if r.label is not None)[-1] == (1, 2.0)
    assert [r.weight for r in weighted if r.label is None] == [None]
