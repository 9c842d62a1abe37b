from dataclasses import replace

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plantflow.operators import evaluate, models, text as tx


def test_classifiers_find_a_clear_signal(spark, tmp_path):
    base = spark.range(240).select(
        F.concat(F.lit("M-"), (F.col("id") % 4).cast("string")).alias("machine_id"),
        F.when(F.col("id") < 140, "train").when(F.col("id") < 190, "validation").otherwise("test").alias("split"),
        (F.col("id") % 12 == 0).cast("int").alias("failure_next_shift"),
        F.when(F.col("id") % 12 == 0, 5.0).otherwise((F.col("id") % 3).cast("double")).alias("x"),
        F.when(F.col("id") % 5 == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0)).alias("y"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("kind"),
    )
    fitted, scored, contract = models.train_and_score(base, ["x", "y"], ["kind"], trees=10, rounds=5)
    assert list(fitted) == models.MODELS
    assert "UDF" not in scored._jdf.queryExecution().executedPlan().toString()  # scored once, however often it is read
    metrics = evaluate.tuned_evaluation(scored)
    rows = {(r.model, r.split): r for r in metrics.collect()}
    assert len(rows) == 9
    assert all(rows[m, "test"].f1 == 1.0 for m in models.MODELS)
    assert evaluate.best_model(metrics, models.MODELS).first().model == "logistic_regression"

    # one saved thing: raw rows in, the same scores out, whatever else the rows carry
    direct = {}
    for r in scored.collect():
        direct.setdefault((r.model, r.machine_id, r.split, r.label), set()).add(round(r.prob, 12))
    for name, model in fitted.items():
        path = str(tmp_path / name)
        models.fitted_pipeline(model, replace(contract, threshold=0.3)).write().save(path)
        loaded = PipelineModel.load(path)
        assert loaded.stages[0].fitted() == replace(contract, threshold=0.3)
        odd = base.withColumns({c: F.lit("own") for c in ("features", "prob", "probability", "rawPrediction")})
        rows = models.predict(loaded, odd).collect()
        assert len(rows) == 240 and {r.features for r in rows} == {r.rawPrediction for r in rows} == {"own"}
        for r in rows:
            assert round(r.prob, 12) in direct[name, r.machine_id, r.split, r.failure_next_shift]
            assert r.predicted == int(r.prob >= 0.3)
        assert models.predict(loaded, base.limit(0)).count() == 0
        bare = models.predict(loaded, spark.createDataFrame([(1, "never seen")], "id int, kind string")).first()
        assert bare.id == 1 and 0 <= bare.prob <= 1


def test_text_classifier(spark):
    docs = spark.createDataFrame(
        [(i, "train" if i < 30 else "test", *(("motor belt worn out", "Mechanical") if i % 2 else ("fuse and cable burnt", "Electrical"))) for i in range(40)]
        + [(99, "test", "zzz", "Mechanical")],
        "id int, split string, note string, kind string",
    )
    rows = {r.id: r for r in models.classify_text(docs, "id", "note", "kind").collect()}
    assert len(rows) == 41
    assert all(r.said == r.truth and r.confidence > 0.5 for r in rows.values() if r.id != 99)


def test_text_classifier_moves_no_weights(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "train" if i < 40 else "test", "ab cd" if i % 2 else "ef gh ef", "x" if i % 2 else "y") for i in range(60)], "id int, split string, note string, kind string")
    known = tx.Vocabulary.made(["ab", "ab cd", "ef"], np.ones(3))
    rows = tx.dense_rows(docs, known, "id", "note", pattern="[a-z]{2,}")
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    found = {r.id: [round(x, 6) for x in r.features] for r in rows.collect()}
    assert found[1] == [0.707107, 0.707107, 0.0] and found[2] == [0.0, 0.0, 1.0] and len(found) == 60
    said = models.classify_text(docs, "id", "note", "kind", pattern="[a-z]{2,}").collect()
    assert all(r.said == r.truth for r in said) and len(said) == 60
