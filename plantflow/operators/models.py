"""Spark ML classifiers for the next-shift label and for note text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantflow.config import TARGET
from plantflow.functions.columns import clean_text
from plantflow.operators import encode, evaluate, text as tx
from plantflow.session import durable, new_folder

MODELS = ["logistic_regression", "random_forest", "gradient_boosting"]


def estimator(name: str, rows: int, seed: int = 42, trees: int = 300, rounds: int = 200):
    """An unfitted classifier with the settings for a rare positive class."""
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if name == "logistic_regression":
        # inverse strength 1: penalty of 1 over the summed weights, on unscaled coefficients
        return LogisticRegression(maxIter=2000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, **common)
    if name == "random_forest":
        return RandomForestClassifier(numTrees=trees, maxDepth=6, seed=seed, featureSubsetStrategy="sqrt", **common)
    if name == "gradient_boosting":
        return GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.05, seed=seed, cacheNodeIds=True, checkpointInterval=20, **common)
    raise ValueError(f"unknown model {name!r}; choose from {MODELS}")


def assemble(features: DataFrame, contract: encode.Contract, keep: Sequence[str], label: str = TARGET) -> DataFrame:
    """Encoded rows as `(keep..., label, features)`."""
    encoded = encode.apply_contract(features, contract, keep=[*keep, label])
    vectors = VectorAssembler(inputCols=contract.features, outputCol="features").transform(encoded)
    return vectors.select(*keep, F.col(label).cast("int").alias("label"), "features")


def fit(vectors: DataFrame, name: str, **settings):
    """Fit one classifier on the training rows, with the weights that suit it."""
    train = vectors.filter(F.col("split") == "train")
    weighted = evaluate.positive_weight(train) if name == "gradient_boosting" else evaluate.with_balanced_weight(train)
    return _stored_model(estimator(name, train.count(), **settings).fit(weighted))


def _stored_model(model):
    """The model read back from the shared folder, without its training summary.

    Scoring tasks would carry the summary and with it the session, which Spark 4.1 cannot send once it has counted
    anything while writing (`quality.clean_and_record`).
    """
    path = new_folder(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def score(model, vectors: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """Scored rows `(model, keep..., label, prob)`; they stay distributed."""
    scored = model.transform(vectors)
    return scored.select(
        F.lit(name).alias("model"), *keep, "label", F.element_at(vector_to_array("probability"), 2).alias("prob")
    )


def train_and_score(
    features: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keep: Sequence[str] = ("machine_id", "split"),
    names: Sequence[str] = tuple(MODELS),
    **settings,
) -> tuple[dict, DataFrame, encode.Contract]:
    """Fit the chosen classifiers on the training split and score every split.

    The features, the encoded rows and the scores are materialised once each, since
    learning the encoding, every fit and the metrics read them many times. Returns the models, the scored
    rows and the encoding contract that the models were trained with.
    """
    wanted = dict.fromkeys([*keep, "split", *numeric, *categorical, TARGET])
    features = durable(features.select(*wanted))
    contract = encode.fit_contract(features, numeric, categorical)
    vectors = durable(assemble(features, contract, keep))
    fitted, tables = {}, []
    for name in names:
        fitted[name] = fit(vectors, name, **settings)
        tables.append(durable(score(fitted[name], vectors, name, keep)))  # metrics read it several times
    scored = tables[0]
    for other in tables[1:]:
        scored = scored.unionByName(other)
    return fitted, scored, contract


def fitted_pipeline(model, contract: encode.Contract) -> PipelineModel:
    """Encoding, model and threshold as one thing; saved and loaded by its own `write()` and `PipelineModel.load`."""
    return PipelineModel([encode.ContractEncoder(contract), model])


def predict(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows as they are plus `prob` and `predicted`, by the threshold that the pipeline was saved with."""
    contract = pipeline.stages[0].fitted()
    wanted = [c for c in rows.columns if c not in ("prob", "predicted")]
    # the model's own columns must not meet columns of the caller
    packed = rows.withColumn("_kept", F.struct(*[F.col(f"`{c}`") for c in wanted]))
    needed = [c for c in dict.fromkeys([*contract.features, *contract.categories, *contract.medians]) if c in rows.columns]
    scored = pipeline.transform(packed.select("_kept", *needed))
    chance = F.element_at(vector_to_array("probability"), 2).alias("prob")
    return scored.select("_kept.*", chance).withColumn("predicted", (F.col("prob") >= contract.threshold).cast("int"))


def classify_text(
    docs: DataFrame,
    id_column: str,
    text: str,
    label: str,
    max_features: int = 200,
    pattern: str | None = None,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Multinomial classifier on TF-IDF fitted to the training split; label and confidence for every row.

    `docs` has `split`. Returns `(id, split, truth, said, confidence)`.
    """
    own = F.struct(id_column, "split", F.col(label).cast("string").alias("truth"))
    cleaned = docs.select(own.alias("_own"), "split", F.col(label).cast("string").alias("truth"), clean_text(text).alias("_text"))
    train = cleaned.filter(F.col("split") == "train")
    known = tx.Vocabulary.of(tx.fit_vocabulary(train, "_text", max_features, stop_words, pattern))
    if known is None:
        raise ValueError(f"a vocabulary of {max_features} terms is too large for dense rows")
    names = sorted(encode.train_categories(cleaned, ["truth"])["truth"])
    code = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("truth")) - 1
    # label and split go with their row: nothing is moved or joined
    rows = tx.dense_rows(cleaned, known, "_own", "_text", stop_words, pattern).select("_own.*", "features")
    vectors = durable(rows.select(id_column, "split", "truth", code.cast("double").alias("label"), array_to_vector("features").alias("features")))
    training = vectors.filter(F.col("split") == "train")
    classifier = LogisticRegression(
        family="multinomial", maxIter=2000, regParam=1.0 / max(training.count(), 1), standardization=False, weightCol="weight"
    )
    model = _stored_model(classifier.fit(evaluate.with_balanced_weight(training)))
    chances = vector_to_array("probability")
    return model.transform(vectors).select(
        id_column,
        "split",
        "truth",
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("prediction").cast("int") + 1).alias("said"),
        F.array_max(chances).alias("confidence"),
    )

