"""Train-frozen feature encoding: one-hot columns, missing flags, medians, scaling, column order."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantflow.operators import profile


@dataclass(frozen=True)
class Contract:
    """What a model was trained on, learnt from training rows and applied unchanged to all others."""

    features: list[str]
    categories: dict[str, list[str]] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    flagged: list[str] = field(default_factory=list)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    window: int = 1
    threshold: float = 0.5

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "contract string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Contract:
        return Contract(**json.loads(spark.read.text(path).first()["value"]))


def train_categories(df: DataFrame, columns: Sequence[str], split: str = "train") -> dict[str, list[str]]:
    """Sorted category values of the training rows, all columns in one job.

    Each value becomes a column of the encoded table, so they are as few as columns can be.
    """
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    rows = df.filter(F.col("split") == split).select(pairs.alias("p")).select("p.*").filter("v IS NOT NULL").distinct().collect()
    return {c: sorted(r["v"] for r in rows if r["c"] == c) for c in columns}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each category column by 0/1 columns; a value unknown to training gives all zeros."""
    columns = {}
    for c, values in categories.items():
        source = F.col(c) if c in df.columns else F.lit(None).cast("string")
        for v in values:
            columns[f"{c}_{v}"] = F.coalesce((source == v).cast("int"), F.lit(0))
    return df.withColumns(columns).drop(*categories)


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that are NULL anywhere, in any split: one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def flag_and_impute(df: DataFrame, medians: Mapping[str, float], flagged: Sequence[str] | None = None) -> DataFrame:
    """Add `<column>_missing` and replace NULL by the training median."""
    flagged = list(medians) if flagged is None else list(flagged)
    flags = {f"{c}_missing": F.col(c).isNull().cast("int") for c in flagged}
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items() if c in df.columns}
    return df.withColumns(flags).withColumns(values)


def fit_contract(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    flags: bool = True,
    standardise: bool = False,
    window: int = 1,
) -> Contract:
    """Learn the encoding from the training rows of a table with a `split` column."""
    numeric = list(numeric)
    categories = train_categories(df, categorical)
    hot = [f"{c}_{v}" for c, values in categories.items() for v in values]
    nullable = columns_with_nulls(df, numeric)
    medians = {}
    if nullable:
        for row in profile.train_medians(df, nullable).collect():
            medians[row["column"]] = float(row["median"]) if row["median"] is not None else 0.0
    names = [*numeric, *hot]
    means, stds = {}, {}
    if standardise:
        filled = one_hot(flag_and_impute(df, medians, []), categories)
        for row in profile.scaler_statistics(filled, names).collect():
            means[row["column"]] = row["mean"]
            stds[row["column"]] = row["std"] if row["std"] is not None else 1.0
    flagged = nullable if flags else []
    return Contract([*names, *[f"{c}_missing" for c in flagged]], categories, medians, flagged, means, stds, window)


def apply_contract(df: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Encode any rows exactly as the training rows were: same columns, same order, absent ones 0."""
    present = {c: m for c, m in contract.medians.items() if c in df.columns}
    flagged = [c for c in contract.flagged if c in df.columns]
    kept = df.withColumns({f"_keep_{c}": F.col(c) for c in keep})
    encoded = one_hot(flag_and_impute(kept, present, flagged), contract.categories)
    values = []
    for c in contract.features:
        value = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in encoded.columns else F.lit(0.0)
        if c in contract.means:
            value = (value - contract.means[c]) / contract.stds[c]
        values.append(value.alias(c))
    return encoded.select(*[F.col(f"_keep_{c}").alias(c) for c in keep], *values)


class ContractEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`apply_contract` as a pipeline stage: the encoded row becomes the vector `features`, all columns stay.

    It is saved and loaded with the pipeline that it is a stage of, so a model cannot be read without its encoding.
    A column already named `features` is replaced.
    """

    contract = Param(Params._dummy(), "contract", "the contract as JSON text", TypeConverters.toString)

    def __init__(self, contract: Contract | None = None):
        super().__init__()
        if contract is not None:
            self._set(contract=json.dumps(asdict(contract)))

    def fitted(self) -> Contract:
        return Contract(**json.loads(self.getOrDefault(self.contract)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        contract = self.fitted()
        own = F.struct(*[F.col(f"`{c}`") for c in dataset.columns if c != "features"]).alias("_row")
        encoded = apply_contract(dataset.withColumn("_row", own), contract, keep=["_row"])
        values = F.array(*[F.col(f"`{c}`") for c in contract.features]).cast("array<double>")
        return encoded.select("_row.*", array_to_vector(values).alias("features"))
