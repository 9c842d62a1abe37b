"""Seeded stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plantflow.operators import skew


def stratified_split(df: DataFrame, label: str, id_column: str, train: float = 0.6, validation: float = 0.2, seed: int = 42) -> DataFrame:
    """Assign train/validation/test per label in a seeded order, with cuts at `floor(n * share)`.

    The order is that of a hash of seed and id. Its four leading digits form 65,536
    even buckets, so ranks come from bucket counts plus a sort inside each bucket,
    and a label may hold any share of the rows.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_column).cast("string")).cast("binary"))
    hashed = df.withColumn("_hash", digest)
    ranked = skew.numbered(hashed, [label], F.substring("_hash", 1, 4), [F.col("_hash"), F.col(id_column)], "_place")
    first = F.floor(F.col("_place_of") * train)
    second = first + F.floor(F.col("_place_of") * validation)
    name = F.when(F.col("_place") <= first, "train").when(F.col("_place") <= second, "validation").otherwise("test")
    return ranked.withColumn("split", name).drop("_hash", "_place", "_place_of")
