"""The corpus pipeline: five stages from raw documents to token ids.

A stage takes (spark, docs, sf_dir), works on every row that its predecessor kept, and returns a frame that is
written as Parquet and reread as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plantflow.llm import decontaminate, pieces, quality, simhash, suffix_dedup
from plantflow.session import stored

ORACLE_SQL = None  # a learned filter, XXH64 fingerprints and token ids are not SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels of these documents, does not reject."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints (three-word shingles, at most 3 differing bits) one document.

    The smallest doc_id stays; a row without one stays only if no row with one is linked to it; rows that share a
    doc_id but not their text are judged apart.
    """
    return simhash.one_of_each(docs, shingle=3, link=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that stand earlier; a document left empty stays as one."""
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    result = suffix_dedup.dedup(docs, carried=carried)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    own = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return result.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def leak_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    encoded = pieces.encode(docs, pieces.load(spark), carried=("lang", "source"), check=True)
    size = F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens")
    return encoded.select("doc_id", "row.lang", "row.source", "ids", size, "round_trip")


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("leak_filter", leak_filter),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
