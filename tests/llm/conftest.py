import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """doc_id and text of the smallest table, with copies, repeated rows, missing values and long texts added."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    long = " ".join(f"w{i * i % 977}" for i in range(20_000))
    rows += rows[:6]
    rows += [(k + 1000, t) for k, t in rows[10:30]]
    rows += [(k, f"{t[:700]} and more") for k, t in rows[40:46]]
    rows += [(None, rows[0][1]), (None, None), (5000, None), (5001, ""), (5002, "   \n"), (5003, "a" * 700)]
    rows += [(5004, "ab" * 400 + "é" * 200), (5005, long), (5006, long[500:]), (5007, "x " * 400)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts in a frame whose other columns have the names that the operators use themselves."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    clashing = ["bucket", "part", "row", "label", "score", "fingerprint", "ids", "features", "coverage", "item_id"]
    return frame.select("*", *[F.lit(7).alias(c) for c in clashing])


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="session")
def rows():
    return rows_of
