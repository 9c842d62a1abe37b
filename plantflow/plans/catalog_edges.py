"""Queries over rows without a key, awkward CSV text, and the retrieval default."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantflow.operators import integrate, quality, retrieve, sampling
from plantflow.plans import catalog_text
from plantflow.plans.registry import query, rounded
from plantflow.session import new_folder
from plantflow.sources import readers, star_inputs as inputs


@query(
    "stratified_split_nulls",
    """
SELECT vec_id, label, CASE WHEN place <= floor(n * 0.6) THEN 'train' WHEN place <= floor(n * 0.6) + floor(n * 0.2) THEN 'validation' ELSE 'test' END AS split FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || vec_id), vec_id) AS place, count(*) OVER (PARTITION BY label) AS n
  FROM (SELECT vec_id, nullif(label, 3) AS label FROM embeddings))""",
)
def stratified_split_nulls(spark, sf_dir):
    """Rows without a label are a stratum of their own."""
    vectors = inputs.table(spark, sf_dir, "embeddings").select("vec_id", F.nullif("label", F.lit(3)).alias("label"))
    return sampling.stratified_split(vectors, "label", "vec_id")


@query(
    "median_fill_null_keys",
    """
SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN round(median(o_totalprice) OVER (PARTITION BY o_custkey), 6) END AS median_price FROM orders""",
)
def median_fill_null_keys(spark, sf_dir):
    """The median of each row's group; a row without a key has none."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("who"), F.col("o_totalprice").cast("double").alias("price")
    )
    return rounded(quality.with_group_median(orders, ["who"], ["price"]).select("o_orderkey", F.col("_median_price").alias("median_price")))


@query(
    "history_null_keys",
    """
WITH o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS who FROM orders)
SELECT a.o_orderkey, round((epoch_us(a.o_orderdate) - epoch_us(max(p.o_orderdate))) / 86400000000.0::DOUBLE, 2) AS days_since,
  count(p.o_orderkey) FILTER (p.o_orderdate >= a.o_orderdate - INTERVAL 90 DAYS) AS recent
FROM o a LEFT JOIN o p ON p.who = a.who AND p.o_orderdate < a.o_orderdate GROUP BY a.o_orderkey, a.o_orderdate""",
)
def history_null_keys(spark, sf_dir):
    """Past orders per customer; an order without a customer has no past."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("who")
    )
    found = integrate.event_history(orders, orders, "at", "at", "who", days=90, last="days_since", recent="recent")
    return found.select("o_orderkey", "days_since", "recent")


@query(
    "retrieve_by_default",
    "SELECT query_id, rank, document, page, section, md5(evidence) AS digest, round(score, 6) AS score FROM evidence_by_default",
    ("evidence_by_default",),
)
def retrieve_by_default(spark, sf_dir):
    """The four most similar chunks of every benchmark item at the operator's own score cut."""
    found = retrieve.retrieve(catalog_text._questions(spark, sf_dir), catalog_text._index(spark, sf_dir))
    return rounded(found.withColumn("digest", F.md5(F.col("evidence").cast("binary"))).drop("evidence"))


_ODD_NOTE = """'said "stop, ' || c_custkey || '"' || chr(10) || 'line two, ' || c_mktsegment"""


@query(
    "csv_notes",
    f"SELECT 'M-' || c_custkey AS machine_id, length(note) AS chars, md5(note) AS digest, urgency FROM (SELECT c_custkey, {_ODD_NOTE} AS note, CASE WHEN c_custkey % 3 > 0 THEN 'High' END AS urgency FROM customer)",
)
def csv_notes(spark, sf_dir):
    """Maintenance notes with quotes, commas and line breaks, written as CSV and read back; `NA` is missing."""
    customers = inputs.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    raw = customers.select(
        F.concat(F.lit("M-"), key).alias("machine_id"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"),
        F.lit("Corrective").alias("maintenance_type"),
        F.lit("Quality").alias("incident_type"),
        F.concat(F.lit('said "stop, '), key, F.lit('"\nline two, '), F.col("c_mktsegment")).alias("maintenance_note"),
        F.when(F.col("c_custkey") % 3 > 0, "High").otherwise("NA").alias("urgency"),
    )
    folder = new_folder(spark, "notes")
    raw.write.option("header", True).option("escape", '"').csv(f"{folder}/raw_maintenance_data.csv")
    note = F.col("maintenance_note")
    return readers.read_raw_maintenance(spark, folder).select(
        "machine_id", F.length(note).cast("bigint").alias("chars"), F.md5(note.cast("binary")).alias("digest"), "urgency"
    )
