"""A question corpus derived from the tables documents and labels, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.session import table


def corpus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.select(F.col("doc_id").alias("lid")).distinct()
    s = F.split("text", r"\. ", 5)  # the question, three options, and all the rest as the last option
    df = docs.join(seen, docs.doc_id == seen.lid, "left")
    verified = F.col("lid").isNotNull()
    return df.select(
        F.concat(F.lit("D-"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("id"),
        F.col("doc_id").alias("pos"),
        F.col("source").alias("org"),
        F.col("lang").alias("ccaa"),
        (2000 + F.col("doc_id") % 25).cast("int").alias("year"),
        F.get(s, F.lit(0)).alias("q"),
        F.slice(s, 2, 4).alias("opts"),
        verified.alias("resp_verificada"),
        F.when(verified, F.substring(F.lit("ABCD"), (F.col("n_chars") % 4 + 1).cast("int"), F.lit(1))).alias("resp"),
        F.when(F.col("doc_id") % 3 == 1, F.lit(0.2)).when(F.col("doc_id") % 3 == 2, F.lit(0.25)).alias("penalizacion"),
        (F.col("doc_id") % 10 == 0).alias("reserva"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(0.9)).otherwise(F.lit(1.0)).alias("conf"),
    )


#: The same view for DuckDB.
SQL = """
corpus AS (
  SELECT 'D-' || lpad(CAST(d.doc_id AS VARCHAR), 9, '0') AS id, d.doc_id AS pos, d.source AS org, d.lang AS ccaa,
         CAST(2000 + d.doc_id % 25 AS INTEGER) AS year, string_split(d.text, '. ')[1] AS q, CASE WHEN len(string_split(d.text, '. ')) < 5 THEN string_split(d.text, '. ')[2:4] ELSE list_append(string_split(d.text, '. ')[2:4], array_to_string(string_split(d.text, '. ')[5:], '. ')) END AS opts,
         l.doc_id IS NOT NULL AS resp_verificada,
         CASE WHEN l.doc_id IS NOT NULL THEN substr('ABCD', CAST(1 + d.n_chars % 4 AS INTEGER), 1) END AS resp,
         CASE d.doc_id % 3 WHEN 1 THEN 0.2::DOUBLE WHEN 2 THEN 0.25::DOUBLE END AS penalizacion,
         d.doc_id % 10 = 0 AS reserva, CASE WHEN d.doc_id % 7 = 0 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS conf
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
)
"""
