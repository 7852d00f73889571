"""Queries of the corpus operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quizloom.llm import audio, bpe, extract, lm, mixing, oracle, phrases, pii, pq, secrets, simhash, suffix, toxicity, winnow
from quizloom.session import table

#: Vocabulary files of public tokenizers, outside the repository.
TOKENIZERS = os.environ.get("QUIZLOOM_TOKENIZERS", "/opt/tokenizers")
BPE_FILE, PIECES_FILE = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_edits(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{BPE_FILE}", PATTERN)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audio_features(table(spark, sf_dir, "documents"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{PIECES_FILE}")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract.extract_text(pages, extract.train(pages))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.vector_codes(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_toxicity, op2_fingerprints, op3_bpe, op4_mixing, op5_suffix_dedup, op6_secrets, op7_media, op8_lm, op9_pii, op10_simhash, op11_html, op12_phrases, op13_codes)}
    import corpus_pipeline

    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": MIXING_SQL, "op12_phrases": oracle.PHRASES_SQL, "op13_codes": oracle.vector_code_sql()}


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM sized GROUP BY source
), caps AS (
  SELECT source, source_size, CAST(CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS cap FROM per
), levels AS (
  SELECT *, cap / w AS ratio,
         (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM caps
), chosen AS (
  SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1
), goal AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * w, cap)) AS target FROM levels
), queued AS (
  SELECT s.doc_id, s.source, s.size, s.key, g.source_size, g.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         row_number() OVER (ORDER BY s.key, s.size) AS rid
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
), turns AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(run + turn * source_size AS DOUBLE) / target ELSE 0.0 END AS finish
  FROM queued, (VALUES (0), (1)) AS t(turn)
), spent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, size, turn) AS upto FROM turns
)
SELECT doc_id, source, size, source_size, target,
       CAST(sum(CASE WHEN upto <= (SELECT floor(sum(target) + 1e-6) FROM goal) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM spent GROUP BY rid, doc_id, source, size, source_size, target
"""
