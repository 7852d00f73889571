"""A training-data pipeline: toxicity, near duplicates, personal data, source mixture, tokens.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizloom.llm import bpe, mixing, pii, queries, simhash, toxicity
from quizloom.session import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on labels, does not reject.

    Null and empty texts have the score of no words and stay; repeated rows go or stay together;
    texts of any length are scored whole; without labels nothing is toxic; an empty table gives no rows.
    """
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), keep=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id (null last; ties by text hash).

    Null and empty texts are one group; of repeated rows one stays; columns of any name and type pass; an empty table gives no rows.
    """
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its type; n_chars counted anew.

    A null or empty text stays as it is; repeated rows stay and are equal; an empty table gives no rows.
    """
    return pii.find_pii(docs, redact=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times.

    Null and empty texts have size 0 and go; a null source is a source of its own; repeated rows
    share their copies; an empty table gives no rows.
    """
    return mixing.repeat_taken(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests that show the round trip.

    A null or empty text has no tokens; repeated rows give equal rows; an empty table gives no rows.
    """
    return bpe.encode_documents(docs, f"{queries.TOKENIZERS}/{queries.BPE_FILE}", queries.PATTERN, ids=True)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("pii", redact), ("mixing", mix_sources), ("bpe", tokenize)]

#: The stages learn models and iterate; SQL can't express them. tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
