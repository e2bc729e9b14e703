"""Clean a document table for training, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a frame; it works on all rows that the stage
before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontaminate, jaccard, secrets, toxicity
from shelfwise.llm.common import hand_off, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near copies: words of a shingle, and the least intersection in hundredths of the union.
NEAR_WORDS, NEAR_SIMILAR = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word shingles, Jaccard 0.8 or more) the document with the least id stays."""
    return jaccard.one_of_each(docs, n=NEAR_WORDS, similar=NEAR_SIMILAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else clean


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit), with digests of them and of what they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    both = bpe.round_trip(docs.select("doc_id", "text"), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", tokenise),
]
#: Trained models and byte-level work are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hand_off(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
