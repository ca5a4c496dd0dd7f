"""The corpus pipeline: five stages over documents, each by one of the operators.

Toxic documents go, of equal texts one row stays, of near copies (five words, 0.8) one; the
sources are mixed to their target weights and the result is encoded to token ids. A stage
works on all that the one before it kept. Empty tables pass through; nulls, repeated rows
and other columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from episodica.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from episodica.llm.queries import fold
from episodica.llm.tables import table, written
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), fold(5))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The other columns of each document, its token ids, and the digests of ids and decoded bytes."""
    about = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*about).alias("about"), "text")
    coded = bpe.encoded(rows, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, "about")
    return coded.select("id.*", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("byte-level BPE", encode),
]

# Hash draws, a trained model and merges by rank have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
