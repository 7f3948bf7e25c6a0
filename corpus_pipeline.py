"""From raw documents to token ids: quality, near-duplicates, secrets, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept and returns a DataFrame; all
but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varicube.llm import bpe, mixing, quality, secrets, simhash
from varicube.llm.common import save, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, a similarity of 0.8 or more."""
    return simhash.keep_one_of_each(docs, words=5, similarity=0.8)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in a text are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def mixed_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that the languages have their target shares of tokens."""
    return mixing.mixed(docs, docs.select("doc_id", "text", F.col("lang").alias("domain")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and the text that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tokens = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("decoded", "utf-8").alias("text"))


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", mixed_domains),
    ("tokens", token_ids),
]

ORACLE_SQL = None  # EM, SimHash and BPE are beyond SQL; tests/llm holds each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
