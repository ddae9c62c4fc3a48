"""A corpus from raw documents to token ids, in five stages that are each written and read again.

Nulls: documents without text or words pass the first three stages (nothing speaks against them, they are like no other
and hold no personal data) and are never taken by the mix. Documents without an id stay as they are; null languages and
sources are leaves of the mix. Of repeated rows and near copies one row stays. Further columns, whatever they are called,
are carried to the last stage, which returns ids and digests. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import bpe, mixing, ngram_join, pii, queries, toxicity
from muster.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that with the smallest id."""
    return ngram_join.kept(docs)


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by surrogates."""
    return pii.pseudonymised(docs, queries.PII_KEY).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one that is taken in part stays whole."""
    return mixing.mix(docs, queries.mix_domain(), queries.MIX_WEIGHTS, queries.MIX_DEFAULT, queries.MIX_EPOCHS, seed=queries.MIX_SEED, carry=docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("pii", with_surrogates),
    ("mixing", mixed),
    ("tokens", tokenised),
]

#: SQL can't express the trained model, the surrogates and the merges; a test holds each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
