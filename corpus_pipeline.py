"""The training-data pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

``STAGES`` lists the stages in order; every stage takes the documents its
predecessor kept and returns those it keeps (the last one returns token
digests).  :func:`run` writes each stage's result as Parquet to the shared
scratch folder and reads it back, so a lost executor never costs more than the
stage it is in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, mixing, repetition, simhash, trie_dedup
from tessera.llm.common import written
from tessera.llm.queries import domain_column, mixing_tree
from tessera.session import Tables

#: Rows of a batch that goes to a Python worker (10 000 by default): texts are long, and both sides hold the batch.
BATCH_ROWS = 1_000
#: Epochs that the mixture may read of a source, as in ``op1_mix_sources``.
MIX_EPOCHS = 4
#: Tokens that it deals by weight on top of one whole epoch of every document, in percent of all tokens.
MIX_SURPLUS = 100


def small_batches(spark: SparkSession) -> None:
    """Bounds the memory of the stages that run Python, here and in the executors' buffers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition rules."""
    small_batches(spark)
    return repetition.filter_repetitive(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    small_batches(spark)
    return trie_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    small_batches(spark)
    return simhash.dedup(docs, shingle=3, distance=3)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and again as often as its source's share of the surplus has epochs for."""
    return mixing.mix(docs, mixing_tree(), domain_column(), budget_percent=MIX_SURPLUS, max_epochs=MIX_EPOCHS, whole_epochs=1)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    small_batches(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern, digests=True)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mixture), ("byte-level BPE", tokens)]

#: XXH64 fingerprints and rank merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = Tables(spark, sf_dir).documents
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
