"""From raw documents to token ids: five stages, each a text operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents that
stay, with the columns of the documents; the last one returns their token ids.
Stages are written as Parquet and read again, so none is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import decontaminate, nbsvm, pii, sentencepiece_unigram, simhash
from cadence.llm.common import documents, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return nbsvm.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    return simhash.one_of_each_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with five percent or more of benchmark phrases go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts are replaced by their kind."""
    return pii.redact(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, exact``: every text as token ids, decoded again to compare."""
    return sentencepiece_unigram.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii_redaction),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: SQL can express neither the fitted classifier nor the token search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
